"""Structured Streaming jobs: continuous ingest (S6) and the hourly rollup (M6)."""

from eventide.streaming.jobs import stream_ingest, stream_hourly  # noqa: F401

"""Sources, ingest and sinks."""

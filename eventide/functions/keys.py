"""Deterministic surrogate keys.

Where the reference defaults a key to a random UUID, a key derived from
the natural key keeps reloads idempotent: the same row gets the same id
on every run and on every retried task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stable_uuid(*cols: Column | str) -> Column:
    """UUID-formatted (8-4-4-4-12) text from SHA-256 of the given columns."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000")) for c in cols]
    h = F.sha2(F.concat_ws("\u0001", *parts), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))

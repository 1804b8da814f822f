"""A deterministic source subset (``WITH s AS (SELECT … LIMIT n)``).

The reference takes "some" rows with an unordered LIMIT; here the subset
is the first ``n`` distinct keys in key order, so reruns agree.  The
subset has at most ``n`` rows, so it is broadcast into the semi join
without a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.plans.broadcast import bounded_broadcast


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n smallest distinct keys (top-k per task, then merged)."""
    return df.select(key).distinct().orderBy(key).limit(n)


def restrict_to(df: DataFrame, keys: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``: a semi join, broadcast when
    the key set is within the checked bound.  ``bounded`` says that the set
    is limited already (``first_keys``): no job runs to check it."""
    return df.join(F.broadcast(keys) if bounded else bounded_broadcast(keys), key, "left_semi")

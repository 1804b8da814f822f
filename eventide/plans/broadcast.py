"""Broadcast a join side only behind a proven size bound.

``bounded_broadcast`` runs one bounded job over at most ``max_rows + 1``
rows of the side (``limit``: every task stops early) that returns their
count and their actual byte size (string/binary lengths measured, fixed
widths for the rest).  It hints a broadcast only when the side has at most
``max_rows`` rows *and* at most ``max_bytes`` bytes.  Beyond either bound
the side is returned unchanged and Catalyst/AQE plan a shuffle join, with
AQE skew-join splitting hot partitions of the big side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Default bounds: a dimension this small costs every executor a few MB.
DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 << 20


# Bytes of fixed-width values (as stored in a row).
_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
                T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
                T.DecimalType: 16}


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    t = field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        w = F.octet_length(c)
    elif isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        w = F.octet_length(F.to_json(c))
    else:
        w = F.lit(_FIXED_WIDTH.get(type(t), 8))
    return F.coalesce(w, F.lit(0)).cast("long")


def side_size(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> tuple[int, int]:
    """(rows, bytes) of at most max_rows + 1 rows of ``df`` — one bounded job."""
    sample = df.limit(max_rows + 1)
    width = None
    for f in df.schema.fields:
        w = _width(f)
        width = w if width is None else width + w
    width = width if width is not None else F.lit(0)
    row = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).collect()[0]
    return int(row["n"]), int(row["b"])


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    rows, nbytes = side_size(df, max_rows)
    return F.broadcast(df) if rows <= max_rows and nbytes <= max_bytes else df

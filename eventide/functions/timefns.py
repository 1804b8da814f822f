"""Time arithmetic on Columns that works for both TIMESTAMP and TIMESTAMP_NTZ.

Everything is a built-in Catalyst expression, so it stays inside
whole-stage codegen and (for comparisons against literals) is pushed to
the Parquet scan.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _type_of(df: DataFrame | None, col: str | None):
    if df is None or col is None:
        return T.TimestampNTZType()
    return df.schema[col].dataType


def ts_literal(value, like: T.DataType | None = None) -> Column:
    """A timestamp literal of the same type as the column it is compared to.

    A string is cast (constant-folded by Catalyst), so no Python-side time
    zone conversion happens and the comparison needs no cast on the column,
    which keeps the predicate pushable.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    typ = like if like is not None else T.TimestampNTZType()
    if isinstance(typ, T.DateType):
        return F.lit(str(value)[:10]).cast("date")
    return F.lit(str(value)).cast(typ)


_UNIT_US = {
    "microsecond": 1, "millisecond": 1000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str | int | float) -> int:
    """'4 hours' / '30 minutes' / 90 (seconds) -> microseconds."""
    if isinstance(text, (int, float)):
        return int(round(text * 1_000_000))
    total = 0
    for num, unit in re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text):
        u = unit.lower().rstrip("s")
        if u not in _UNIT_US:
            raise ValueError(f"unknown interval unit {unit!r}")
        total += int(round(float(num) * _UNIT_US[u]))
    if total <= 0:
        raise ValueError(f"bad interval {text!r}")
    return total


def avg_seconds(sum_us: Column, n: Column, digits: int | None = None) -> Column:
    """Average of microsecond durations, in seconds, from (exact sum, count).

    With ``digits`` the average is rounded half away from zero exactly (as
    NUMERIC rounding does), using integer division on DECIMAL(38,0), so no
    binary floating-point error decides a tie.
    """
    if digits is None:
        return sum_us.cast("double") / n.cast("double") / F.lit(1e6)
    scale = 10 ** digits
    n_dec = n.cast("decimal(38,0)")
    num = F.abs(sum_us) * F.lit(2 * scale) + n_dec * F.lit(1_000_000)
    den = n_dec * F.lit(2_000_000)
    q = F.call_function("div", num, den)  # integral division, exact
    return F.when(n > 0, F.signum(sum_us.cast("double")) * q.cast("double") / F.lit(float(scale)))


def add_seconds(ts: Column | str, seconds: Column) -> Column:
    """ts + seconds (double), rounded to the microsecond."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.round(seconds * F.lit(1e6)).cast("long"), ts)


def trunc_ts(unit: str, ts: Column | str, typ: T.DataType | None = None) -> Column:
    """date_trunc that keeps the input's timestamp type (Spark returns LTZ)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    out = F.date_trunc(unit, ts)
    if typ is None or isinstance(typ, T.TimestampNTZType):
        out = out.cast("timestamp_ntz")
    return out


def day_of(ts: Column | str) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def hour_of(ts: Column | str) -> Column:
    """Hour of day as BIGINT (what SQL EXTRACT returns)."""
    return F.hour(F.col(ts) if isinstance(ts, str) else ts).cast("long")


def month_key(ts: Column | str) -> Column:
    """Partition key of a timestamp: 'YYYY_MM'."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy_MM")


def month_of_key(name: Column | str, prefix: str = "events_") -> Column:
    """Inverse of the partition name: 'events_2024_01' -> DATE 2024-01-01."""
    name = F.col(name) if isinstance(name, str) else name
    return F.to_date(F.regexp_extract(name, re.escape(prefix) + r"([0-9]{4}_[0-9]{2})", 1), "yyyy_MM")


# The unit ladder of a human-readable byte size, and the
# limit below which a unit is kept (10 * 1024 of it).
_SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]
_SIZE_LIMIT = 10 * 1024


def size_pretty(nbytes: Column | str) -> Column:
    """Human-readable byte size ('812 bytes', '10 kB', '3 MB', ...).

    Integer rule: bytes are shown below 10240; otherwise the value is
    halved-and-rounded in the next unit (shift by 9 bits, then +1 and
    halve, rounding half away from zero) and a unit is kept while that
    pre-rounding value stays below 2 * 10240 - 1; each further unit
    shifts by another 10 bits.
    """
    b = (F.col(nbytes) if isinstance(nbytes, str) else nbytes).cast("long")
    limit2 = 2 * _SIZE_LIMIT - 1

    def half_round(x: Column) -> Column:
        return F.when(x >= 0, F.floor((x + F.lit(1)) / F.lit(2))).otherwise(-F.floor((-x + F.lit(1)) / F.lit(2)))

    def text(v: Column, unit: str) -> Column:
        return F.concat(v.cast("long").cast("string"), F.lit(" " + unit))

    out = F.when(F.abs(b) < F.lit(_SIZE_LIMIT), text(b, _SIZE_UNITS[0]))
    x = F.shiftright(b, 9)
    for i, unit in enumerate(_SIZE_UNITS[1:], start=1):
        last = i == len(_SIZE_UNITS) - 1
        cond = F.lit(True) if last else (F.abs(x) < F.lit(limit2))
        out = out.when(cond, text(half_round(x), unit))
        x = F.shiftright(x, 10)
    return F.when(b.isNotNull(), out)


def exact_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """round(100 * part / whole, digits) for non-negative integer counts,
    half away from zero, exact (integer division), NULL when whole = 0."""
    sc = 10 ** digits
    p = part.cast("decimal(38,0)")
    w = whole.cast("decimal(38,0)")
    q = F.call_function("div", p * F.lit(200 * sc) + w, w * F.lit(2))
    return F.when(w > 0, q.cast("double") / F.lit(float(sc)))


def round_dec(x: Column, digits: int = 2) -> Column:
    """ROUND(x::numeric, digits) for a DOUBLE: decimal rounding of the value,
    half away from zero, returned as DOUBLE."""
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")

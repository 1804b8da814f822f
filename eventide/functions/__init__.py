"""Column-level helpers (scalar functions and predicates)."""

from eventide.functions.timefns import (  # noqa: F401
    ts_literal, trunc_ts, day_of, hour_of, month_key,
    month_of_key, add_seconds, avg_seconds, exact_pct, round_dec, size_pretty, interval_micros,
)
from eventide.functions.jsonmatch import json_contains, json_text_eq  # noqa: F401

"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from tallyspark.functions.time import (day_start, period_start, ts_lit, minus_days,
                                       since_days_before, as_of_lit)
from tallyspark.functions.json import json_scalar, parse_json_rows
from tallyspark.functions.keys import surrogate_key
from tallyspark.functions.numeric import round_doubles, to_tokens

__all__ = [
    "day_start", "period_start", "ts_lit", "minus_days", "since_days_before", "as_of_lit",
    "json_scalar", "parse_json_rows", "surrogate_key", "round_doubles", "to_tokens",
]

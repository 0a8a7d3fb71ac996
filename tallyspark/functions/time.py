"""Time helpers.

Facts are ``timestamp_ntz`` (wall-clock UTC). ``date_trunc`` returns a
session-zone timestamp, so results are cast back to ``timestamp_ntz``; with the
session zone pinned to UTC the cast is exact.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "quarter")


def ts_lit(value: str | _dt.datetime) -> Column:
    """``timestamp 'YYYY-MM-DD[ hh:mm:ss]'`` as a ``timestamp_ntz`` literal (folded by Catalyst)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def day_start(c: Column | str) -> Column:
    """``date_trunc('day', ts)`` kept as ``timestamp_ntz``."""
    return period_start("day", c)


def period_start(period: str, c: Column | str) -> Column:
    """``date_trunc(period, ts)``; weeks start on Monday."""
    if period not in PERIODS and period not in ("hour", "year"):
        raise ValueError(f"unknown period {period!r}")
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc(period, col).cast("timestamp_ntz")


def minus_days(c: Column, days: int) -> Column:
    """``date_add('day', -n, ts)`` keeping the timestamp type.

    Spark's ``date_add`` returns a DATE, which would drop the time of day.
    """
    return c - F.expr(f"INTERVAL {int(days)} DAYS")


def as_of_lit(as_of: str | _dt.datetime | None) -> Column:
    """The ``now()`` of a run: the given instant, or the current timestamp."""
    if as_of is None:
        return F.localtimestamp()
    return ts_lit(as_of)


def since_days_before(as_of: str | _dt.datetime | None, days: int) -> Column:
    """``now() - interval 'n' day`` as a timestamp_ntz expression."""
    return minus_days(as_of_lit(as_of), days)


# Name of the day partition column of fact sources laid out as ``block_date=YYYY-MM-DD``.
DATE_PARTITION = "block_date"


def time_bound(df, time_col: str, lower, strict: bool = False, date_partition: str | None = DATE_PARTITION):
    """``time_col >= lower`` (``>`` when ``strict``), plus the implied
    ``date_partition >= date(lower)`` when the source has that column.

    A bound on the event time alone cannot prune a day-partitioned source;
    the implied bound on the partition column becomes a ``PartitionFilter``,
    so an incremental run lists and opens only the lookback days.
    """
    lo = lower if isinstance(lower, Column) else ts_lit(lower)
    cond = (F.col(time_col) > lo) if strict else (F.col(time_col) >= lo)
    if date_partition and date_partition in df.columns and date_partition != time_col:
        cond = cond & (F.col(date_partition) >= F.to_date(lo))
    return df.where(cond)

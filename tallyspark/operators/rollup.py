"""A10: sums by ``date_trunc(period, date)`` for day, week, month or quarter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.time import period_start


def rollup_by_period(df: DataFrame, date_col: str, period: str, sums: dict[str, str],
                     out_col: str = "aggregated_date", since: Column | None = None) -> DataFrame:
    """Group by the period start and sum each ``sums[out] = in`` column.

    Partial sums are combined map-side, so only one row per period and task
    crosses the shuffle, however skewed the periods are.
    """
    src = df if since is None else df.where(F.col(date_col) >= since)
    return (src.groupBy(period_start(period, date_col).alias(out_col))
            .agg(*[F.sum(F.col(c)).alias(o) for o, c in sums.items()]))

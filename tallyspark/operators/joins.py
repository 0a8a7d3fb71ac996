"""Join helpers.

Broadcast is used only for sides whose row count is known and bounded when the
plan is built (e.g. a literal dimension). Every other join is left to Catalyst
and AQE: AQE measures the real shuffle output and turns a sort-merge join into
a broadcast join only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
so a side that grows with the data keeps the shuffle path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side with a proven row bound up to this size is broadcast explicitly.
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(dim: DataFrame, known_rows: int | None) -> DataFrame:
    """Broadcast hint only when the caller proves ``known_rows`` is small."""
    if known_rows is not None and known_rows <= MAX_BROADCAST_ROWS:
        return F.broadcast(dim)
    return dim


def broadcast_dim_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                       known_rows: int | None, how: str = "inner") -> DataFrame:
    """Fact ⋈ small dimension; the fact side is never shuffled when the hint applies."""
    return fact.join(bounded_broadcast(dim, known_rows), on, how)


def price_token(token: Column) -> Column:
    """Canonical price token; wrapped SOL is priced as SOL.

    Turns ``token = p.token OR (token = 'wsol' AND p.token = 'sol')`` into one
    equi key, so the join is a plain hash join instead of date-only + residual.
    """
    return F.when(token == F.lit("wsol"), F.lit("sol")).otherwise(token)


def dim_left_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Source ⟕ staged dimension."""
    return fact.join(dim, on, "left")


def time_bounded_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      left_time: str, right_time: str, since: Column) -> DataFrame:
    """Equi join with the time bound applied on both sides before the join.

    Each side is filtered at its own scan (pushed to parquet); only the
    surviving rows shuffle on the join key.
    """
    l = left.where(F.col(left_time) >= since)
    r = right.where(F.col(right_time) >= since)
    return l.join(r, l[left_key] == r[right_key], "inner")

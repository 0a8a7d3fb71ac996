"""Pure forms of the incremental write strategies.

Each takes the current target and a new batch and returns the next state of
the target (or, for append, the rows to add). Keys compare with plain ``=``:
a NULL key never matches, so such rows are inserted again, as in the source
engine. ``target_pred`` limits which target rows may match (the
``incremental_predicates`` of the models); target rows outside it are carried
over unchanged and their keys can be inserted a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.time import minus_days, period_start


def unmatched_target(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                     target_pred: Column | None = None) -> DataFrame:
    """Target rows no batch row replaces (left anti join on the keys).

    ``target_pred`` is evaluated on the target's own columns before the join;
    a row where it is false or NULL cannot match and is kept.
    """
    t = target
    if target_pred is not None:
        t = t.withColumn("_in_scope", F.coalesce(target_pred, F.lit(False)))
    bk = batch.select(*[F.col(k).alias(f"_b_{k}") for k in keys])
    cond = None
    for k in keys:
        c = t[k] == bk[f"_b_{k}"]
        cond = c if cond is None else cond & c
    if target_pred is not None:
        cond = cond & t["_in_scope"]
    out = t.join(bk, cond, "left_anti")
    return out.drop("_in_scope") if target_pred is not None else out


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str],
          target_pred: Column | None = None) -> DataFrame:
    """K3: matched target rows are replaced by the batch, the rest stay; never deletes."""
    return unmatched_target(target, batch, keys, target_pred).unionByName(batch.select(*target.columns))


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  target_pred: Column | None = None) -> DataFrame:
    """K4: drop target rows whose key is in the batch (inside the predicate), insert all batch rows."""
    return merge(target, batch, keys, target_pred)


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str],
             target_pred: Column | None = None) -> DataFrame:
    """Batch rows whose key is absent from the target's window (first write wins)."""
    t = target if target_pred is None else target.where(target_pred)
    return batch.join(t.select(*keys), list(keys), "left_anti")


def append_dedup(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                 target_pred: Column | None = None) -> DataFrame:
    """K5: the target after appending only the new rows."""
    return target.unionByName(new_rows(target, batch, keys, target_pred).select(*target.columns))


def merge_conflicts(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                    target_pred: Column | None = None) -> DataFrame:
    """Keys where more than one batch row would match one target row (a merge must fail)."""
    dup = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    t = target if target_pred is None else target.where(target_pred)
    return dup.join(t.select(*keys), list(keys), "left_semi")


# ---- watermarks and cutoffs (S7, T1, T2) ----

def watermark(target: DataFrame, col: str):
    """``max(col)`` of the target, or None when it is empty (one tiny aggregate job).

    Parquet row-group statistics answer this from footers when the column is
    stored with statistics; the result is a single value.
    """
    return target.agg(F.max(col).alias("m")).first()["m"]


def lookback_cutoff(target: DataFrame | None, col: str, days: int, period: str = "day"):
    """``date_trunc(period, max(col) - days)``; None means "first run"."""
    if target is None:
        return None
    row = target.agg(period_start(period, minus_days(F.max(col), days)).alias("c")).first()
    return row["c"]

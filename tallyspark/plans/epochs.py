"""M2: epoch boundaries numbered from the Voting reward times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.time import day_start, time_bound
from tallyspark.operators.numbering import sequence_number
from tallyspark.params import Params

VOTING = "Voting"


def voting_times(rewards: DataFrame, last_time=None) -> DataFrame:
    """Distinct Voting block times, strictly after the watermark if given.

    ``distinct`` aggregates map-side first, so a block time carrying a third
    of all reward rows shrinks to one row per task before the shuffle.
    """
    f = rewards.where(F.col("reward_type") == F.lit(VOTING))
    if last_time is not None:
        f = time_bound(f, "block_time", last_time, strict=True)
    return f.select("block_time").distinct()


def epoch_info(rewards: DataFrame, p: Params, last_epoch: int | None = None,
               last_time=None) -> DataFrame:
    """One row per epoch: (epoch, epoch_end_time, date).

    Full build: epochs are ``epoch_offset + row_number`` (the first Voting time
    is epoch offset + 1, as the project's code does). Incremental: only times
    after ``last_time`` are numbered, continuing from ``last_epoch``; a late
    time older than the watermark is never numbered.
    """
    start = (p.epoch_offset if last_epoch is None else int(last_epoch)) + 1
    numbered = sequence_number(voting_times(rewards, last_time), "block_time", out_col="epoch", start=start)
    return numbered.select("epoch", F.col("block_time").alias("epoch_end_time"),
                           day_start("block_time").alias("date"))

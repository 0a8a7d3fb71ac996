"""The scheduled incremental run re-aimed as a file stream.

New fact files landing under a day-partitioned directory are picked up by a
file stream (``trigger(availableNow=True)`` for a scheduled run, or a
processing-time trigger for a continuous one). Each micro-batch only tells
*which days* it touches; the model is then rebuilt for exactly those days
from all landed data and merged into the target on its unique key. Model rows
depend only on facts of their own day, so a late file for an old day costs one
day, not the range up to today. Which files hold a day is kept in an index
beside the stream's checkpoint, a few rows for each micro-batch, so the rebuild
opens the files of its days only, be the landing folder partitioned or flat. The step is idempotent: replaying a micro-batch
after a failure recomputes and merges the same rows, so the stream's
checkpoint plus the merge give exactly-once results in the table.
"""

from __future__ import annotations

import datetime as dt
import json

from collections.abc import Callable, Sequence
from itertools import takewhile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.sinks.tables import literal_path, table_exists, write_merge, write_text

LANDING_PARTITION = "landing_day"


def land_event_files(spark: SparkSession, events: DataFrame, landing_dir: str, time_col: str = "ts",
                     mode: str = "errorifexists") -> str:
    """Write facts as day-partitioned files, the layout an upstream loader lands
    (``mode="append"`` adds a later wave, late days included)."""
    (events.withColumn(LANDING_PARTITION, F.col(time_col).cast("date"))
     .hint("rebalance", LANDING_PARTITION)
     .write.mode(mode).partitionBy(LANDING_PARTITION).parquet(landing_dir))
    return landing_dir


def _write_index(spark: SparkSession, rows: DataFrame, index: str, batch: str) -> list:
    """Keep the distinct (day, file) of a micro-batch, which are few; a replayed batch replaces its own part.
    Returns the days."""
    found = [(r[0], r[1]) for r in rows.distinct().collect()]
    if found:
        write_text(spark, f"{index}/{batch}.json", "\n".join(json.dumps({"day": str(d), "file": f}) for d, f in found))
    return list({d for d, _ in found})


def stream_upsert(spark: SparkSession, landing_dir: str, schema: T.StructType, target_path: str,
                  build: Callable[[DataFrame, object], DataFrame], keys: Sequence[str],
                  checkpoint: str, time_col: str = "ts", lookback_days: int = 0,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  partition_col: str = LANDING_PARTITION, partition_by: Sequence[str] | None = None):
    """Run the stream until all landed files are processed (or return the handle).

    ``partition_col`` is the landing folder's day partition (``block_date``
    for fact sources). ``build(facts, since)`` is the model function: it receives the landed
    facts of the touched days (plus ``lookback_days`` before each) and their
    earliest midnight; its batch must be grouped on ``keys``. ``partition_by``
    lays out the target, so that a batch rewrites only the partitions of its days.
    """
    fields = [f for f in schema.fields if f.name != partition_col]
    full_schema = T.StructType(fields + [T.StructField(partition_col, T.DateType())])
    reader = spark.readStream.schema(full_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    names = {f.name.lower() for f in full_schema.fields}
    file = "_file"
    while file in names:
        file = f"_{file}"
    stream = reader.parquet(landing_dir).withColumn(file, F.col("_metadata.file_path"))
    index = f"{checkpoint.rstrip('/')}-day-files"
    # partition directories lie below the part of the address that is no pattern
    base = "/".join(takewhile(lambda part: not set(part) & set("*?[{"), landing_dir.split("/"))) or "/"
    # A row without a landing day (a flat folder, a NULL partition) takes it from its time column.
    own = F.coalesce(F.col(partition_col), F.to_date(F.col(time_col)))

    def upsert_batch(micro: DataFrame, epoch_id: int) -> None:
        def landed(*paths: str) -> DataFrame:
            return spark.read.schema(full_schema).option("basePath", base).parquet(*paths)

        if epoch_id > 0 and not table_exists(spark, index):
            # a checkpoint from before the index: list the days of all files once
            everything = landed(landing_dir)
            _write_index(spark, everything.select(own.alias("day"), F.col("_metadata.file_path").alias("file")), index, "earlier")
        found = _write_index(spark, micro.select(own.alias("day"), F.col(file).alias("file")), index, str(epoch_id))
        if None in found:
            raise ValueError(f"{landing_dir} has rows without {partition_col} and without {time_col}")
        if not found:
            return
        days = sorted(found)
        if lookback_days:
            days = sorted({d - dt.timedelta(days=i) for d in days for i in range(int(lookback_days) + 1)})
        known = spark.read.schema("day string, file string").json(index).where(F.col("day").isin([str(d) for d in days]))
        files = [literal_path(r[0]) for r in known.select("file").distinct().collect()]
        facts = landed(*files).where(own.isin(days)).drop(partition_col)
        since = F.lit(days[0].isoformat()).cast("timestamp_ntz")
        write_merge(spark, target_path, build(facts, since), keys, partition_by=partition_by, batch_keys_unique=True)

    writer = (stream.writeStream.foreachBatch(upsert_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
        return None
    return q

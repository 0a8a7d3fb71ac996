"""Stored upserts (K3-K6, K10, T8): what is read, what is written, and what a writer that dies leaves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.session import scratch_dir
from tallyspark.sinks import tables
from tallyspark.streaming import microbatch


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def days(spark, n, copies=3, start=0):
    base = F.lit("2024-01-01").cast("date")
    return spark.range(n * copies).select(F.date_add(base, (F.col("id") % n + start).cast("int")).alias("day"),
                                          F.col("id").alias("k"), (F.col("id") * 1.5).alias("v"))


@pytest.fixture
def plans(monkeypatch):
    """Plans of the frames whose rows come to the driver, up to the merge."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    seen, collect, bring_in = [], Classic.collect, tables._bring_in

    def collected(self):
        seen.append(self._jdf.queryExecution().toString())
        return collect(self)

    def brought(*a, **k):
        seen.append("merge")
        return bring_in(*a, **k)

    monkeypatch.setattr(Classic, "collect", collected)
    monkeypatch.setattr(tables, "_bring_in", brought)
    return seen


def test_merge_reads_no_row_of_the_target_before_the_merge(spark, plans):
    path = scratch_dir(spark, "no-scan")
    tables.write_table(days(spark, 30), path, partition_by=["day"])
    batch = days(spark, 3, start=28).withColumn("v", F.lit(-1.0))
    untouched = {f for d, (v,) in tables._partition_dirs(spark, path, 1) if v < "2024-01-28" for f in tables._files(spark, d)}
    tables.write_merge(spark, path, batch, ["day", "k"], partition_by=["day"])
    before = plans[:plans.index("merge")]
    name = path.rsplit("/", 1)[-1]
    assert before and not [p for p in before if f"/{name}" in p]
    assert untouched <= set(tables._files(spark, path))          # other partitions keep their very files
    got = tables.read_stored(spark, path, batch.schema)
    assert got.where("v = -1").count() == 9 and got.count() == 90 + 9 - batch.join(days(spark, 30), ["day", "k"]).count()


def test_more_than_a_thousand_partitions(spark):
    path, n = scratch_dir(spark, "many"), 1100
    spark.range(n).select((F.col("id") % n).cast("int").alias("p"), F.col("id").alias("k"), F.lit("a").alias("v")) \
        .coalesce(2).write.partitionBy("p").parquet(path)
    batch = spark.range(n + 5).select(F.col("id").cast("int").alias("p"), F.col("id").alias("k"), F.lit("b").alias("v"))
    tables.write_merge(spark, path, batch, ["p", "k"], partition_by=["p"], batch_keys_unique=True)
    got = tables.read_stored(spark, path, batch.schema)
    assert got.groupBy("v").count().collect() == [("b", n + 5)]


def test_partition_names_may_be_written_in_other_ways(spark):
    path = scratch_dir(spark, "odd-names")
    spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string").coalesce(1).write.parquet(f"{path}/m=01/s=a%2Fb c")
    spark.createDataFrame([(9, "old")], "k int, v string").coalesce(1).write.parquet(f"{path}/m=02/s={tables.NULL_PARTITION}")
    schema = "k int, v string, m int, s string"
    batch = spark.createDataFrame([(1, "new", 1, "a/b c"), (9, "new", 2, None), (9, "new", 3, "x")], schema)
    assert len(tables._touched_dirs(spark, path, batch, ["m", "s"])) == 2
    tables.write_delete_insert(spark, path, batch, ["k", "m"], partition_by=["m", "s"])
    assert rows(tables.read_stored(spark, path, batch.schema)) == sorted(
        [("1", "new", "1", "a/b c"), ("2", "old", "1", "a/b c"), ("9", "new", "2", "None"), ("9", "new", "3", "x")])


@pytest.mark.parametrize("partition_by", [["day"], None])
def test_append_that_stops_between_two_renames_is_finished_by_the_next_writer(spark, monkeypatch, partition_by):
    path = scratch_dir(spark, "half")
    one, two = days(spark, 4), days(spark, 4, copies=6)
    tables.write_table(one, path, partition_by=partition_by)
    moved, files = [], tables._files

    def some(spark, directory):
        found = files(spark, directory)
        if ".__part-" in directory.rsplit("/", 1)[-1] and not moved:
            moved.append(len(found))
            return found[:1] + [f"{found[0]}.absent"]        # the second move fails
        return found

    monkeypatch.setattr(tables, "_files", some)
    with pytest.raises(Exception):
        tables.write_append_new(spark, path, two.repartition(3), ["day", "k"], partition_by=partition_by)
    monkeypatch.setattr(tables, "_files", files)
    assert one.count() < tables.read_stored(spark, path).count() < two.count() or moved == [1]
    tables.write_append_new(spark, path, two, ["day", "k"], partition_by=partition_by)
    assert rows(tables.read_stored(spark, path, two.schema)) == rows(two)
    assert not tables._glob(spark, f"{path}.__*")


def test_compaction_writes_exactly_the_planned_files_without_a_sample(spark):
    path = scratch_dir(spark, "compact")
    df = spark.range(6000).select((F.col("id") % 3).cast("int").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    df.repartition(8).write.partitionBy("p").parquet(path)
    spark.range(10).select(F.lit(7).alias("p"), F.lit("x").alias("t")).repartition(5).write.mode("append").partitionBy("p").parquet(path)
    size = tables.partition_stats(spark, path, 1)
    want = {v: max(1, -(-b // 60_000)) for v, (_, b) in size.items()}
    assert sorted(want.values())[0] == 1 and max(want.values()) > 1
    group, schema = "compaction-jobs", spark.read.parquet(path).select("p", "t").schema
    spark.sparkContext.setJobGroup(group, group)
    assert tables.compact(spark, path, ["p"], target_file_bytes=60_000, schema=schema) == 4
    stages = [s for j in spark.sparkContext.statusTracker().getJobIdsForGroup(group) for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # the small layout, the rows dealt out, the files: no job that samples them
    assert len(set(stages)) <= 4
    assert {v: n for v, (n, _) in tables.partition_stats(spark, path, 1).items()} == want
    assert rows(spark.read.parquet(path).select("p", "t")) == rows(df.union(spark.range(10).select(F.lit(7), F.lit("x"))))
    assert tables.compact(spark, path, ["p"], target_file_bytes=60_000, min_files=3) in (0, 1, 2, 3)


def test_a_flat_landing_folder_is_opened_by_day(spark, monkeypatch):
    root = scratch_dir(spark, "flat")
    landing, target = f"{root}/flat landing", f"{root}/target"
    schema = "ts timestamp_ntz, k bigint, landing_day date"

    def land(day, ks, mode="append"):
        spark.createDataFrame([(dt.datetime.fromisoformat(f"{day} 10:00:00"), k) for k in ks], "ts timestamp_ntz, k bigint") \
            .coalesce(1).write.mode(mode).parquet(landing)

    opened = []

    def build(facts, since):
        opened.append(sorted(facts.inputFiles()))
        return facts.groupBy(F.col("ts").cast("date").alias("day")).agg(F.sum("k").alias("total"))

    from pyspark.sql.types import StructType
    full = StructType.fromDDL(schema)

    def run():
        microbatch.stream_upsert(spark, landing, full, target, build, ["day"], f"{root}/_ckpt", partition_by=["day"])

    for i, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-03"]):
        land(day, [i + 1])
    run()
    assert len(opened) == 1 and len(opened[0]) == 3
    land("2024-01-02", [10])
    run()
    assert len(opened) == 2 and len(opened[1]) == 2               # the two files of that day, not all four
    assert rows(tables.read_stored(spark, target).select("day", "total")) == [
        ("2024-01-01", "1"), ("2024-01-02", "12"), ("2024-01-03", "3")]

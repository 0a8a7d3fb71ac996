"""Writes, JSON bodies, streams and checks lose nothing: NULL partitions, missing columns, crashes, bad bodies."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.json import json_scalar, parse_json_rows
from tallyspark.operators import checks
from tallyspark.session import scratch_dir
from tallyspark.sinks import tables
from tallyspark.streaming.microbatch import stream_upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_partition_and_missing_column(spark):
    path = scratch_dir(spark, "t-null")
    schema = "k int, a string, b string, v int, extra string"
    tables.write_table(spark.createDataFrame([(1, None, "x", 1, "keep"), (2, "p", "x", 2, "keep")], schema), path, ["a", "b"])
    batch = spark.createDataFrame([(3, None, "x", 3)], "k int, a string, b string, v int")
    tables.write_merge(spark, path, batch, ["k"], ["a", "b"])
    got = tables.read_stored(spark, path).select("k", "a", "b", "v", "extra")
    assert rows(got) == rows(spark.createDataFrame(
        [(1, None, "x", 1, "keep"), (2, "p", "x", 2, "keep"), (3, None, "x", 3, None)], schema))
    with pytest.raises(ValueError, match="no column"):
        tables.write_merge(spark, path, batch.withColumn("new", F.lit(1)), ["k"], ["a", "b"])


def test_one_row_batch_touches_one_partition(spark):
    path = scratch_dir(spark, "t-one")
    df = spark.range(100).select("id", (F.col("id") % 10).alias("p"), F.lit(0).alias("v"))
    tables.write_table(df, path, ["p"])
    before = set(tables.read_stored(spark, path).inputFiles())
    tables.write_merge(spark, path, df.where("id = 7").withColumn("v", F.lit(1)), ["id"], ["p"])
    after = set(tables.read_stored(spark, path).inputFiles())
    assert {f.split("/")[-2] for f in before ^ after} == {"p=7"}
    assert tables.read_stored(spark, path).where("v = 1").count() == 1 and tables.read_stored(spark, path).count() == 100


def test_a_moved_row_leaves_its_old_partition(spark):
    path = scratch_dir(spark, "t-move")
    tables.write_table(spark.createDataFrame([(1, 1)], "k int, p int"), path, ["p"])
    tables.write_merge(spark, path, spark.createDataFrame([(1, 2)], "k int, p int"), ["k"], ["p"])
    assert rows(tables.read_stored(spark, path).select("k", "p")) == [(1, 2)]


@pytest.mark.parametrize("step", ["first move", "delete"])
def test_crash_while_files_move_in(spark, monkeypatch, step):
    path = scratch_dir(spark, "t-crash")
    df = spark.range(20).select("id", (F.col("id") % 2).alias("p"), F.lit(0).alias("v"))
    tables.write_table(df, path, ["p"])
    real = tables._move_in

    def dies(spark_, staged, table):
        if step == "delete":  # files are in, old ones still there
            fs, _, jvm = tables._fs(spark_, staged)
            for f in tables._files(spark_, staged):
                fs.rename(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.hadoop.fs.Path(table + f[len(staged):]))
        raise IOError("lost")

    monkeypatch.setattr(tables, "_move_in", dies)
    with pytest.raises(IOError):
        tables.write_merge(spark, path, df.where("id < 4").withColumn("v", F.lit(1)), ["id"], ["p"])
    monkeypatch.setattr(tables, "_move_in", real)
    tables.recover(spark, path)
    got = tables.read_stored(spark, path)
    assert got.count() == 20 and got.where("v = 1").count() == 4


def test_swap_recovers_only_from_a_ready_copy(spark):
    path = scratch_dir(spark, "t-swap")
    one = spark.range(3)
    one.write.parquet(f"{path}.__old-1")
    assert not tables.table_exists(spark, path)
    tables.recover(spark, path)
    assert not tables.table_exists(spark, path)
    one.write.parquet(f"{path}.__ready-2")
    assert tables.table_exists(spark, path) and tables.read_stored(spark, path).count() == 3
    tables.recover(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_compaction_converges(spark):
    path = scratch_dir(spark, "t-compact")
    df = spark.range(20000).select("id", (F.col("id") % 2).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    df.repartition(12).write.partitionBy("p").parquet(path)
    assert tables.compact(spark, path, ["p"], target_file_bytes=300_000, schema=df.schema) == 2
    files = tables.file_counts(spark, path)
    assert tables.compact(spark, path, ["p"], target_file_bytes=300_000, schema=df.schema) == 0
    assert files == tables.file_counts(spark, path) and all(2 <= n <= 4 for n in files.values())
    assert tables.read_stored(spark, path).count() == 20000


def test_bad_bodies_raise(spark):
    for body in ('{"error": "limit"}', "<html>", '[{"a": 1}, {"a"', "[1, 2"):
        df = spark.createDataFrame([(body,)], "body string")
        with pytest.raises(Exception, match="not a JSON array"):
            parse_json_rows(df, "body", {"a": "int"}).collect()
    fine = spark.createDataFrame([('[{"a": 1}]',), ("null",), (None,), ("[]",)], "body string")
    assert rows(parse_json_rows(fine, "body", {"a": "int"})) == [(1,)]


def test_a_string_that_begins_with_a_bracket_is_a_string(spark):
    df = spark.createDataFrame([('{"a": "[abc"}',), ('{"a": [1]}',), ('{"a": "{x"}',), ('{"a": {"b": 1}}',)], "e string")
    assert [r[0] for r in df.select(json_scalar(F.col("e"), "a")).collect()] == ["[abc", None, "{x", None]


def test_flat_landing_folder(spark):
    landing, target, ckpt = (scratch_dir(spark, n) for n in ("t-flat", "t-flat-out", "t-flat-ckpt"))
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3)), (2, dt.datetime(2024, 1, 3, 4))], "id int, ts timestamp_ntz")
    ev.write.parquet(landing)
    stream_upsert(spark, landing, ev.schema, target,
                  lambda f, since: f.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n")), ["day"], ckpt)
    assert spark.read.parquet(target).count() == 2


def test_rebuild_check_at_any_parallelism(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.1).alias("x"))
    one = df.coalesce(1).groupBy("g").agg(F.sum("x").alias("s"))
    many = df.repartition(16).groupBy("g").agg(F.sum("x").alias("s"))
    assert tuple(checks.rebuild_equals_incremental("m", one, many).first()) == ("m", 7, 7, 0)
    wrong = many.withColumn("s", F.when(F.col("g") == 3, F.col("s") + 0.01).otherwise(F.col("s")))
    assert checks.rebuild_equals_incremental("m", one, wrong).first()["n_diff"] == 2
    gone = many.withColumn("s", F.when(F.col("g") != 3, F.col("s")))
    assert checks.rebuild_equals_incremental("m", one, gone).first()["n_diff"] == 2


def test_json_bodies_of_every_kind(spark, monkeypatch):
    from tallyspark.functions import json as J
    good = ['[{"a": 1, "b": "[x", "c": {"d": 1}}, {"a": null}, 5, "s", null, [1]]', " [ ] ", "null", None, '[{"a": 2, "b": true, "c": [1]}]']
    df = spark.createDataFrame([(b,) for b in good], "body string")
    want = sorted([("1", "[x", "None")] + [("None", "None", "None")] * 5 + [("2", "true", "None")])
    for limit in (J.WHOLE_BODY_CHARS, 3):     # short bodies as one value, long ones element by element
        monkeypatch.setattr(J, "WHOLE_BODY_CHARS", limit)
        assert rows(J.parse_json_rows(df, "body", {"a": "int", "b": "string", "c": "string"}).selectExpr(
            "cast(a as string)", "b", "c").na.fill("None")) == want
        assert [r[0] for r in df.select(F.size(J.json_elements(F.col("body")))).collect()] == [6, 0, None, None, 1]
        for bad in ('{"error": 1}', '[{"a": 1}', "<html>", "", '[1] x'):
            with pytest.raises(Exception, match="response body is not a JSON array"):
                J.parse_json_rows(spark.createDataFrame([(bad,)], "body string"), "body", {"a": "int"}).collect()

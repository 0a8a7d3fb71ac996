"""Write strategies: pure forms and stored tables (K1-K10, J5, J9, Q-style checks)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import upsert
from tallyspark.session import scratch_dir
from tallyspark.sinks import tables

D = dt.date
SCHEMA = "k bigint, d date, v bigint"
KEYS = ["k", "d"]


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted((r.k, r.d, r.v) for r in df.collect())


def test_merge_replaces_matched_and_keeps_rest(spark):
    t = _df(spark, [(1, D(2024, 1, 1), 10), (2, D(2024, 1, 2), 20)])
    b = _df(spark, [(2, D(2024, 1, 2), 21), (3, D(2024, 1, 3), 30)])
    assert _rows(upsert.merge(t, b, KEYS)) == [(1, D(2024, 1, 1), 10), (2, D(2024, 1, 2), 21),
                                               (3, D(2024, 1, 3), 30)]


def test_null_keys_never_match(spark):
    t = _df(spark, [(None, D(2024, 1, 1), 1)])
    b = _df(spark, [(None, D(2024, 1, 1), 2)])
    for op in (upsert.merge, upsert.delete_insert, upsert.append_dedup):
        assert len(_rows(op(t, b, KEYS))) == 2


def test_predicate_narrower_than_batch_duplicates(spark):
    t = _df(spark, [(1, D(2024, 1, 1), 1), (2, D(2024, 1, 2), 2)])
    b = _df(spark, [(1, D(2024, 1, 1), 9), (2, D(2024, 1, 2), 9)])
    pred = F.col("d") >= F.lit("2024-01-02").cast("date")
    got = _rows(upsert.merge(t, b, KEYS, pred))
    assert got == [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 1), 9), (2, D(2024, 1, 2), 9)]
    # append: first write wins inside the window; the old key outside is appended again
    got = _rows(upsert.append_dedup(t, b, KEYS, pred))
    assert got == [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 1), 9), (2, D(2024, 1, 2), 2)]


def test_delete_insert_keeps_batch_duplicates(spark):
    t = _df(spark, [(1, D(2024, 1, 1), 1)])
    b = _df(spark, [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 1), 6)])
    assert _rows(upsert.delete_insert(t, b, KEYS)) == [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 1), 6)]


def test_stored_merge_raises_on_two_matches(spark):
    path = scratch_dir(spark, "t-conflict")
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path, partition_by=["d"])
    b = _df(spark, [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 1), 6)])
    with pytest.raises(ValueError):
        tables.write_merge(spark, path, b, KEYS, partition_by=["d"])
    tables.write_delete_insert(spark, path, b, KEYS, partition_by=["d"])   # allowed
    assert len(_rows(tables.read_stored(spark, path, b.schema))) == 2


def test_stored_merge_touches_only_batch_partitions(spark):
    path = scratch_dir(spark, "t-parts")
    t = _df(spark, [(k, D(2024, 1, d), k * d) for k in range(3) for d in (1, 2, 3)])
    tables.write_table(t, path, partition_by=["d"])
    before = tables.file_counts(spark, path)
    b = _df(spark, [(0, D(2024, 1, 3), 100), (7, D(2024, 1, 3), 700)])
    tables.write_merge(spark, path, b, KEYS, partition_by=["d"])
    after = tables.file_counts(spark, path)
    untouched = [p for p in before if not p.endswith("d=2024-01-03")]
    assert all(after[p] == before[p] for p in untouched)
    got = _rows(tables.read_stored(spark, path, b.schema))
    assert (0, D(2024, 1, 3), 100) in got and (7, D(2024, 1, 3), 700) in got and len(got) == 10
    # replaying the same batch changes nothing
    tables.write_merge(spark, path, b, KEYS, partition_by=["d"])
    assert _rows(tables.read_stored(spark, path, b.schema)) == got


def test_stored_append_is_idempotent(spark):
    path = scratch_dir(spark, "t-append")
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path, partition_by=["d"])
    b = _df(spark, [(1, D(2024, 1, 1), 9), (2, D(2024, 1, 1), 2)])
    tables.write_append_new(spark, path, b, KEYS, partition_by=["d"])
    tables.write_append_new(spark, path, b, KEYS, partition_by=["d"])
    assert _rows(tables.read_stored(spark, path, b.schema)) == [(1, D(2024, 1, 1), 1), (2, D(2024, 1, 1), 2)]


def test_unpartitioned_merge_never_overwrites_in_place(spark):
    path = scratch_dir(spark, "t-flat")
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path)
    tables.write_merge(spark, path, _df(spark, [(1, D(2024, 1, 1), 2), (3, D(2024, 1, 1), 3)]), KEYS)
    assert _rows(tables.read_stored(spark, path)) == [(1, D(2024, 1, 1), 2), (3, D(2024, 1, 1), 3)]


def test_full_rebuild_replaces_table(spark):
    path = scratch_dir(spark, "t-rebuild")
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path)
    tables.write_table(_df(spark, [(2, D(2024, 1, 2), 2)]), path)
    assert _rows(tables.read_stored(spark, path)) == [(2, D(2024, 1, 2), 2)]


def test_compact_reduces_files_and_keeps_rows(spark):
    path = scratch_dir(spark, "t-compact")
    df = spark.range(0, 2000).select(F.col("id").alias("k"),
                                     F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int"))
                                     .alias("d"), (F.col("id") * 2).alias("v"))
    df.repartition(6).write.partitionBy("d").parquet(path)      # fragmented, as a plain writer leaves it
    assert max(tables.file_counts(spark, path).values()) > 1
    n = tables.compact(spark, path, partition_by=["d"], schema=df.schema)
    assert n == 3
    assert max(tables.file_counts(spark, path).values()) == 1
    assert tables.read_stored(spark, path, df.schema).exceptAll(df).count() == 0
    assert tables.read_stored(spark, path, df.schema).count() == 2000


def test_interrupted_swap_is_recovered(spark):
    path = scratch_dir(spark, "t-swap")
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path)
    fs, p, jvm = tables._fs(spark, path)
    tables.write_table(_df(spark, [(1, D(2024, 1, 1), 1)]), path + "-new")
    fs.rename(jvm.org.apache.hadoop.fs.Path(path + "-new"), jvm.org.apache.hadoop.fs.Path(path + ".__ready-deadbeef"))
    fs.rename(p, jvm.org.apache.hadoop.fs.Path(path + ".__old-deadbeef"))   # died after the first rename
    assert tables.table_exists(spark, path)
    assert _rows(tables.read_stored(spark, path)) == [(1, D(2024, 1, 1), 1)]

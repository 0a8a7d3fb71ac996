"""Plan shapes that matter at scale (checked with explain, no data volume needed)."""

import io
import contextlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF_SMALL
from tallyspark import catalog
from tallyspark.operators import upsert
from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import blocks, epochs
from tallyspark.session import scratch_dir
from tallyspark.sinks import tables
from tallyspark.sources.fixtures import load_sources


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_product_revenue_broadcasts_mapping_and_pushes_filters(spark):
    s = load_sources(spark, SF_SMALL)
    p = plan(catalog._product(s))
    assert "BroadcastHashJoin Inner" in p
    assert "GreaterThanOrEqual(ts,2023-06-01T00:00)" in p          # start date reaches the scan
    assert "Not(EqualTo(event_type,error))" in p                   # tx_success reaches the scan
    assert "partial_sum" in p                                      # map-side combine before the shuffle
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_epoch_numbering_has_no_single_partition_over_rows(spark):
    s = load_sources(spark, SF_SMALL)
    p = plan(epochs.epoch_info(s.rewards, P), "simple")
    assert "row_number() windowspecdefinition(_bucket" in p
    # the only single-partition exchange sits on the per-bucket counts
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[_bucket" in lines[i + 1]


def test_rolling_window_is_a_partition_filter(spark):
    s = load_sources(spark, SF_SMALL)
    path = scratch_dir(spark, "plan-tx")
    tables.write_table(s.transactions, path, partition_by=["block_date"])
    stored = tables.read_stored(spark, path, s.transactions.schema)
    p = plan(blocks.tx_per_block(stored, catalog.AS_OF, 1))
    assert "PartitionFilters: [isnotnull(block_date" in p and "block_date" in p.split("PartitionFilters")[1]


def test_append_dedup_uses_left_anti(spark):
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    b = spark.createDataFrame([(1, 2), (2, 2)], "k int, v int")
    assert "LeftAnti" in plan(upsert.new_rows(t, b, ["k"]))
    assert "LeftAnti" in plan(upsert.merge(t, b, ["k"]))


@pytest.mark.parametrize("name", ["M1", "M2", "M6", "M10", "J2", "J8", "A9", "Q1", "Q6", "O2"])
def test_no_cartesian_products(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_incremental_bound_prunes_day_partitions(spark):
    """A lookback on block_time also bounds a block_date-partitioned source."""
    from tallyspark.sources.readers import ACTIVITY_SCHEMA, read_source
    s = load_sources(spark, SF_SMALL)
    path = scratch_dir(spark, "plan-act")
    s.activity.withColumn("block_date", F.to_date("block_time")).write.partitionBy("block_date").parquet(path)
    act = read_source(spark, path, ACTIVITY_SCHEMA)
    df = catalog.revenue.product_revenue(act, s.prices, s.mapping, P, since="2024-01-17 00:00:00",
                                         mapping_rows=s.mapping_rows)
    p = plan(df)
    part = p.split("PartitionFilters: [")[1].split("]")[0]
    assert "block_date" in part and "2024-01-17" in part
    full = catalog.revenue.product_revenue(s.activity, s.prices, s.mapping, P, since="2024-01-17 00:00:00",
                                           mapping_rows=s.mapping_rows)
    assert df.exceptAll(full).count() == 0 and full.exceptAll(df).count() == 0


def test_partitioned_writes_are_rebalanced(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "k int, d string")
    w = tables._writer(df, ["d"], None)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(w._df, "simple")      # the frame the writer will write
    assert "REBALANCE" not in plan(tables._writer(df, None, None)._df, "simple")


def test_json_bodies_are_parsed_once(spark):
    p = plan(E.queries()["S6"](spark, SF_SMALL), "simple")
    # the other parser in the plan reads the elements of bodies that are too long for one value
    assert p.count("VariantExpressionEvalUtils.parseJson(CASE") == 1 and p.count("parseJson(") == 2 and "parseJson(lambda" in p
    assert "json_tuple" not in p.split("Generate")[0]


def test_checks_of_a_table_read_it_once(spark):
    p = plan(E.queries()["Q6_wide"](spark, SF_SMALL), "simple")
    assert len([x for x in p.splitlines() if "FileScan" in x and "lineitem.parquet" in x]) == 1
    p = plan(E.queries()["Q6"](spark, SF_SMALL), "simple")
    assert len([x for x in p.splitlines() if "FileScan" in x and "lineitem.parquet" in x]) == 1


def test_rebuild_comparison_sorts_only_what_has_no_equal_partner(spark):
    from tallyspark.operators import checks
    a = spark.createDataFrame([("k", 1.0)], "k string, x double")
    p = plan(checks.rebuild_equals_incremental("m", a, a), "simple")
    assert "CartesianProduct" not in p and "NestedLoop" not in p and "partial_count" in p
    sort = [i for i, x in enumerate(p.splitlines()) if "Sort [" in x and "k#" in x]
    assert sort and any("Filter NOT" in x for x in p.splitlines()[sort[0]:])

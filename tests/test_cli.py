"""The command line on a production-shaped source layout."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from tallyspark import cli
from tallyspark.functions.numeric import round_doubles
from tallyspark.operators import checks
from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import revenue
from tallyspark.session import scratch_dir
from tallyspark.sinks.tables import read_stored
from tallyspark.sources.fixtures import load_sources


def _land(spark, root):
    s = load_sources(spark, SF_SMALL)
    s.rewards.write.parquet(f"{root}/rewards")
    s.activity.write.parquet(f"{root}/account_activity")
    s.prices.write.parquet(f"{root}/prices_day")
    s.transactions.write.parquet(f"{root}/transactions")
    s.responses.select("body").write.text(f"{root}/mev_responses")
    return s


def test_cli_run_and_test(spark):
    root = scratch_dir(spark, "cli-src")
    wh = scratch_dir(spark, "cli-wh")
    s = _land(spark, root)
    args = ["run", "--sources", root, "--warehouse", wh, "--start-date", P.start_date, "--as-of",
            "2001-10-01 12:00:00", "--bodies-one-per-line"]
    assert cli.main(args + ["--full-refresh"]) == 0
    # the cli uses the production recipients, so compare the product model only
    got = round_doubles(read_stored(spark, f"{wh}/product_revenue"))
    want = round_doubles(revenue.product_revenue(s.activity, s.prices, s.mapping, P.with_(weth_cutoff=
                                                 "2024-03-11 00:00:00")))
    assert checks.differences(want, got).count() == 0
    assert cli.main(args + ["--optimize", "--test"]) == 0   # incremental run, compacted, checked
    assert checks.differences(want, round_doubles(read_stored(spark, f"{wh}/product_revenue"))).count() == 0
    assert read_stored(spark, f"{wh}/tx_per_block_merge").count() > 0
    assert cli.main(["test", "--warehouse", wh]) == 0


def test_compact_after_merge_leaves_one_file_per_day(spark):
    from tallyspark.plans import blocks
    from tallyspark.sinks import tables
    s = load_sources(spark, SF_SMALL)
    path = scratch_dir(spark, "post-hook")
    blocks.run_tx_per_block(spark, s.transactions.repartition(8), path, "merge", "2001-09-30 00:00:00")
    blocks.run_tx_per_block(spark, s.transactions.repartition(8), path, "merge", "2001-10-01 00:00:00",
                            compact_after=True)
    assert max(tables.file_counts(spark, path).values()) == 1


def test_cli_stream_keeps_product_revenue_current(spark):
    from pyspark.sql import functions as F
    root = scratch_dir(spark, "cli-stream-src")
    wh = scratch_dir(spark, "cli-stream-wh")
    s = load_sources(spark, SF_SMALL)
    s.prices.write.parquet(f"{root}/prices_day")
    s.rewards.write.parquet(f"{root}/rewards")
    s.transactions.write.parquet(f"{root}/transactions")
    s.responses.select("body").write.text(f"{root}/mev_responses")
    act = s.activity.withColumn("block_date", F.to_date("block_time"))
    act.where(F.col("block_date") < F.lit("2024-01-15").cast("date")) \
        .write.partitionBy("block_date").parquet(f"{root}/account_activity")
    assert cli.main(["stream", "--sources", root, "--warehouse", wh, "--model", "product_revenue"]) == 0
    act.where(F.col("block_date") >= F.lit("2024-01-15").cast("date")) \
        .write.mode("append").partitionBy("block_date").parquet(f"{root}/account_activity")
    assert cli.main(["stream", "--sources", root, "--warehouse", wh, "--model", "product_revenue",
                     "--max-files-per-trigger", "5"]) == 0
    got = round_doubles(read_stored(spark, f"{wh}/product_revenue"))
    want = round_doubles(revenue.product_revenue(s.activity, s.prices, s.mapping,
                                                 P.with_(weth_cutoff="2024-03-11 00:00:00")))
    assert checks.differences(want, got).count() == 0


def test_cli_test_blocks_on_duplicate_keys(spark):
    from tallyspark.sinks import tables
    wh = scratch_dir(spark, "cli-dup")
    dup = spark.createDataFrame([("2024-01-01", "swap"), ("2024-01-01", "swap")], "d string, type string") \
        .selectExpr("cast(d as timestamp_ntz) as date", "type", "0.0 as sol_amount", "0.0 as sol_price_usd",
                    "0.0 as sol_amount_usd", "0.0 as usdc_amount", "0.0 as total_usd_amount")
    tables.write_table(dup, f"{wh}/unified_revenue")
    assert cli.main(["test", "--warehouse", wh]) == 1

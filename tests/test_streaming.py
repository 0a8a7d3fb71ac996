"""Landed files in waves, including a late file for an old day."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from tallyspark.functions.numeric import round_doubles
from tallyspark.functions.time import ts_lit
from tallyspark.operators import checks
from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import revenue
from tallyspark.session import scratch_dir
from tallyspark.sinks.tables import read_stored
from tallyspark.sources.fixtures import load_events, read_table, sources_from
from tallyspark.streaming import land_event_files, stream_upsert


def test_stream_waves_with_late_file_equal_full_build(spark):
    root = scratch_dir(spark, "stream")
    ev = load_events(spark, SF_SMALL)
    lineitem = read_table(spark, SF_SMALL, "lineitem")

    def build(events, since):
        s = sources_from(spark, events, lineitem)
        return revenue.product_revenue(s.activity, s.prices, s.mapping, P, since, s.mapping_rows)

    landing, target, ckpt = f"{root}/landing", f"{root}/target", f"{root}/_ckpt"
    late = (F.to_date("ts") == F.lit("2024-01-05").cast("date")) & (F.col("event_type") == "click")
    wave1 = ev.where((F.col("ts") < ts_lit("2024-01-20 00:00:00")) & ~late)
    wave2 = ev.where((F.col("ts") >= ts_lit("2024-01-20 00:00:00")) | late)
    land_event_files(spark, wave1, landing)
    stream_upsert(spark, landing, ev.schema, target, build, revenue.PRODUCT_KEYS, ckpt, max_files_per_trigger=7)
    n1 = read_stored(spark, target).count()
    land_event_files(spark, wave2, landing, mode="append")
    stream_upsert(spark, landing, ev.schema, target, build, revenue.PRODUCT_KEYS, ckpt, max_files_per_trigger=7)
    got = round_doubles(read_stored(spark, target))
    want = round_doubles(build(ev, None))
    assert n1 < got.count()
    assert checks.differences(want, got).count() == 0
    # a restart with nothing new changes nothing
    stream_upsert(spark, landing, ev.schema, target, build, revenue.PRODUCT_KEYS, ckpt)
    assert checks.differences(want, round_doubles(read_stored(spark, target))).count() == 0


def test_continuous_trigger_returns_a_running_query(spark):
    root = scratch_dir(spark, "stream-cont")
    ev = load_events(spark, SF_SMALL)
    lineitem = read_table(spark, SF_SMALL, "lineitem")

    def build(events, since):
        s = sources_from(spark, events, lineitem)
        return revenue.product_revenue(s.activity, s.prices, s.mapping, P, since, s.mapping_rows)

    land_event_files(spark, ev, f"{root}/landing")
    q = stream_upsert(spark, f"{root}/landing", ev.schema, f"{root}/target", build, revenue.PRODUCT_KEYS,
                      f"{root}/_ckpt", available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = round_doubles(read_stored(spark, f"{root}/target"))
    assert checks.differences(round_doubles(build(ev, None)), got).count() == 0

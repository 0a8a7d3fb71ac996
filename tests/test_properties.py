"""Property tests: write strategies against a brute-force model, twin runs at random splits."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paths import SF_SMALL
from tallyspark.functions.numeric import round_doubles
from tallyspark.functions.time import ts_lit
from tallyspark.operators import checks, upsert
from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import pipeline, revenue
from tallyspark.session import scratch_dir
from tallyspark.sources.fixtures import load_events, load_sources, read_table, sources_from

key = st.one_of(st.none(), st.integers(0, 3))
row = st.tuples(key, st.integers(0, 2), st.integers(0, 99))
SCHEMA = "k bigint, d int, v bigint"


def _brute(target, batch, mode, lo):
    """Row-by-row model of the strategies; NULL never equals, pred = d >= lo on the target."""
    def eq(a, b):
        return a[0] is not None and b[0] is not None and a[0] == b[0] and a[1] == b[1]

    def in_scope(t):
        return lo is None or t[1] >= lo

    if mode == "append":
        new = [b for b in batch if not any(eq(b, t) and in_scope(t) for t in target)]
        return sorted(target + new, key=repr)
    kept = [t for t in target if not (in_scope(t) and any(eq(t, b) for b in batch))]
    return sorted(kept + batch, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(row, max_size=6), batch=st.lists(row, max_size=6),
       mode=st.sampled_from(["merge", "append"]), lo=st.one_of(st.none(), st.integers(0, 2)))
def test_strategies_match_brute_force(spark, target, batch, mode, lo):
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA)
    pred = None if lo is None else F.col("d") >= F.lit(lo)
    op = upsert.merge if mode == "merge" else upsert.append_dedup
    got = sorted((tuple(r) for r in op(t, b, ["k", "d"], pred).collect()), key=repr)
    assert got == _brute(list(target), list(batch), mode, lo)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(minutes=st.integers(60 * 24 * 4, 60 * 24 * 28))
def test_twin_run_equals_full_at_random_split(spark, minutes):
    split = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    wh = pipeline.Warehouse(scratch_dir(spark, "prop-twin"))
    ev = load_events(spark, SF_SMALL)
    lineitem = read_table(spark, SF_SMALL, "lineitem")
    pipeline.run_product_revenue(spark, sources_from(spark, ev.where(F.col("ts") < ts_lit(split)), lineitem), wh, P)
    got = pipeline.run_product_revenue(spark, sources_from(spark, ev, lineitem), wh, P)
    s = load_sources(spark, SF_SMALL)
    want = revenue.product_revenue(s.activity, s.prices, s.mapping, P, mapping_rows=s.mapping_rows)
    assert checks.differences(round_doubles(want), round_doubles(got)).count() == 0

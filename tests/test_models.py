"""Hand-made edge frames for the model functions (FIXTURES.md §5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import epochs, revenue
from tallyspark.sources.readers import ACTIVITY_SCHEMA, PRICES_SCHEMA, REWARDS_SCHEMA

D = dt.datetime
MAP_SCHEMA = "address string, fee_type string, fee_source string, token string"


def _mapping(spark):
    return spark.createDataFrame([
        ("a_sol", "swap", "okx", "sol"),
        ("a_usdc", "swap", "unknown", "usdc"),
        ("a_wsol", "swap", "unknown", "wsol"),
        ("a_weth", "swap", "unknown", "weth"),
        ("a_rfq", "instant_unstake", "rfq", "sol"),
    ], MAP_SCHEMA)


def _prices(spark, rows):
    return spark.createDataFrame(rows, PRICES_SCHEMA)


def _activity(spark, rows):
    return spark.createDataFrame(rows, ACTIVITY_SCHEMA)


def test_fee_case_arms_and_sign_rules(spark):
    t = D(2024, 1, 10, 5)
    act = _activity(spark, [
        (t, "a_rfq", True, -49_000_000_000, 0.0),   # rfq outgoing: 49 * 2 / 98 = 1.0
        (t, "a_rfq", True, 5_000_000_000, 0.0),     # rfq incoming: passes as sol, contributes 0
        (t, "a_sol", True, 2_000_000_000, 0.0),     # sol: lamports / 1e9
        (t, "a_sol", True, -2_000_000_000, 0.0),    # sol outgoing: dropped
        (t, "a_usdc", True, 0, 7.5),                # token amount
        (t, "a_usdc", True, 0, -1.0),               # token outgoing: dropped
        (t, "a_usdc", False, 0, 100.0),             # failed tx: dropped
        (t, "a_usdc", None, 0, 100.0),              # NULL success: dropped
        (t, "nobody", True, 0, 100.0),              # unmapped: dropped
    ])
    out = {(r.fee_source, r.token): r.raw_amount
           for r in revenue.fees_raw(act, _mapping(spark), P).collect()}
    assert sorted(out) == [("okx", "sol"), ("rfq", "sol"), ("unknown", "usdc")]
    rfq = revenue.fees_raw(act, _mapping(spark), P).where("fee_source = 'rfq'").collect()
    assert sorted(r.raw_amount for r in rfq) == [0.0, 1.0]
    assert out[("okx", "sol")] == 2.0 and out[("unknown", "usdc")] == 7.5


def test_rfq_only_day_gives_zero_amount_row(spark):
    act = _activity(spark, [(D(2024, 1, 3, 1), "a_rfq", True, 5_000_000_000, 0.0)])
    rows = revenue.product_revenue(act, _prices(spark, []), _mapping(spark), P).collect()
    assert len(rows) == 1 and rows[0].amount == 0.0


def test_weth_cutoff_boundary(spark):
    cut = D(2024, 1, 15)
    act = _activity(spark, [
        (cut, "a_weth", True, 0, 1.0),                                  # at cut-off: dropped
        (cut - dt.timedelta(microseconds=1), "a_weth", True, 0, 2.0),   # just before: kept
    ])
    rows = revenue.fees_raw(act, _mapping(spark), P).collect()
    assert [r.raw_amount for r in rows] == [2.0]


def test_price_join_wsol_uses_sol_and_usdc_is_one_to_one(spark):
    day = D(2024, 1, 2)
    act = _activity(spark, [
        (day + dt.timedelta(hours=1), "a_wsol", True, 0, 2.0),
        (day + dt.timedelta(hours=2), "a_usdc", True, 0, 3.0),
        (day + dt.timedelta(hours=3), "a_sol", True, 1_000_000_000, 0.0),
    ])
    prices = _prices(spark, [
        (day, "SOL", "solana", 100.0), (day, "SOL", "solana", 110.0),   # two listings -> avg 105
        (day, "SOL", "ethereum", 999.0),                                 # other chain: ignored
        (day, "WETH", "solana", 3000.0),
    ])
    out = {r.token: r for r in revenue.product_revenue(act, prices, _mapping(spark), P).collect()}
    assert out["wsol"].usd_price == 105.0 and out["wsol"].usd_amount == 210.0
    assert out["sol"].usd_amount == 105.0
    assert out["usdc"].usd_price is None and out["usdc"].usd_amount == 3.0


def test_missing_price_gives_null_usd(spark):
    act = _activity(spark, [(D(2024, 1, 7, 1), "a_sol", True, 1_000_000_000, 0.0)])
    r = revenue.product_revenue(act, _prices(spark, []), _mapping(spark), P).first()
    assert r.usd_price is None and r.usd_amount is None and r.amount == 1.0


def _rewards(spark, rows):
    return spark.createDataFrame(rows, REWARDS_SCHEMA)


def test_epoch_numbering_full_and_incremental(spark):
    times = [D(2024, 1, 1, h) for h in (1, 2, 5)] + [D(2024, 1, 2, 0)]
    rows = [(t, "Voting", "x", 1) for t in times] + [(times[0], "Voting", "y", 2), (times[1], "Fee", "x", 3)]
    full = epochs.epoch_info(_rewards(spark, rows), P).orderBy("epoch").collect()
    assert [r.epoch for r in full] == [133, 134, 135, 136]          # same time twice -> one epoch
    assert [r.epoch_end_time for r in full] == times
    assert full[-1].date == D(2024, 1, 2)
    # incremental: a late time older than the watermark is never numbered
    late = rows + [(D(2024, 1, 1, 3), "Voting", "x", 1), (D(2024, 1, 3, 0), "Voting", "x", 1)]
    inc = epochs.epoch_info(_rewards(spark, late), P, last_epoch=136, last_time=times[-1]).collect()
    assert [(r.epoch, r.epoch_end_time) for r in inc] == [(137, D(2024, 1, 3, 0))]


def test_epoch_numbering_many_buckets_equals_global_rank(spark):
    base = D(2024, 1, 1)
    times = [base + dt.timedelta(minutes=7 * i) for i in range(500)]
    df = _rewards(spark, [(t, "Voting", "x", 1) for t in reversed(times)])
    got = [r.epoch for r in epochs.epoch_info(df, P).orderBy("epoch_end_time").collect()]
    assert got == list(range(133, 633))


JSON_BODIES = [
    ('[{"epoch": 140, "mev_commission_bps": 800, "mev_rewards": 1000000000}]',),    # numbers
    ('[{"epoch": "141", "mev_commission_bps": "800", "mev_rewards": "2000000000"}]',),  # numeric strings
    ('[{"epoch": 142, "mev_rewards": 3000000000}]',),                            # missing field
    ('[{"epoch": 143, "mev_commission_bps": null, "mev_rewards": 1}]',),          # JSON null
    ('[{"epoch": 144, "mev_commission_bps": {"x": 1}, "mev_rewards": 1}]',),      # nested object
    ("[]",),                                                                       # empty array
]


def test_json_shapes(spark):
    df = spark.createDataFrame(JSON_BODIES, "body string")
    rows = {r.epoch: r for r in revenue.jito_api_rows(df).collect()}
    assert sorted(rows) == [140, 141, 142, 143, 144]
    assert rows[141].mev_commission_bps == 800.0 and rows[141].mev_rewards == 2e9
    assert rows[142].mev_commission_bps is None
    assert rows[143].mev_commission_bps is None
    assert rows[144].mev_commission_bps is None                 # non-scalar -> NULL
    assert rows[140].priority_fee_rewards is None


def test_json_bad_number_raises(spark):
    df = spark.createDataFrame([('[{"epoch": "abc", "mev_commission_bps": 1, "mev_rewards": 1}]',)], "body string")
    with pytest.raises(Exception) as e:
        revenue.jito_api_rows(df).select("epoch").collect()
    assert "CAST" in str(e.value).upper() or "abc" in str(e.value)


def test_jito_sum_joins_epochs(spark):
    df = spark.createDataFrame([JSON_BODIES[0], JSON_BODIES[1], ('[{"epoch": 999, "mev_commission_bps": 800, '
                                                                 '"mev_rewards": 5}]',)], "body string")
    ep = spark.createDataFrame([(140, D(2024, 1, 1, 5), D(2024, 1, 1)), (141, D(2024, 1, 1, 9), D(2024, 1, 1))],
                               "epoch bigint, epoch_end_time timestamp_ntz, date timestamp_ntz")
    r = revenue.staking_jito(df, ep).collect()
    assert len(r) == 1 and abs(r[0].amount_sol - (1e9 + 2e9) * 800 / 10000 / 1e9) < 1e-12


def _unified_rows(spark, rows):
    return spark.createDataFrame(rows, "date timestamp_ntz, type string, sol_amount double, sol_price_usd double, "
                                       "sol_amount_usd double, usdc_amount double, total_usd_amount double")


def test_week_starts_monday_and_quarter_edges(spark):
    rows = [(D(2024, 1, 7), "swap", 1.0, None, 1.0, 0.0, 1.0),    # Sunday -> week of Mon 2024-01-01
            (D(2024, 1, 8), "swap", 2.0, None, 2.0, 0.0, 2.0),    # Monday -> new week
            (D(2024, 3, 31), "swap", 4.0, None, 4.0, 0.0, 4.0),   # Q1
            (D(2024, 4, 1), "swap", 8.0, None, 8.0, 0.0, 8.0)]    # Q2
    un = _unified_rows(spark, rows)
    wk = {r.aggregated_date: r.sol_amount for r in revenue.revenue_by_period(un, "week").collect()}
    assert wk[D(2024, 1, 1)] == 1.0 and wk[D(2024, 1, 8)] == 2.0
    q = {r.aggregated_date: r.sol_amount for r in revenue.revenue_by_period(un, "quarter").collect()}
    assert q == {D(2024, 1, 1): 7.0, D(2024, 4, 1): 8.0}
    cols = revenue.revenue_by_period(un, "month").columns
    assert cols == ["aggregated_date", "sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]


def test_unified_null_handling(spark):
    schema = "date timestamp_ntz, fee_type string, fee_source string, token string, usd_price double, " \
             "amount double, usd_amount double"
    d = D(2024, 1, 7)
    prod = spark.createDataFrame([
        (d, "swap", "okx", "sol", None, 1.0, None),          # sol without price
        (d, "swap", "unknown", "usdc", None, 5.0, 5.0),
        (d, "swap", "unknown", "weth", 3000.0, 0.01, 30.0),  # weth: only in total
        (d, "bridge", "unknown", "sol", None, 2.0, None),    # group with only NULL sol usd
    ], schema)
    staking = spark.createDataFrame([], schema)
    out = {r.type: r for r in revenue.unified_revenue(prod, staking).collect()}
    assert out["swap"].sol_amount_usd == 0.0          # mixed group: 0-padded
    assert out["swap"].usdc_amount == 5.0 and out["swap"].total_usd_amount == 35.0
    assert out["swap"].sol_amount == 1.0
    assert out["bridge"].sol_amount_usd is None        # only NULLs -> NULL
    assert out["bridge"].total_usd_amount is None


def test_staking_native_filters(spark):
    t = D(2024, 1, 5, 3)
    rows = [(t, "Fee", "id_key", 1_000_000_000), (t, "Rent", "vote_key", 2_000_000_000),
            (t, "Staking", "id_key", 4_000_000_000), (t, "Voting", "other", 8_000_000_000),
            (D(2023, 5, 31), "Fee", "id_key", 16_000_000_000)]          # before start date
    r = revenue.staking_native(_rewards(spark, rows), P).collect()
    assert [(x.date, x.amount_sol) for x in r] == [(D(2024, 1, 5), 3.0)]


def test_unused_priority_fields_are_never_parsed(spark):
    """A bad value in a field the model does not sum must not fail the model."""
    df = spark.createDataFrame([('[{"epoch": 140, "mev_commission_bps": 800, "mev_rewards": 1000000000, '
                                 '"priority_fee_rewards": "not-a-number"}]',)], "body string")
    ep = spark.createDataFrame([(140, D(2024, 1, 1, 5), D(2024, 1, 1))],
                               "epoch bigint, epoch_end_time timestamp_ntz, date timestamp_ntz")
    assert revenue.staking_jito(df, ep).count() == 1
    with pytest.raises(Exception):
        revenue.jito_api_rows(df).collect()          # asking for the field does parse it


def test_per_source_cutoff(spark):
    schema = "date timestamp_ntz, amount_sol double"
    native = spark.createDataFrame([(D(2024, 1, d), 1.0) for d in range(1, 11)], schema)
    jito = spark.createDataFrame([(D(2024, 1, d), 2.0) for d in range(1, 6)], schema)
    prices = spark.createDataFrame([], PRICES_SCHEMA)
    shared = revenue.staking_revenue(native, jito, prices, since=D(2024, 1, 7))
    assert shared.where("fee_source = 'jito'").count() == 0            # lagging branch skipped
    own = revenue.staking_revenue(native, jito, prices, since=D(2024, 1, 7), since_jito=D(2024, 1, 2))
    assert own.where("fee_source = 'jito'").count() == 4
    assert own.where("fee_source = 'native'").count() == 4


def test_models_as_sql_views(spark):
    from paths import SF_SMALL
    from tallyspark.plans.views import register_views
    from tallyspark.sources.fixtures import load_sources
    s = load_sources(spark, SF_SMALL)
    names = register_views(spark, s, P.with_(as_of="2001-10-01 12:00:00"), prefix="v_")
    assert "v_unified_revenue" in names and "v_weekly_unified_revenue" in names
    n = spark.sql("SELECT count(*) AS n FROM v_product_revenue").first().n
    assert n == revenue.product_revenue(s.activity, s.prices, s.mapping, P).count()
    r = spark.sql("""SELECT u.type, sum(u.total_usd_amount) AS t FROM v_unified_revenue u
                     JOIN v_daily_unified_revenue d ON d.aggregated_date = u.date GROUP BY u.type""").collect()
    assert len(r) > 0
    assert spark.sql("SELECT count(*) AS n FROM v_tx_per_block").first().n == 67

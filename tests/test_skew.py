"""Hot keys: one address/day or one block time holding a third of all rows."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import epochs, revenue
from tallyspark.sources.mapping import MAPPING_ROWS, mapping_df
from tallyspark.sources.readers import ACTIVITY_SCHEMA, PRICES_SCHEMA, REWARDS_SCHEMA


def _activity_rows(n):
    base = dt.datetime(2024, 1, 1)
    hot = MAPPING_ROWS[3][0]                       # a 'sol' address
    rows = []
    for i in range(n):
        if i % 3 == 0:                             # a third of all rows: one address, one day
            rows.append((base + dt.timedelta(seconds=i), hot, True, 1_000_000 * (i % 7 + 1), 0.0))
        else:
            addr = MAPPING_ROWS[i % len(MAPPING_ROWS)][0]
            rows.append((base + dt.timedelta(hours=i % 240), addr, i % 11 != 0, 1_000 * (i % 13) - 4_000,
                         float(i % 5) - 1.0))
    return rows


def _brute_force(rows):
    m = pd.DataFrame(MAPPING_ROWS, columns=["address", "fee_type", "fee_source", "token"])
    a = pd.DataFrame(rows, columns=["block_time", "address", "tx_success", "balance_change", "token_balance_change"])
    j = a[a.tx_success].merge(m, on="address")
    j = j[~((j.token == "weth") & (j.block_time >= pd.Timestamp(P.weth_cutoff)))]
    rfq = (j.fee_type == "instant_unstake") & (j.fee_source == "rfq")
    keep = ((j.token != "sol") & (j.token_balance_change > 0)) | ((j.token == "sol") & (j.balance_change > 0)) \
        | (rfq & (j.balance_change < 0))
    j = j[keep].copy()
    rfq = (j.fee_type == "instant_unstake") & (j.fee_source == "rfq")
    j["raw"] = j.token_balance_change
    j.loc[j.token == "sol", "raw"] = j.balance_change / 1e9
    j.loc[rfq, "raw"] = 0.0
    neg = rfq & (j.balance_change < 0)
    j.loc[neg, "raw"] = j.balance_change.abs() / 1e9 * 2.0 / 98.0
    j["date"] = j.block_time.dt.floor("D")
    g = j.groupby(["date", "fee_type", "fee_source", "token"], as_index=False).raw.sum()
    return {(r.date.to_pydatetime(), r.fee_type, r.fee_source, r.token): round(r.raw, 9) for r in g.itertuples()}


def test_hot_address_day_matches_brute_force(spark):
    rows = _activity_rows(3000)
    act = spark.createDataFrame(rows, ACTIVITY_SCHEMA)
    mapping = mapping_df(spark).drop("idx")
    got = revenue.product_revenue(act, spark.createDataFrame([], PRICES_SCHEMA), mapping, P,
                                  mapping_rows=len(MAPPING_ROWS))
    have = {(r.date, r.fee_type, r.fee_source, r.token): round(r.amount, 9) for r in got.collect()}
    assert have == _brute_force(rows)


def test_hot_block_time_numbering(spark):
    base = dt.datetime(2024, 1, 1)
    hot = base + dt.timedelta(hours=5)
    rows = [(hot, "Voting", f"v{i}", 1) for i in range(1000)]                 # one time, a third of rows
    rows += [(base + dt.timedelta(minutes=i), "Voting", "x", 1) for i in range(2000)]
    ep = epochs.epoch_info(spark.createDataFrame(rows, REWARDS_SCHEMA).repartition(8), P)
    times = sorted({r[0] for r in rows})
    got = ep.orderBy("epoch").select("epoch", "epoch_end_time").collect()
    assert [r.epoch for r in got] == list(range(133, 133 + len(times)))
    assert [r.epoch_end_time for r in got] == times

"""DuckDB SQL that computes each registered query from the same parquet tables.

The driver registers ``events``, ``lineitem``, ``orders``, ``customer`` … as
views. The adapters and models are written once as CTEs and every query
selects from them; doubles are rounded half-up at 4 decimals through
``decimal(28,8)``, as the Spark side does, so summation order cannot change
the compared values.
"""

from __future__ import annotations

from tallyspark.catalog import (AS_OF, EPOCH_SPLIT, JOIN_SINCE, LATE_DAY, LOOKBACK_FROM, NARROW_PRED,
                                RUN1_AS_OF, RUN2_AS_OF, SPLIT)
from tallyspark.functions.keys import NULL_PLACEHOLDER, SEPARATOR
from tallyspark.params import TEST_PARAMS as P
from tallyspark.sources.fixtures import BODY_SPAN, MAPPING_SLOTS
from tallyspark.sources.mapping import MAPPING_ROWS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ts(s: str) -> str:
    return f"TIMESTAMP {_q(s)}"


_MAPPING_VALUES = ",\n        ".join(
    f"({i}, {_q(a)}, {_q(t)}, {_q(src)}, {_q(tok)})" for i, (a, t, src, tok) in enumerate(MAPPING_ROWS))
_RECIPIENTS = ", ".join(_q(r) for r in P.recipients)
START = _ts(P.start_date)
WETH = _ts(P.weth_cutoff)

CTES = f"""
mapping(idx, address, fee_type, fee_source, token) AS (VALUES
        {_MAPPING_VALUES}),
ev AS (
    SELECT event_id, ts, user_id, event_type, value, props,
           CAST(round(value * 100) AS BIGINT) AS cents
    FROM events),
account_activity AS (
    SELECT e.ts AS block_time, coalesce(m.address, 'unmapped') AS address,
           e.event_type <> 'error' AS tx_success,
           (e.cents - 3000) * 1000000 AS balance_change,
           CAST(e.cents - 3000 AS DOUBLE) / 100 AS token_balance_change
    FROM ev e LEFT JOIN mapping m ON m.idx = e.user_id % {MAPPING_SLOTS}),
raw_activity AS (
    SELECT e.ts AS block_time, m.address, e.event_type, e.value
    FROM events e LEFT JOIN mapping m ON m.idx = e.user_id % {MAPPING_SLOTS}),
prices_day AS (
    SELECT date_trunc('day', ts) AS "timestamp",
           CASE WHEN user_id % 3 = 0 THEN 'SOL' WHEN user_id % 3 = 1 THEN 'WETH' ELSE 'BONK' END AS symbol,
           CASE WHEN event_id % 10 < 9 THEN 'solana' ELSE 'ethereum' END AS blockchain,
           CASE WHEN extract(day FROM ts) % 7 <> 0 THEN value END AS price
    FROM events),
rewards AS (
    SELECT date_trunc('hour', ts) AS block_time,
           CASE event_type WHEN 'view' THEN 'Voting' WHEN 'click' THEN 'Fee' WHEN 'signup' THEN 'Rent'
                ELSE 'Staking' END AS reward_type,
           CASE WHEN user_id % 4 = 0 THEN 'id_key' WHEN user_id % 4 = 1 THEN 'vote_key' ELSE 'other' END
               AS recipient,
           cents * 10000000 AS lamports
    FROM ev),
mev_api AS (
    SELECT 132 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS epoch,
           CAST(800 AS DOUBLE) AS mev_commission_bps,
           CAST(cents * 1000000 AS DOUBLE) AS mev_rewards,
           CAST(NULL AS DOUBLE) AS priority_fee_commission_bps,
           CAST(NULL AS DOUBLE) AS priority_fee_rewards
    FROM ev WHERE event_type = 'purchase'),
transactions AS (
    SELECT CAST(l_linenumber AS BIGINT) AS block_number, CAST(l_shipdate AS DATE) AS block_date
    FROM lineitem),
chain_quotes AS (
    SELECT "timestamp" AS day, symbol, avg(price) AS quote FROM prices_day WHERE blockchain = 'solana' GROUP BY ALL),
product_prices AS (
    SELECT day AS date, lower(symbol) AS token, quote AS price FROM chain_quotes
    WHERE list_contains(['SOL', 'WETH'], symbol) AND day >= {START}),
sol_prices AS (SELECT day AS date, quote AS price FROM chain_quotes WHERE symbol = 'SOL'),
-- a token's price key: wrapped SOL is worth SOL
token_quotes AS (
    FROM product_prices SELECT date, token, price
    UNION ALL
    FROM product_prices SELECT date, 'wsol', price WHERE token = 'sol'),
mapped AS (
    SELECT date_trunc('day', block_time) AS date, fee_type, fee_source, token, balance_change AS lamports,
           token_balance_change AS units, concat(fee_type, '/', fee_source) = 'instant_unstake/rfq' AS rfq
    FROM account_activity JOIN mapping USING (address)
    WHERE tx_success AND block_time >= {START} AND (token <> 'weth' OR block_time < {WETH})),
-- every fee rule as a contribution of its own
fees_raw AS (
    -- an outgoing unstake transfer is 98 % of the whole; the fee is the rest
    SELECT date, fee_type, fee_source, token, -lamports / 1e9 * 2.0 / 98.0 AS raw_amount
    FROM mapped WHERE rfq AND lamports < 0
    UNION ALL
    -- what comes in on that route is no fee
    SELECT date, fee_type, fee_source, token, 0.0
    FROM mapped WHERE rfq AND (lamports < 0) IS NOT TRUE AND if(token = 'sol', lamports > 0, units > 0)
    UNION ALL
    SELECT date, fee_type, fee_source, token, lamports / 1e9
    FROM mapped WHERE NOT rfq AND token = 'sol' AND lamports > 0
    UNION ALL
    SELECT date, fee_type, fee_source, token, units
    FROM mapped WHERE NOT rfq AND token <> 'sol' AND units > 0),
fee_totals AS (
    SELECT date, fee_type, fee_source, token, sum(raw_amount) AS amount FROM fees_raw GROUP BY ALL),
product_revenue AS (
    SELECT date, fee_type, fee_source, token, price AS usd_price, amount,
           amount * if(token = 'usdc', 1.0, price) AS usd_amount
    FROM fee_totals LEFT JOIN token_quotes USING (date, token)),
voting_times AS (SELECT DISTINCT block_time FROM rewards WHERE reward_type = 'Voting'),
-- an epoch's number is the offset and the votes up to its end
epoch_info AS (
    SELECT DISTINCT {P.epoch_offset} + dense_rank() OVER (ORDER BY block_time) AS epoch,
           block_time AS epoch_end_time, date_trunc('day', block_time) AS date
    FROM rewards WHERE reward_type = 'Voting'),
staking_native AS (
    SELECT date_trunc('day', block_time) AS date, sum(lamports) / 1e9 AS amount_sol
    FROM rewards SEMI JOIN (VALUES ('Fee'), ('Rent'), ('Voting')) kept(reward_type) USING (reward_type)
    WHERE list_contains([{_RECIPIENTS}], recipient) AND block_time >= {START}
    GROUP BY ALL),
epoch_commission AS (
    SELECT epoch, sum(mev_rewards * mev_commission_bps / 10000) AS lamports FROM mev_api GROUP BY ALL),
staking_jito AS (
    SELECT date, sum(lamports) / 1e9 AS amount_sol FROM epoch_commission JOIN epoch_info USING (epoch) GROUP BY ALL),
staking_raw AS (
    FROM staking_native SELECT date, 'native' AS fee_source, amount_sol
    UNION ALL
    FROM staking_jito SELECT date, 'jito', amount_sol),
staking_revenue AS (
    SELECT date, 'staking' AS fee_type, fee_source, 'sol' AS token, price AS usd_price, amount_sol AS amount,
           price * amount_sol AS usd_amount
    FROM staking_raw LEFT JOIN sol_prices USING (date)),
revenue_union AS (
    SELECT * EXCLUDE (fee_source) FROM product_revenue
    UNION ALL BY NAME
    SELECT * EXCLUDE (fee_source) FROM staking_revenue),
-- one slice for each coin of a day and type, then one column for each coin
coin_slices AS (
    SELECT date, fee_type AS type, CASE token WHEN 'wsol' THEN 'sol' ELSE token END AS coin, sum(amount) AS amount,
           sum(usd_amount) AS usd, max(usd_price) AS quote
    FROM revenue_union GROUP BY ALL),
unified_revenue AS (
    SELECT date, type, sum(if(coin = 'sol', amount, 0)) AS sol_amount,
           max(quote) FILTER (coin = 'sol') AS sol_price_usd, sum(if(coin = 'sol', usd, 0)) AS sol_amount_usd,
           sum(if(coin = 'usdc', amount, 0)) AS usdc_amount, sum(usd) AS total_usd_amount
    FROM coin_slices GROUP BY ALL),
tx_counts AS (
    SELECT block_number, block_date, count(*) AS total_tx_per_block FROM transactions GROUP BY 1, 2),
tgt AS (
    SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n_events, sum(value) AS value_sum
    FROM events WHERE ts < {_ts(SPLIT)} GROUP BY 1, 2),
bat AS (
    SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n_events, sum(value) AS value_sum
    FROM events WHERE ts >= {_ts(LOOKBACK_FROM)} GROUP BY 1, 2),
tmpl_r1 AS (
    SELECT block_number, block_date, count(*) AS total_tx_per_block FROM transactions
    WHERE block_date <= {_ts(RUN1_AS_OF)} AND block_date >= {_ts(RUN1_AS_OF)} - INTERVAL 7 DAY
    GROUP BY 1, 2),
tmpl_r2 AS (
    SELECT block_number, block_date, count(*) AS total_tx_per_block FROM transactions
    WHERE block_date >= {_ts(RUN2_AS_OF)} - INTERVAL 1 DAY
    GROUP BY 1, 2),
tmpl_merged AS (
    SELECT * FROM tmpl_r1 t
    WHERE NOT (t.block_date >= {_ts(RUN2_AS_OF)} - INTERVAL 1 DAY
               AND EXISTS (SELECT 1 FROM tmpl_r2 b
                           WHERE b.block_number = t.block_number AND b.block_date = t.block_date))
    UNION ALL SELECT * FROM tmpl_r2),
tmpl_appended AS (
    SELECT * FROM tmpl_r1
    UNION ALL
    SELECT * FROM tmpl_r2 b
    WHERE NOT EXISTS (SELECT 1 FROM tmpl_r1 t
                      WHERE t.block_date >= {_ts(RUN2_AS_OF)} - INTERVAL 1 DAY
                        AND t.block_number = b.block_number AND t.block_date = b.block_date)),
event_users AS (
    SELECT user_id, min(event_type) AS first_type, max(event_type) AS last_type FROM events GROUP BY ALL),
customer_users AS (
    SELECT c_custkey, c_name, c_mktsegment, first_type, last_type
    FROM customer LEFT JOIN event_users ON user_id = c_custkey)
"""


def _rollup(period: str, src: str = "unified_revenue") -> str:
    """Periods as half-open intervals of a calendar that the days fall into."""
    return f"""WITH days AS (SELECT min(date_trunc('{period}', date)) AS a, max(date) AS b FROM {src}),
calendar AS (SELECT unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 1 {period})) AS aggregated_date FROM days)
SELECT aggregated_date, sum(sol_amount) AS sol_amount, sum(sol_amount_usd) AS sol_usd_amount,
       sum(usdc_amount) AS usdc_amount, sum(total_usd_amount) AS total_usd_amount
FROM calendar JOIN {src} ON date >= aggregated_date AND date < aggregated_date + INTERVAL 1 {period}
GROUP BY ALL"""


def _lineitem_period(period: str) -> str:
    return f"""SELECT date_trunc('{period}', l_shipdate) AS period_start,
       sum(l_quantity) AS quantity, sum(l_extendedprice * (1 - l_discount)) AS revenue
FROM lineitem GROUP BY 1"""


def _epochs_late() -> str:
    late = f"date_trunc('day', block_time) <> {_ts(LATE_DAY + ' 00:00:00')}"
    return f"""WITH v1 AS (
    SELECT block_time FROM voting_times WHERE block_time < {_ts(EPOCH_SPLIT)}{' AND ' + late if late else ''}),
e1 AS (
    SELECT CAST({P.epoch_offset} + row_number() OVER (ORDER BY block_time) AS BIGINT) AS epoch,
           block_time AS epoch_end_time, date_trunc('day', block_time) AS date FROM v1),
v2 AS (SELECT block_time FROM voting_times WHERE block_time > (SELECT max(epoch_end_time) FROM e1)),
e2 AS (
    SELECT CAST((SELECT max(epoch) FROM e1) + row_number() OVER (ORDER BY block_time) AS BIGINT) AS epoch,
           block_time AS epoch_end_time, date_trunc('day', block_time) AS date FROM v2)
SELECT * FROM e1 UNION ALL SELECT * FROM e2"""


RAW: dict[str, tuple[str, list[str]]] = {
    # id: (select over the CTEs, double columns to round)
    "S1": ("SELECT block_time, reward_type, recipient, lamports FROM rewards", []),
    "S2": (f"SELECT * FROM account_activity WHERE block_time >= {START} AND tx_success",
           ["token_balance_change"]),
    "S3": ("SELECT block_number, block_date FROM transactions", []),
    "S4": ('SELECT "timestamp", symbol, blockchain, price FROM prices_day', ["price"]),
    "S5": ("""SELECT m.address, m.fee_type, m.fee_source, m.token, CAST(coalesce(n.n_rows, 0) AS BIGINT) AS n_rows
FROM mapping m LEFT JOIN (SELECT address, count(*) AS n_rows FROM account_activity GROUP BY address) n
ON m.address = n.address""", []),
    "S6": ("SELECT epoch, mev_commission_bps, mev_rewards, priority_fee_commission_bps, priority_fee_rewards "
           "FROM mev_api", ["mev_commission_bps", "mev_rewards", "priority_fee_commission_bps",
                            "priority_fee_rewards"]),
    "S7": (f"SELECT max(date) AS max_date, max(date) - INTERVAL {P.lookback_days} DAY AS cutoff "
           "FROM product_revenue", []),
    "S8": ("SELECT epoch, date FROM epoch_info", []),
    "K1": ("SELECT * FROM tx_counts", []),
    "K2": (f"""SELECT block_number, block_date, count(*) AS total_tx_per_block FROM transactions
WHERE block_date >= {_ts(AS_OF)} - INTERVAL 1 DAY GROUP BY 1, 2""", []),
    "K3": ("""SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n_events, sum(value) AS value_sum
FROM events GROUP BY 1, 2""", ["value_sum"]),
    "K3_null": ("""SELECT date_trunc('day', ts) AS day, event_type, nullif(event_type, 'view') AS kind, user_id % 50 AS slot,
       max(event_id) AS last_event FROM events GROUP BY ALL""", []),
    "K3_carry": (f"""SELECT day, event_type, n_events, value_sum,
       if(NOT EXISTS (SELECT 1 FROM bat b WHERE b.day = a.day AND b.event_type = a.event_type), 'first run', NULL) AS note
FROM (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n_events, sum(value) AS value_sum
      FROM events GROUP BY ALL) a""", ["value_sum"]),
    "K4_dup": ("""SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM bat WHERE bat.day = tgt.day AND bat.event_type = tgt.event_type)
UNION ALL FROM bat UNION ALL FROM bat""", ["value_sum"]),
    "K3_month": ("""SELECT *, CAST(date_trunc('month', block_date) AS DATE) AS block_month FROM tmpl_merged""", []),
    "K5_month": ("""SELECT *, CAST(date_trunc('month', block_date) AS DATE) AS block_month FROM tmpl_appended""", []),
    "K5": ("""SELECT * FROM tgt UNION ALL
SELECT * FROM bat b WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.day = b.day AND t.event_type = b.event_type)""",
           ["value_sum"]),
    "K6": (f"""SELECT * FROM tgt t
WHERE NOT (t.day >= {_ts(NARROW_PRED)}
           AND EXISTS (SELECT 1 FROM bat b WHERE b.day = t.day AND b.event_type = t.event_type))
UNION ALL SELECT * FROM bat""", ["value_sum"]),
    "K7": ("SELECT *, CAST(date_trunc('month', block_date) AS DATE) AS block_month FROM tx_counts", []),
    "P1": ('SELECT "timestamp" AS date, lower(symbol) AS token, price FROM prices_day', ["price"]),
    "P2": ("SELECT date, 'staking' AS fee_type, 'native' AS fee_source, 'sol' AS token, amount_sol "
           "FROM staking_native", ["amount_sol"]),
    "P3": ("SELECT date, fee_type, fee_source, token, raw_amount FROM fees_raw", ["raw_amount"]),
    "P4": ("SELECT date, fee_type, fee_source, token, usd_amount FROM product_revenue", ["usd_amount"]),
    "P5": (f"SELECT * FROM rewards WHERE recipient IN ({_RECIPIENTS}) "
           "AND reward_type IN ('Fee', 'Rent', 'Voting')", []),
    "P6": (f"SELECT * FROM account_activity WHERE block_time >= {START}", ["token_balance_change"]),
    "P7": (f"""SELECT a.block_time, a.address, m.token, a.balance_change
FROM account_activity a JOIN mapping m ON a.address = m.address
WHERE a.block_time >= {START} AND a.tx_success AND NOT (m.token = 'weth' AND a.block_time >= {WETH})""", []),
    "P8": (f"""SELECT a.block_time, a.address, m.fee_type, m.fee_source, m.token, a.balance_change,
       a.token_balance_change
FROM account_activity a JOIN mapping m ON a.address = m.address
WHERE a.block_time >= {START} AND a.tx_success
  AND ((m.token != 'sol' AND a.token_balance_change > 0)
       OR (m.token = 'sol' AND a.balance_change > 0)
       OR (m.fee_type = 'instant_unstake' AND m.fee_source = 'rfq' AND a.balance_change < 0))""",
           ["token_balance_change"]),
    "P9": ("SELECT * FROM account_activity WHERE tx_success", ["token_balance_change"]),
    "P10": (f"SELECT block_number, block_date FROM transactions WHERE block_date >= {_ts(AS_OF)} - INTERVAL 1 DAY",
            []),
    "P11": ("SELECT * FROM raw_activity WHERE address IS NOT NULL", ["value"]),
    "P12": (f"SELECT * FROM prices_day WHERE blockchain = 'solana' AND \"timestamp\" >= {START}", ["price"]),
    "J1": (f"""SELECT a.block_time, a.address, m.fee_type, m.fee_source, m.token, a.balance_change,
       a.token_balance_change
FROM account_activity a JOIN mapping m ON a.address = m.address
WHERE a.block_time >= {START} AND a.tx_success""", ["token_balance_change"]),
    "J2": ("""SELECT f.date, f.fee_type, f.fee_source, f.token, f.raw_amount, p.price AS usd_price
FROM fees_raw f LEFT JOIN token_quotes p USING (date, token)""",
           ["raw_amount", "usd_price"]),
    "J3": ("SELECT n.date, n.amount_sol, p.price FROM staking_native n LEFT JOIN sol_prices p ON p.date = n.date",
           ["amount_sol", "price"]),
    "J4": ("""SELECT api.epoch, ei.date, api.mev_rewards, api.mev_commission_bps
FROM mev_api api JOIN epoch_info ei ON ei.epoch = api.epoch""", ["mev_rewards", "mev_commission_bps"]),
    "J5": (f"""SELECT * FROM bat b WHERE NOT EXISTS (
    SELECT 1 FROM tgt t WHERE t.day >= {_ts(LOOKBACK_FROM)} AND t.day = b.day AND t.event_type = b.event_type)""",
           ["value_sum"]),
    "J6": (f"""SELECT * FROM product_revenue
WHERE date >= (SELECT max(date) - INTERVAL {P.lookback_days} DAY FROM product_revenue)""",
           ["usd_price", "amount", "usd_amount"]),
    "J7": ("SELECT * FROM customer_users", []),
    "J8": (f"""SELECT date_trunc('month', l.l_shipdate) AS ship_month, count(*) AS n_lines,
       sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_orderdate >= {_ts(JOIN_SINCE)}
WHERE l.l_shipdate >= {_ts(JOIN_SINCE)}
GROUP BY 1""", ["revenue"]),
    "J9": (f"""WITH nt AS (
    SELECT date_trunc('day', block_time) AS day, address, count(*) AS n_rows
    FROM raw_activity WHERE block_time < {_ts(SPLIT)} GROUP BY 1, 2),
nb AS (
    SELECT date_trunc('day', block_time) AS day, address, count(*) AS n_rows
    FROM raw_activity WHERE block_time >= {_ts(LOOKBACK_FROM)} GROUP BY 1, 2)
SELECT * FROM nt t WHERE NOT EXISTS (SELECT 1 FROM nb b WHERE b.day = t.day AND b.address = t.address)
UNION ALL SELECT * FROM nb""", []),
    "A1": ("SELECT date, token, price FROM product_prices", ["price"]),
    "A2": ("SELECT date, fee_type, fee_source, token, usd_price, amount FROM product_revenue",
           ["usd_price", "amount"]),
    "A3": ("""SELECT date_trunc('day', block_time) AS date, CAST(sum(lamports) AS DOUBLE) / power(10, 9) AS amount_sol
FROM rewards WHERE reward_type IN ('Fee', 'Rent', 'Voting') GROUP BY 1""", ["amount_sol"]),
    "A4": ("SELECT date, amount_sol FROM staking_jito", ["amount_sol"]),
    "A5": ("SELECT date, type, sol_amount, usdc_amount FROM unified_revenue", ["sol_amount", "usdc_amount"]),
    "A6": ("SELECT date, type, sol_price_usd FROM unified_revenue", ["sol_price_usd"]),
    "A7": ("SELECT date, type, total_usd_amount FROM unified_revenue", ["total_usd_amount"]),
    "A8": ("SELECT block_time FROM voting_times", []),
    "A9": ("SELECT * FROM tx_counts", []),
    "A10_week": (_lineitem_period("week"), ["quantity", "revenue"]),
    "A10_month": (_lineitem_period("month"), ["quantity", "revenue"]),
    "A10_quarter": (_lineitem_period("quarter"), ["quantity", "revenue"]),
    "A11": ("""SELECT max(epoch) AS max_epoch, max(epoch_end_time) AS max_epoch_end_time, max(date) AS max_date,
       coalesce(max(epoch), 0) AS last_epoch FROM epoch_info""", []),
    "W1": ("SELECT * FROM epoch_info", []),
    "O2": (f"""SELECT * FROM ({_rollup('day')}) d
ORDER BY total_usd_amount DESC NULLS LAST, aggregated_date LIMIT 10""",
           ["sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]),
    "U1": ("SELECT * FROM revenue_union", ["usd_price", "amount", "usd_amount"]),
    "U2": ("SELECT * FROM staking_raw", ["amount_sol"]),
    "F1": ("SELECT event_id, date_trunc('day', ts) AS day FROM events", []),
    "F2": ("""SELECT l_orderkey, l_linenumber, date_trunc('week', l_shipdate) AS week,
       date_trunc('month', l_shipdate) AS month, date_trunc('quarter', l_shipdate) AS quarter FROM lineitem""", []),
    "F3": (f"SELECT event_id, ts - INTERVAL {P.lookback_days} DAY AS ts_minus FROM events", []),
    "F4": ("""SELECT block_number, current_date AS block_date, count(*) AS total_tx_per_block FROM transactions
WHERE block_number % 4 = 0 GROUP BY ALL""", []),
    "F5": (f"""SELECT event_id, ts >= {WETH} AS after_cutoff, ts - INTERVAL 1 DAY AS day_before,
       CAST(ts AS DATE) >= DATE '2024-01-15' AS after_date FROM events""", []),
    "F6": ('SELECT "timestamp", lower(symbol) AS token, price FROM prices_day', ["price"]),
    "F7": ("SELECT block_time, address, abs(balance_change) / power(10, 9) AS abs_tokens FROM account_activity",
           ["abs_tokens"]),
    "F8": (f"""SELECT user_id, CAST(floor(event_id / {BODY_SPAN}) AS BIGINT) AS span, CAST(count(*) AS INTEGER) AS n_elements
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""", []),
    "F9": ("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS nested FROM events",
           []),
    "F10": ("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value FROM events""", ["value"]),
    "F11": ("SELECT user_id, count(*) AS n_elements FROM events WHERE event_type = 'purchase' GROUP BY 1", []),
    "F12": ("SELECT coalesce(address, 'unmapped') AS address, count(*) AS n_rows FROM raw_activity GROUP BY 1", []),
    "F13": (f"""SELECT l_orderkey, l_linenumber,
       md5(concat_ws({_q(SEPARATOR)}, coalesce(CAST(l_orderkey AS VARCHAR), {_q(NULL_PLACEHOLDER)}),
                     coalesce(CAST(l_linenumber AS VARCHAR), {_q(NULL_PLACEHOLDER)}))) AS sk
FROM lineitem""", []),
    "T3": (_epochs_late(), []),
    "T5": ("SELECT * FROM tmpl_merged", []),
    "Q1": ("""SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""", []),
    "Q2": ("SELECT c_custkey, c_name FROM customer_users WHERE last_type IS NULL", []),
    "Q3": ("""SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY 1 HAVING count(*) > 1""", []),
    "Q4": ("""SELECT event_type, count(*) AS n_records FROM events
WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup') GROUP BY 1""", []),
    "Q5": ("""SELECT c_custkey, c_name FROM customer
WHERE c_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM event_users WHERE user_id = c_custkey)""", []),
    "Q6": ("""SELECT *, failing_rows = 0 AS passed FROM (
    SELECT 'unique_combination_date_type' AS check_name, 'unified_revenue' AS table_name,
           (SELECT count(*) FROM (SELECT date, type FROM unified_revenue GROUP BY 1, 2 HAVING count(*) > 1))
               AS failing_rows
    UNION ALL
    SELECT 'not_null_date', 'unified_revenue', (SELECT count(*) FROM unified_revenue WHERE date IS NULL)
    UNION ALL
    SELECT 'not_null_type', 'unified_revenue', (SELECT count(*) FROM unified_revenue WHERE type IS NULL)
    UNION ALL
    SELECT 'unique_combination_orderkey_linenumber', 'lineitem',
           (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
    UNION ALL
    SELECT 'relationships_custkey', 'customer',
           (SELECT count(*) FROM customer WHERE c_custkey IS NOT NULL
               AND NOT EXISTS (SELECT 1 FROM event_users WHERE user_id = c_custkey))
) s""", []),
    "Q7": ("""SELECT 'product_revenue' AS model, (SELECT count(*) FROM product_revenue) AS full_rows,
       (SELECT count(*) FROM product_revenue) AS incremental_rows, CAST(0 AS BIGINT) AS n_diff""", []),
    "Q6_wide": ("""SELECT *, failing_rows = 0 AS passed FROM (
    SELECT 'unique_combination_orderkey_linenumber' AS check_name, 'lineitem' AS table_name,
           (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS failing_rows
    UNION ALL
    SELECT 'unique_partkey', 'lineitem', (SELECT count(*) FROM (
        SELECT 1 FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey HAVING count(*) > 1))
    UNION ALL
    SELECT 'not_null_shipdate', 'lineitem', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL)
    UNION ALL
    SELECT 'accepted_values_returnflag', 'lineitem',
           (SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
    UNION ALL
    SELECT 'accepted_values_linestatus', 'lineitem',
           (SELECT count(DISTINCT l_linestatus) FROM lineitem WHERE l_linestatus NOT IN ('O', 'F'))
    UNION ALL
    SELECT 'relationships_suppkey', 'lineitem', (SELECT count(*) FROM lineitem WHERE l_suppkey IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_suppkey % 2 = 0))
) s""", []),
    "Q7_multi": ("""WITH one AS (
    SELECT date_trunc('day', ts) AS day, event_type, value FROM events
), two AS (
    SELECT date_trunc('day', ts) AS day, event_type,
           CASE WHEN event_type = 'click' THEN floor(value) ELSE value END AS value
    FROM (SELECT * FROM events WHERE event_id % 97 <> 0 UNION ALL SELECT * FROM events WHERE event_id % 89 = 0)
)
SELECT 'events_by_day' AS model, (SELECT count(*) FROM one) AS full_rows, (SELECT count(*) FROM two) AS incremental_rows,
       (SELECT count(*) FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM two))
     + (SELECT count(*) FROM (SELECT * FROM two EXCEPT ALL SELECT * FROM one)) AS n_diff""", []),
    "M1": ("SELECT * FROM product_revenue", ["usd_price", "amount", "usd_amount"]),
    "M2": ("SELECT * FROM epoch_info", []),
    "M3": ("SELECT * FROM staking_native", ["amount_sol"]),
    "M4": ("SELECT * FROM staking_jito", ["amount_sol"]),
    "M5": ("SELECT * FROM staking_revenue", ["usd_price", "amount", "usd_amount"]),
    "M6": ("SELECT * FROM unified_revenue",
           ["sol_amount", "sol_price_usd", "sol_amount_usd", "usdc_amount", "total_usd_amount"]),
    "M7": (_rollup("day"), ["sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]),
    "M8": (_rollup("week"), ["sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]),
    "M9": (_rollup("month"), ["sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]),
    "M10": (_rollup("quarter"), ["sol_amount", "sol_usd_amount", "usdc_amount", "total_usd_amount"]),
    "M11": ("SELECT * FROM tx_counts_window", []),
    "M15": ("SELECT * FROM tmpl_appended", []),
}

# Queries whose result equals another's by construction (same rows, other operator).
ALIASES = {
    "K4": "K3",     # delete+insert = merge when batch keys are unique
    "K8": "M1",     # full refresh over a stale target = full build
    "K9": "M2",
    "K10": "K7",    # compaction keeps every row
    "A9": "K1",
    "T1": "M1",     # incremental = full inside the lookback
    "T2": "M8",
    "T4": "M2",
    "T6": "M3",
    "T7": "M3",
    "T8": "M1",
    "M12": "M11",
    "M13": "T5",
    "M14": "T5",
    "K2": "M11",
}

_EXTRA_CTES = f""",
tx_counts_window AS (
    SELECT block_number, block_date, count(*) AS total_tx_per_block FROM transactions
    WHERE block_date >= {_ts(AS_OF)} - INTERVAL 1 DAY GROUP BY 1, 2)
"""


def _wrap(select: str, doubles: list[str]) -> str:
    body = f"WITH {CTES.strip()}{_EXTRA_CTES}, _q AS (\n{select}\n)\n"
    if doubles:
        rep = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(28,8)), 4) AS DOUBLE) AS {c}" for c in doubles)
        return body + f"SELECT * REPLACE ({rep}) FROM _q"
    return body + "SELECT * FROM _q"


def _build() -> dict[str, str]:
    out = {k: _wrap(sel, dbl) for k, (sel, dbl) in RAW.items()}
    for k, target in ALIASES.items():
        out[k] = out[target]
    return out


ORACLE_SQL: dict[str, str] = _build()

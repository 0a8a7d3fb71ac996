"""Command line: build or update the model tables, then check them.

    python -m tallyspark.cli run --sources DIR --warehouse DIR [--select M ...] [--full-refresh]
    python -m tallyspark.cli stream --sources DIR --warehouse DIR --model product_revenue [--continuous]
    python -m tallyspark.cli test --warehouse DIR

``run`` executes the models in dependency order (optionally only the named
ones); ``--full-refresh`` rebuilds instead of upserting; ``--test`` checks the
keys right after. ``test`` runs the key checks on every stored model and exits
non-zero when one fails, so a failed check blocks whatever runs next.
"""

from __future__ import annotations

import argparse
import json
import sys

from tallyspark.operators import checks
from tallyspark.params import Params
from tallyspark.plans import blocks, pipeline
from tallyspark.session import get_session
from tallyspark.sinks.tables import read_stored, table_exists
from tallyspark.sources.readers import load_source_tables

ORDER = ["product_revenue", "epoch_info", "staking_native", "staking_revenue", "unified_revenue",
         *pipeline.PERIOD_MODELS.values(), *[f"tx_per_block_{s}" for s in blocks.STRATEGIES if s != "view"]]


def run(spark, sources_dir: str, warehouse: str, p: Params, select: list[str] | None, full_refresh: bool,
        bodies_one_per_line: bool = False, optimize: bool = False):
    src = load_source_tables(spark, sources_dir, bodies_one_per_line)
    wh = pipeline.Warehouse(warehouse)
    chosen = [m for m in ORDER if not select or m in select]
    for m in chosen:
        if m == "product_revenue":
            pipeline.run_product_revenue(spark, src, wh, p, full_refresh)
        elif m == "epoch_info":
            pipeline.run_epoch_info(spark, src, wh, p, full_refresh)
        elif m == "staking_native":
            pipeline.run_staking_native(spark, src, wh, p, full_refresh)
        elif m == "staking_revenue":
            pipeline.run_staking_revenue(spark, src, wh, p, full_refresh)
        elif m == "unified_revenue":
            pipeline.run_unified_revenue(spark, wh, p, full_refresh)
        elif m in pipeline.PERIOD_MODELS.values():
            period = {v: k for k, v in pipeline.PERIOD_MODELS.items()}[m]
            pipeline.run_rollup(spark, wh, p, period, full_refresh)
        else:
            strategy = m.removeprefix("tx_per_block_")
            blocks.run_tx_per_block(spark, src.transactions, wh.path(m), strategy, p.as_of, full_refresh,
                                    compact_after=optimize)
    return chosen


STREAMED = {"product_revenue": ("account_activity", "ACTIVITY_SCHEMA"),
            "staking_native": ("rewards", "REWARDS_SCHEMA")}


def stream(spark, sources_dir: str, warehouse: str, model: str, p: Params, landing: str | None = None,
           once: bool = True, max_files_per_trigger: int | None = None):
    """Keep ``model`` current from fact files landing (``block_date=``-partitioned) under ``landing``
    (default: the model's source folder): each micro-batch recomputes the days it touches and merges."""
    from tallyspark.sources import readers
    from tallyspark.streaming import stream_upsert
    from tallyspark.plans import revenue

    folder, schema_name = STREAMED[model]
    landing = landing or f"{sources_dir.rstrip('/')}/{folder}"
    schema = getattr(readers, schema_name)
    wh = pipeline.Warehouse(warehouse)
    if model == "product_revenue":
        src = load_source_tables(spark, sources_dir)

        def build(facts, since):
            return revenue.product_revenue(facts, src.prices, src.mapping, p, since, src.mapping_rows)
        keys = revenue.PRODUCT_KEYS
    else:
        def build(facts, since):
            return revenue.staking_native(facts, p, since)
        keys = ["date"]
    return stream_upsert(spark, landing, schema, wh.path(model), build, keys,
                         f"{warehouse.rstrip('/')}/_streams/{model}", time_col="block_time",
                         max_files_per_trigger=max_files_per_trigger, available_now=once,
                         partition_col="block_date")


def test(spark, warehouse: str):
    wh = pipeline.Warehouse(warehouse)
    keys = {**pipeline.UNIQUE_KEYS, **{f"tx_per_block_{s}": blocks.BLOCK_KEYS
                                       for s in ("merge", "delete_insert", "append")}}
    # accepted values: what the fee mapping and the staking branch can produce
    from tallyspark.sources.mapping import MAPPING_ROWS
    fee_types = sorted({r[1] for r in MAPPING_ROWS} | {"staking"})
    accepted = {
        "product_revenue": {"token": sorted({r[3] for r in MAPPING_ROWS}),
                            "fee_source": sorted({r[2] for r in MAPPING_ROWS})},
        "staking_revenue": {"fee_source": ["native", "jito"]},
        "unified_revenue": {"type": fee_types},
    }
    suite = []
    for m, k in keys.items():
        if table_exists(spark, wh.path(m)):
            found = {f"unique_combination_{'_'.join(k)}": checks.Unique(tuple(k))}
            found |= {f"not_null_{c}": checks.NotNull(c) for c in k}
            found |= {f"accepted_values_{c}": checks.Accepted(c, tuple(v)) for c, v in accepted.get(m, {}).items()}
            suite.append(checks.TableChecks(m, read_stored(spark, wh.path(m)), found))
    return [r.asDict() for r in checks.check_tables(suite).collect()] if suite else []


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tallyspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--sources", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--select", nargs="*")
    r.add_argument("--full-refresh", action="store_true")
    r.add_argument("--lookback-days", type=int, default=Params.lookback_days)
    r.add_argument("--start-date", default=Params.start_date)
    r.add_argument("--epoch-offset", type=int, default=Params.epoch_offset)
    r.add_argument("--as-of", default=None)
    r.add_argument("--lookback-anchor", choices=["target", "as_of"], default="target")
    r.add_argument("--master", default=None)
    r.add_argument("--bodies-one-per-line", action="store_true")
    r.add_argument("--optimize", action="store_true", help="compact partitioned tables after writing")
    r.add_argument("--test", action="store_true", help="run the key checks afterwards; exit 1 on failure")
    st = sub.add_parser("stream")
    st.add_argument("--sources", required=True)
    st.add_argument("--warehouse", required=True)
    st.add_argument("--model", choices=sorted(STREAMED), required=True)
    st.add_argument("--landing", default=None)
    st.add_argument("--continuous", action="store_true", help="keep running (1-minute trigger)")
    st.add_argument("--max-files-per-trigger", type=int, default=None)
    st.add_argument("--start-date", default=Params.start_date)
    st.add_argument("--master", default=None)
    t = sub.add_parser("test")
    t.add_argument("--warehouse", required=True)
    t.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if a.cmd == "run":
        p = Params(lookback_days=a.lookback_days, start_date=a.start_date, epoch_offset=a.epoch_offset,
                   as_of=a.as_of, lookback_anchor=a.lookback_anchor)
        done = run(spark, a.sources, a.warehouse, p, a.select, a.full_refresh, a.bodies_one_per_line,
                   a.optimize)
        out = {"ran": done}
        if a.test:
            out["checks"] = test(spark, a.warehouse)
        print(json.dumps(out, default=str))
        return 0 if all(x["passed"] for x in out.get("checks", [])) else 1
    if a.cmd == "stream":
        q = stream(spark, a.sources, a.warehouse, a.model, Params(start_date=a.start_date), a.landing,
                   once=not a.continuous, max_files_per_trigger=a.max_files_per_trigger)
        if q is not None:
            q.awaitTermination()
        print(json.dumps({"streamed": a.model}))
        return 0
    results = test(spark, a.warehouse)
    print(json.dumps(results, default=str))
    return 0 if all(x["passed"] for x in results) else 1


if __name__ == "__main__":
    sys.exit(main())

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The clock of a query covers everything it does: loads, replays, writes and the read back. The two states that report
queries read, one over the table and one over written drops, are built first and have times of their own (``state_...``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daymend.operators import checks as dq  # noqa: E402
from daymend.operators.conform import conform_sales  # noqa: E402
from daymend.operators.transform import transform_sales  # noqa: E402
from daymend.operators.write import overwrite_table, replace_days, upsert_by_key  # noqa: E402
from daymend.plans.flow import FACT  # noqa: E402
from daymend.queries import fixtures as fx  # noqa: E402
from daymend.queries.models import sales, stores  # noqa: E402
from daymend.queries.registry import QUERIES  # noqa: E402
from daymend.session import build_session  # noqa: E402

HEADLINE = ["dm_daily_sales", "fact_sale", "surrogate_key_composite", "check_unique", "check_relationships",
            "orphan_sales", "full_refresh_bugged", "backfill_partial", "backfill_full", "range_replace",
            "upsert_by_key", "check_results", "daily_reconciliation", "summary", "landing_union"]
STATES = [fx.mid_bug, fx.mid_bug_drops]


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def figures(spark, sf_dir: str) -> dict[str, float]:
    """Full build, replays of 3 and of all days, check suite fused and one by one, keyed upsert."""
    out = {}
    out["state_25_of_30_mid_bug"] = timed(lambda: fx.mid_bug(spark, sf_dir, "bench"))
    flow = fx.events_flow(spark, sf_dir, "bench", gate=True)
    out["full_build_checked"] = timed(lambda: flow.load_files(fx.waiting(flow)))
    out["replay_3_of_30"] = timed(lambda: flow.fix_and_backfill(fx.day(6), fx.day(8)))
    out["replay_30_of_30"] = timed(lambda: flow.fix_and_backfill(fx.day(1), fx.day(30)))
    models = flow.table_models()
    out["suite_fused"] = timed(lambda: dq.evaluate(flow.suite, models).collect())
    out["suite_one_by_one"] = timed(lambda: [dq.evaluate([c], models).collect() for c in flow.suite])

    store = fx.new_store(spark, "bench_fact")
    fact = conform_sales(transform_sales(sales(spark, sf_dir)), stores(spark, sf_dir))
    out["write_fact"] = timed(lambda: overwrite_table(store, FACT, fact, ["sale_date"]))
    out["replace_3_of_30"] = timed(lambda: replace_days(store, FACT, fact, fx.days(6, 8)))
    last_five = fact.where(f"sale_date >= DATE'{fx.day(26)}'")
    out["upsert_5_of_30"] = timed(lambda: upsert_by_key(store, FACT, last_five, ["sale_id"]))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    for warm in ("fact_sale", "backfill_partial", "check_failures_union", "landing_union"):
        QUERIES[warm](spark, "/root/testdata/sf0.001").collect()
    times = {f"state_{build.__name__}": timed(lambda: fx.shared(build, spark, sf_dir)) for build in STATES}
    times |= {name: timed(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
              for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "figures": figures(spark, sf_dir), "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

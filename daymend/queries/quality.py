"""Queries over checks, audit and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymend.operators import checks as dq
from daymend.operators.conform import conform_sales, conform_stores
from daymend.operators.marts import daily_sales_flagged
from daymend.operators.stage import stage_sales, stage_stores
from daymend.operators.transform import transform_sales
from daymend.plans import audit, ledger, reports
from daymend.plans.flow import FACT
from daymend.queries.fixtures import (
    EVENT_TYPES, five_loads, mid_bug, mid_bug_drops, open_stores, shared, store_master,
)
from daymend.queries.models import sales, stores
from daymend.schema import EXPORT_TABLES, TOTAL

KNOWN_CHANNELS = [t for t in EVENT_TYPES if t != "error"]


def _lineitem(spark, sf_dir):
    return {"lineitem": dq.Model(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))}


def check_unique(spark, sf_dir):
    return dq.failures(dq.unique("lineitem", "l_orderkey", "l_linenumber"), _lineitem(spark, sf_dir))


def check_duplicates(spark, sf_dir):
    check = dq.duplicates("no_duplicate_parts", "lineitem", "l_orderkey", "l_partkey")
    return dq.failures(check, _lineitem(spark, sf_dir))


def _open_dim(spark, sf_dir):
    return conform_stores(stage_stores(open_stores(store_master(spark, sf_dir))))


def check_not_null(spark, sf_dir):
    joined = sales(spark, sf_dir).join(_open_dim(spark, sf_dir).select("store_id", "store_key"), "store_id", "left")
    missing = dq.failures(dq.not_null("fact_sale", "store_key"), {"fact_sale": dq.Model(joined)})
    return missing.select("sale_id", "store_id", "sale_date")


def check_accepted_values(spark, sf_dir):
    return dq.failures(dq.accepted_values("stg_sale", "channel", KNOWN_CHANNELS),
                       {"stg_sale": dq.Model(sales(spark, sf_dir))})


def check_relationships(spark, sf_dir):
    fact = conform_sales(transform_sales(sales(spark, sf_dir)), stores(spark, sf_dir))
    check = dq.relationships("fact_sale", "store_key", "dim_store", "store_key")
    models = {"fact_sale": dq.Model(fact), "dim_store": dq.Model(_open_dim(spark, sf_dir))}
    return dq.failures(check, models).select(F.col("from_key").cast("string").alias("from_key"))


def check_net_exceeds_gross(spark, sf_dir):
    flow = shared(mid_bug, spark, sf_dir)
    check = next(c for c in flow.suite if c.name == "net_never_exceeds_gross")
    return dq.failures(check, {"fact_sale": dq.Model(flow.store.read(FACT))})


def check_results(spark, sf_dir):
    """The whole suite over all tables, with a closed list of channels that lacks one."""
    models = shared(mid_bug, spark, sf_dir).table_models()
    return dq.evaluate(dq.sale_suite(KNOWN_CHANNELS), models)


def check_tally(spark, sf_dir):
    return dq.tally(check_results(spark, sf_dir))


def failed_checks(spark, sf_dir):
    """Red checks of the last build, as its gate recorded them."""
    flow = shared(mid_bug, spark, sf_dir, gate=True, channels=KNOWN_CHANNELS)
    return reports.failed_checks(flow.store)


def check_failures_union(spark, sf_dir):
    flow = shared(mid_bug, spark, sf_dir, gate=True, channels=KNOWN_CHANNELS)
    return dq.stored_failures(flow.store, flow.suite)


def row_count_audit(spark, sf_dir):
    store = shared(five_loads, spark, sf_dir, gate=True).store
    runs = ledger.run_ledger(store).select("seq", F.col("run_id").alias("invocation_id"))
    return store.read(audit.TABLE).join(runs, "invocation_id").select("seq", "model_name", "row_count")


def audit_latest(spark, sf_dir):
    store = shared(five_loads, spark, sf_dir, gate=True).store
    return audit.latest(store, limit=8).select("model_name", "row_count")


def run_history(spark, sf_dir):
    store = shared(five_loads, spark, sf_dir, gate=True).store
    return reports.run_history(store, limit=3).select(
        "seq", "action", "start_date", "end_date", "touched", "passed", "failed", "published",
        "message", "outcome", "converged")


def partition_status(spark, sf_dir):
    flow = shared(mid_bug, spark, sf_dir)
    return flow.store.read("dim_partition_status").drop("last_built_at", "dbt_run_timestamp")


def dm_daily_sales_flagged(spark, sf_dir):
    return daily_sales_flagged(shared(mid_bug, spark, sf_dir).store.read(FACT)).drop("net_ratio")


def net_ratio(spark, sf_dir):
    mart = daily_sales_flagged(shared(mid_bug, spark, sf_dir).store.read(FACT))
    return mart.select("sale_date", F.round("net_ratio", 6).alias("net_ratio"))


def bugged_partitions(spark, sf_dir):
    return reports.bugged_partitions(shared(mid_bug, spark, sf_dir).store) \
        .select("sale_date", "row_count", "gross_total", "net_total")


def summary(spark, sf_dir):
    return reports.summary(shared(mid_bug_drops, spark, sf_dir))


def daily_reconciliation(spark, sf_dir):
    return reports.daily_reconciliation(shared(mid_bug, spark, sf_dir))


def affected_days(spark, sf_dir):
    return reports.affected_days(reports.daily_reconciliation(shared(mid_bug, spark, sf_dir))) \
        .select("sale_date", "correct", "bugged", "current")


def net_delta(spark, sf_dir):
    flow = mid_bug(spark, sf_dir, "delta")
    return reports.net_delta(flow.store, flow.fix_and_backfill().seq)


def pending_partitions(spark, sf_dir):
    return shared(mid_bug_drops, spark, sf_dir).pending()


def next_pending(spark, sf_dir):
    flow = shared(mid_bug_drops, spark, sf_dir)
    return ledger.next_file(flow.landing.arrived(), flow.store)


def next_preview(spark, sf_dir):
    """The raw text of the next drop, typed."""
    rows = shared(mid_bug_drops, spark, sf_dir).next_preview()
    return stage_sales(rows).withColumns({c: F.col(c).cast("bigint") for c in ("sale_id", "store_id")})


def stage_relations(spark, sf_dir):
    """Totals of the stage and transform relations of a store, read by name."""
    store = shared(mid_bug_drops, spark, sf_dir).store
    sums = [F.sum(c).cast(TOTAL).alias(c) for c in ("gross_amount", "tax_amount")]
    none = F.lit(None).cast(TOTAL)
    staged = store.read("stg_sale").agg(F.lit("stg_sale").alias("name"), F.count("*").alias("n"), *sums, none.alias("net_amount"))
    transformed = store.read("trn_tbl_sale").agg(
        F.lit("trn_tbl_sale").alias("name"), F.count("*").alias("n"), *sums, F.sum("net_amount").cast(TOTAL).alias("net_amount"))
    stores_of = store.read("stg_store").agg(F.lit("stg_store").alias("name"), F.count("*").alias("n"),
                                            *[none.alias(c) for c in ("gross_amount", "tax_amount", "net_amount")])
    return staged.unionByName(transformed).unionByName(stores_of)


def mart_from_ledger(spark, sf_dir):
    """The daily mart from logged sums, without the fact."""
    totals = [F.col(c).cast(TOTAL).alias(c) for c in ("gross_total", "tax_total", "net_total")]
    return shared(mid_bug, spark, sf_dir).store.read("dm_daily_sales_kept").select("sale_date", "orders", *totals)


def backfill_range(spark, sf_dir):
    return ledger.backfill_range(shared(mid_bug, spark, sf_dir).store)


def touched_partitions(spark, sf_dir):
    return ledger.touched_partitions(ledger.backfill_range(shared(mid_bug, spark, sf_dir).store))


def bug_snapshot(spark, sf_dir):
    return ledger.snapshots(shared(mid_bug, spark, sf_dir).store)


def table_row_counts(spark, sf_dir):
    return shared(mid_bug, spark, sf_dir).store.row_counts(EXPORT_TABLES)


QUERIES = {f.__name__: f for f in (
    check_unique, check_duplicates, check_not_null, check_accepted_values, check_relationships,
    check_net_exceeds_gross, check_results, check_tally, failed_checks, check_failures_union, row_count_audit,
    audit_latest, run_history, partition_status, dm_daily_sales_flagged, net_ratio, bugged_partitions,
    summary, daily_reconciliation, affected_days, net_delta, pending_partitions, next_pending,
    next_preview, stage_relations, mart_from_ledger, backfill_range, touched_partitions, bug_snapshot, table_row_counts)}

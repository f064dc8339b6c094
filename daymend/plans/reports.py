"""Reports over the tables and ledgers of a flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.functions.digests import landed_hash, order_free, sale_hash
from daymend.functions.measures import CORRECT, net_amount
from daymend.operators.checks import failed
from daymend.operators.write import in_days
from daymend.plans import audit, ledger
from daymend.plans.flow import FACT, SalesFlow
from daymend.schema import CHECK_RESULTS, EXPORT_TABLES, HISTORY_LIMIT, SAMPLE_LIMIT, STAGE_RELATIONS, TOTAL
from daymend.sources.tables import TableStore


def daily_reconciliation(flow: SalesFlow) -> DataFrame:
    """Per landed day: the correct total, what was shown while wrong, and what the fact holds now.

    Correct comes from the landed amounts, current from the fact itself, so a lost or doubled row shows as
    a difference. ``wrong_rows`` counts fact rows whose net is not gross minus tax; unlike the
    day-level flag it also sees a wrong sign that totals hide.
    """
    correct = flow.landed_rows().groupBy("sale_date").agg(
        F.sum(net_amount(CORRECT)).cast(TOTAL).alias("correct"))
    current = flow.store.read(FACT).groupBy("sale_date").agg(
        F.sum("net_amount").cast(TOTAL).alias("current"),
        F.count_if(~F.col("net_amount").eqNullSafe(net_amount(CORRECT))).alias("wrong_rows"))
    shown = ledger.snapshots(flow.store).withColumnRenamed("bugged_total", "bugged")
    now = F.coalesce(F.col("current"), F.lit(0).cast(TOTAL))
    return correct.join(shown, "sale_date", "left").join(current, "sale_date", "left").select(
        "sale_date", "correct", "bugged", now.alias("current"),
        F.coalesce(F.col("wrong_rows"), F.lit(0)).alias("wrong_rows"),
        (now == F.col("correct")).alias("converged")).orderBy("sale_date")


def reconciliation_by_digest(flow: SalesFlow) -> DataFrame:
    """Per landed or published day: rows landed and published, whether they are the same sales, and how many are not.

    ``missing`` sales were landed and are not published as they are, ``extra`` ones the other way round; repeated rows count.
    ``wrong_rows`` counts published rows whose net is not gross minus tax. The digest of landed days was kept
    as they landed, so days are compared without reading the landed rows; only days that differ are read again and
    compared row by row. A swap of amounts between sales, which leaves all totals as they are, shows in the digest.
    """
    differ = days_that_differ(flow)
    days = [r.sale_date for r in differ.where("not same").select("sale_date").collect()]
    rows = differing_rows(flow, days).groupBy("sale_date").agg(
        F.sum(F.greatest("surplus", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("surplus"), F.lit(0))).alias("extra"))
    rows = rows.withColumnRenamed("sale_date", "day")
    none = F.lit(0).cast("long")
    return differ.join(rows, F.col("sale_date").eqNullSafe(F.col("day")), "left").select(
        "sale_date", "landed", "published", "same", F.coalesce("missing", none).alias("missing"),
        F.coalesce("extra", none).alias("extra"), "wrong_rows")


def days_that_differ(flow: SalesFlow) -> DataFrame:
    """Numbers of landed and published rows per day, and whether their digests are the same."""
    landed = flow.landing.digests(flow.loaded()).select("sale_date", F.col("n").alias("landed"), F.col("digest").alias("expected"))
    n, digest = order_free(sale_hash(F.col("store_key")))
    wrong = F.count_if(~F.col("net_amount").eqNullSafe(net_amount(CORRECT))).alias("wrong_rows")
    published = flow.store.read(FACT).groupBy(F.col("sale_date").alias("day")).agg(n, digest.cast("string").alias("digest"), wrong)
    both = landed.join(published, F.col("sale_date").eqNullSafe(F.col("day")), "full")
    none = F.lit(0).cast("long")
    return both.select(
        F.coalesce("sale_date", "day").alias("sale_date"), F.coalesce("landed", none).alias("landed"),
        F.coalesce("n", none).alias("published"), F.coalesce(F.col("expected") == F.col("digest"), F.lit(False)).alias("same"),
        F.coalesce("wrong_rows", none).alias("wrong_rows"))


def differing_rows(flow: SalesFlow, days: list) -> DataFrame:
    """Sales of the given days that are not landed and published equally often: sale_date, sale_id, surplus of landed ones."""
    side = lambda rows, hashed, sign: rows.select("sale_date", "sale_id", hashed.alias("hash"), F.lit(sign).alias("sign"))
    landed = side(flow.landing.rows(days, flow.loaded()), landed_hash(), 1)
    published = side(flow.store.read(FACT).where(in_days(F.col("sale_date"), days)), sale_hash(F.col("store_key")), -1)
    return landed.unionByName(published).groupBy("sale_date", "sale_id", "hash").agg(F.sum("sign").alias("surplus")) \
        .where("surplus <> 0").drop("hash")


def affected_days(reconciliation: DataFrame) -> DataFrame:
    """Days that were ever shown wrong or are off now."""
    return reconciliation.where("bugged IS NOT NULL OR current IS DISTINCT FROM correct")


def bugged_partitions(store: TableStore) -> DataFrame:
    return ledger.partition_status(store).where("bugged")


def summary(flow: SalesFlow) -> DataFrame:
    """One row: net total, partitions built and bugged, formula flag, fact rows, and the queue with the names of its files."""
    store = flow.store
    fact = store.read(FACT).agg(
        F.coalesce(F.sum("net_amount"), F.lit(0)).cast(TOTAL).alias("net_total"),
        F.count("*").alias("fact_rows"))
    status = ledger.partition_status(store).agg(
        F.count("*").alias("partitions_built"), F.count_if("bugged").alias("partitions_bugged"))
    flag = ledger.run_ledger(store).agg(
        F.coalesce(F.max_by("formula", "seq") != CORRECT, F.lit(False)).alias("tax_bug_active"))
    names = F.array_join(F.sort_array(F.collect_set("source_file")), ",")
    loaded = ledger.loaded_files(store).agg(F.count("*").alias("files_loaded"), names.alias("loaded_files"))
    pending = ledger.pending_files(flow.landing.arrived(), store).agg(
        F.count("*").alias("files_pending"), F.min("source_file").alias("next_file"), names.alias("pending_files"))
    return _side_by_side(fact, status, flag, loaded, pending)


def net_delta(store: TableStore, seq: int) -> DataFrame:
    """One row: net total of the fact before and after build ``seq``, and the change."""
    before = ledger.current_days(store, seq - 1).agg(F.sum("fact_net_total").alias("before"))
    after = ledger.current_days(store, seq).agg(F.sum("fact_net_total").alias("after"))
    nets = _side_by_side(before, after)
    zero = F.lit(0).cast(TOTAL)
    return nets.select(F.coalesce("before", zero).cast(TOTAL).alias("net_before"),
                       F.coalesce("after", zero).cast(TOTAL).alias("net_after")) \
        .select("*", (F.col("net_after") - F.col("net_before")).cast(TOTAL).alias("delta"))


def run_history(store: TableStore, limit: int = HISTORY_LIMIT) -> DataFrame:
    """The newest runs first."""
    return ledger.run_ledger(store).orderBy(F.desc("seq")).limit(limit)


def check_results(store: TableStore) -> DataFrame:
    """Check results of the newest checked build."""
    log = store.read_or_empty("check_results", CHECK_RESULTS)
    newest = log.agg(F.max("seq").alias("seq"))
    return log.join(newest, "seq", "left_semi").drop("seq")


def failed_checks(store: TableStore) -> DataFrame:
    return failed(check_results(store))


def model_sample(relation: DataFrame, limit: int = SAMPLE_LIMIT) -> DataFrame:
    """The first rows in the order of all columns, left to right, NULLs last."""
    return relation.orderBy(*[F.asc_nulls_last(c) for c in relation.columns]).limit(limit)


def export_json(flow: SalesFlow, folder: str, whole_tables: bool = False) -> None:
    """Write every report as JSON lines, with a sample of each relation; decimals stay numbers.

    ``whole_tables`` adds the exported tables with all their rows, the fact included.
    """
    store = flow.store
    relations = [name for name in (*EXPORT_TABLES, *STAGE_RELATIONS) if store.exists(name)]
    reports = {
        "summary": summary(flow),
        "daily_series": daily_reconciliation(flow),
        "row_counts": store.row_counts(EXPORT_TABLES),
        "history": run_history(store),
        "audit": audit.latest(store),
        "next_file": flow.next_preview(),
        "check_results": check_results(store),
        **{f"table_{t}": store.read(t) for t in EXPORT_TABLES if whole_tables},
        **{f"sample_{t}": model_sample(store.read(t)) for t in relations},
    }
    for name, frame in reports.items():
        frame.write.mode("overwrite").json(f"{folder}/{name}")


def _side_by_side(*one_row: DataFrame) -> DataFrame:
    """Columns of one-row frames in one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

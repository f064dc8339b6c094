"""Queries over the write path: they write, replay and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymend.functions.measures import NET_PLUS_TAX
from daymend.operators import checks as dq
from daymend.operators.conform import conform_sales, conform_stores, fact_rows, heavy_stores, with_keys_split
from daymend.operators.stage import stage_sales, stage_stores
from daymend.operators.transform import transform_sales
from daymend.operators.write import in_days, overwrite_table, replace_days
from daymend.operators.write import upsert_by_key as upsert
from daymend.plans import ledger, reports
from daymend.plans.flow import FACT, ChecksFailed
from daymend.queries.fixtures import (
    day, days, drops_flow, events_between, events_flow, mid_bug, names, new_store, open_stores, shared,
    store_master, waiting, write_drops,
)
from daymend.queries.models import sales, shown, stores
from daymend.schema import EXPORT_TABLES, MONEY, TOTAL
from daymend.session import fresh_root
from daymend.sources.csv_files import read_drops, read_master
from daymend.sources.files import drops, write_text
from daymend.sources.landing import CsvLanding, FrameLanding
from daymend.streaming.arrivals import run_drops


def _all_wrong(spark, sf_dir, label):
    """Every day loaded while the wrong formula was in force."""
    flow = events_flow(spark, sf_dir, label)
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    flow.load_files(waiting(flow))
    return flow


def _partly_fixed(spark, sf_dir, label):
    flow = _all_wrong(spark, sf_dir, label)
    flow.fix_and_backfill(day(6), day(8))
    return flow


def _published(flow):
    return shown(flow.store.read(FACT))


def full_refresh_bugged(spark, sf_dir):
    flow = events_flow(spark, sf_dir, "refresh")
    flow.load_files(waiting(flow))
    flow.switch_formula(NET_PLUS_TAX)
    return _published(flow)


def backfill_partial(spark, sf_dir):
    return _published(_partly_fixed(spark, sf_dir, "partial"))


def backfill_partial_mart(spark, sf_dir):
    """The daily mart after the bounded backfill."""
    flow = _partly_fixed(spark, sf_dir, "mart")
    totals = [F.col(c).cast("decimal(38,2)").alias(c) for c in ("gross_total", "tax_total", "net_total")]
    return flow.store.read("dm_daily_sales").select("sale_date", "orders", *totals)


def backfill_full(spark, sf_dir):
    flow = mid_bug(spark, sf_dir, "full")
    flow.fix_and_backfill()
    flow.load_files([r.source_file for r in flow.pending().collect()])
    return _published(flow)


def replay_idempotent(spark, sf_dir):
    flow = _partly_fixed(spark, sf_dir, "again")
    flow.fix_and_backfill(day(6), day(8))
    flow.fix_and_backfill(day(6), day(8))
    return _published(flow)


def replay_noop(spark, sf_dir):
    flow = events_flow(spark, sf_dir, "noop")
    flow.load_files(waiting(flow))
    flow.replay([])
    flow.fix_and_backfill()
    return _published(flow)


def load_next_day(spark, sf_dir):
    """All files but the last three in one load, these by name one after the other, from written drops."""
    flow, _ = drops_flow(spark, sf_dir, "next")
    flow.load_files(waiting(flow)[:-3])
    while flow.load_next().files:
        pass
    return _numbered(flow)


def late_rows_replay(spark, sf_dir):
    """Sales of the 12th day after 22:00 miss its first file; only the complete file of that day comes again."""
    complete = events_between(spark, sf_dir)
    late = (F.col("sale_date") == F.lit(day(12))) & (F.hour("ts") >= 22)
    flow = events_flow(spark, sf_dir, "late")
    flow.landing = FrameLanding(lambda lo, hi: complete(lo, hi).where(~late))
    flow.load_files(waiting(flow))
    flow.landing = FrameLanding(complete)
    flow.load_files(names(12, 12))
    return _published(flow)


def refused_file_stays_out(spark, sf_dir):
    """A file refused under the wrong formula is not published by a repair whose range covers its day."""
    flow, _ = drops_flow(spark, sf_dir, "refused", gate=True, publish_on_red=False)
    flow.load_files([n for n in waiting(flow) if n <= day(25).isoformat()])
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    _refused(flow.load_next)
    flow.fix_and_backfill(day(24), day(28))
    return _numbered(flow)


def refused_file_does_not_block(spark, sf_dir):
    """A file refused for a doubled sale leaves its neighbours repairable; delivered again it is taken in."""
    whole = events_between(spark, sf_dir)
    doubled = F.explode(F.when(F.col("sale_date") == F.lit(day(26)), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    flow = events_flow(spark, sf_dir, "blocked", gate=True, publish_on_red=False)
    flow.landing = FrameLanding(lambda lo, hi: whole(lo, hi).withColumn("copy", doubled))
    flow.load_files([n for n in waiting(flow) if n <= day(25).isoformat()])
    _refused(flow.load_next)
    flow.fix_and_backfill(day(24), day(27))
    flow.landing = FrameLanding(whole)
    flow.load_files([r.source_file for r in flow.pending().collect()])
    return _published(flow)


def backfill_by_key(spark, sf_dir):
    """Loads and a repair that publish by sale id, behind the gate."""
    flow = mid_bug(spark, sf_dir, "by_key", gate=True, by_key=True)
    flow.fix_and_backfill()
    flow.load_files([r.source_file for r in flow.pending().collect()])
    return _published(flow)


def orphaned_by_dimension_change(spark, sf_dir):
    """What the gate of a one-day replay counts once a region has left the master list: sales of other days too."""
    flow = events_flow(spark, sf_dir, "orphaned", gate=True, refresh_dimension=True)
    flow.load_files(waiting(flow))
    flow.stores = open_stores(flow.stores)
    flow.replay([day(7)])
    return reports.check_results(flow.store).where("kind = 'relationships'").select("check", "failures", "status")


def master_from_file(spark, sf_dir):
    """The store master as a CSV file, read typed and conformed."""
    path = fresh_root(spark, "master")
    store_master(spark, sf_dir).write.option("header", True).csv(path)
    dim = conform_stores(stage_stores(read_master(spark, path)))
    return dim.withColumn("store_key", F.col("store_key").cast("string"))


def _refused(action):
    try:
        action()
    except ChecksFailed:
        return
    raise RuntimeError("the gate let a red batch through")


def _numbered(flow):
    return _published(flow).withColumn("sale_id", F.col("sale_id").cast("bigint"))


def _written_fact(spark, sf_dir, label):
    store = new_store(spark, label)
    fact = conform_sales(transform_sales(sales(spark, sf_dir)), stores(spark, sf_dir))
    overwrite_table(store, FACT, fact, ["sale_date"])
    return store, fact


def range_replace(spark, sf_dir):
    """Days 10..12 from a source that lost the 11th and the errors of the 12th."""
    store, fact = _written_fact(spark, sf_dir, "range")
    lost = (F.col("sale_date") == F.lit(day(11))) | \
        ((F.col("sale_date") == F.lit(day(12))) & (F.col("channel") == "error"))
    replace_days(store, FACT, fact.where(~lost), days(10, 12))
    return shown(store.read(FACT))


def upsert_by_key(spark, sf_dir):
    """Corrections for the last three days: gross one higher, and views belong to the day after."""
    store, fact = _written_fact(spark, sf_dir, "upsert")
    moved = F.when(F.col("channel") == "view", F.date_add("sale_date", 1)).otherwise(F.col("sale_date"))
    raised = (F.col("gross_amount") + F.lit(1)).cast(MONEY)
    batch = fact.where(F.col("sale_date") >= F.lit(day(28))).select(
        "sale_key", "sale_id", "store_key", moved.alias("sale_date"), "channel",
        raised.alias("gross_amount"), "tax_amount",
        (raised - F.col("tax_amount")).cast("decimal(11,2)").alias("net_amount"))
    upsert(store, FACT, batch, ["sale_id"])
    return shown(store.read(FACT))


def reset_empty(spark, sf_dir):
    flow = mid_bug(spark, sf_dir, "reset")
    flow.reset()
    return flow.store.row_counts(EXPORT_TABLES)


def csv_ingest(spark, sf_dir):
    folder = fresh_root(spark, "drops")
    write_drops(spark, sf_dir, folder)
    roots = [path for _, path in drops(spark, folder)]
    return _typed(stage_sales(read_drops(spark, roots)))


def landing_union(spark, sf_dir):
    """Drops with three headers, landed in two goes, the last days delivered twice."""
    folder = fresh_root(spark, "drops")
    write_drops(spark, sf_dir, folder, without_channel_after=20)
    landing = CsvLanding(new_store(spark, "landing"), folder)
    arrived = sorted(r.source_file for r in landing.arrived().collect())
    landing.land([n for n in arrived if n <= day(25).isoformat()])
    landing.land([n for n in arrived if n > day(20).isoformat()])
    return _typed(landing.rows(landing.days(arrived)))


def _marked(spark, folder):
    """Markers beside all drops of a folder."""
    for name, path in drops(spark, folder):
        write_text(spark, f"{path.rsplit('/', 1)[0]}/{name}.done", "complete\n")


def stream_ingest_daily(spark, sf_dir):
    flow, folder = drops_flow(spark, sf_dir, "stream")
    _marked(spark, folder)
    run_drops(flow, folder, fresh_root(spark, "stream_checkpoint"), max_files_per_trigger=10)
    return _numbered(flow)


def stream_parts_once(spark, sf_dir):
    """Days of twenty part files each, seven files a trigger: how often each day was built, and its sums."""
    flow = events_flow(spark, sf_dir, "parts")
    folder = fresh_root(spark, "parts")
    write_drops(spark, sf_dir, folder, change=lambda rows: rows.where(F.col("sale_date") <= F.lit(day(3))), parts=20)
    _marked(spark, folder)
    flow.landing = CsvLanding(flow.store, folder)
    flow.stores = store_master(spark, sf_dir).withColumn("store_id", F.col("store_id").cast("string"))
    run_drops(flow, folder, fresh_root(spark, "parts_checkpoint"), max_files_per_trigger=7)
    built = ledger.day_ledger(flow.store).groupBy("sale_date").agg(F.count("*").alias("builds"))
    return built.join(_day_sums(flow), "sale_date")


def _day_sums(flow):
    return flow.store.read(FACT).groupBy("sale_date").agg(
        F.count("*").alias("orders"), F.sum("net_amount").cast(TOTAL).alias("net_total"))


def _last_builds(flow):
    """Sums of each day and the number of the build that it is from."""
    return ledger.current_days(flow.store).select("sale_date", "seq").join(_day_sums(flow), "sale_date")


def redelivery_unchanged(spark, sf_dir):
    """All drops come again with their rows in another order and layout: no day is built again."""
    flow, folder = drops_flow(spark, sf_dir, "redelivered")
    flow.load_files(waiting(flow))
    flow.landing.folder = fresh_root(spark, "drops")
    write_drops(spark, sf_dir, flow.landing.folder, parts=2)
    flow.load_files(waiting(flow))
    return _last_builds(flow)


def redelivery_changed(spark, sf_dir):
    """All drops come again, those of the 9th day with errors a cent dearer: that day alone is built again."""
    flow, _ = drops_flow(spark, sf_dir, "corrected")
    flow.load_files(waiting(flow))
    flow.landing.folder = fresh_root(spark, "drops")
    hit = (F.col("sale_date") == F.lit(day(9))) & (F.col("channel") == "error")
    dearer = F.when(hit, F.col("gross_amount") + F.lit("0.01").cast(MONEY)).otherwise(F.col("gross_amount")).cast(MONEY)
    write_drops(spark, sf_dir, flow.landing.folder, change=lambda rows: rows.withColumn("gross_amount", dearer))
    flow.load_files(waiting(flow))
    return _last_builds(flow)


def reconciliation_by_digest(spark, sf_dir):
    """Two sales of the 9th day swap their amounts in the fact, one of the 12th is lost: totals of the 9th stay as they are."""
    flow, _ = drops_flow(spark, sf_dir, "swapped")
    flow.load_files(waiting(flow))
    fact = flow.store.read(FACT).where(in_days(F.col("sale_date"), [day(9), day(12)]))
    numbered = F.struct(F.col("sale_id").cast("bigint").alias("sale_id"), *_AMOUNTS)
    ends = fact.groupBy("sale_date").agg(F.min(numbered).alias("first"), F.max(numbered).alias("last"))
    of_day = F.col("sale_date") == F.lit(day(9))
    number = F.col("sale_id").cast("bigint")
    at_first, at_last = number == F.col("first.sale_id"), number == F.col("last.sale_id")
    swapped = {c: F.when(of_day & at_first, F.col(f"last.{c}")).when(of_day & at_last, F.col(f"first.{c}")).otherwise(F.col(c))
               for c in _AMOUNTS}
    broken = fact.join(F.broadcast(ends), "sale_date").where(of_day | ~at_first).withColumns(swapped)
    aside = "broken"
    overwrite_table(flow.store, aside, broken.select(*fact.columns), ["sale_date"])
    replace_days(flow.store, FACT, flow.store.read(aside), [day(9), day(12)])
    return reports.reconciliation_by_digest(flow)


_AMOUNTS = ("gross_amount", "tax_amount", "net_amount")


def cross_day_duplicates(spark, sf_dir):
    """Sales of the 30th day under ids of the 5th: what the gate of a one-day load keeps as failing keys."""
    taken = F.when((F.col("sale_date") == F.lit(day(30))) & (F.col("channel") == "signup"), F.col("lent")).otherwise(F.col("sale_id"))

    def planted(rows):
        lent = rows.where(F.col("sale_date") == F.lit(day(5))).agg(F.min("sale_id").alias("lent"))
        return rows.join(F.broadcast(lent), F.lit(True)).withColumn("sale_id", taken).drop("lent")

    flow, _ = drops_flow(spark, sf_dir, "planted", change=planted, gate=True, publish_on_red=False)
    flow.load_files(waiting(flow)[:-1])
    _refused(flow.load_next)
    return flow.store.read(dq.FAILURE_PREFIX + "no_duplicate_sale_ids").select(F.col("sale_id").cast("bigint").alias("sale_id"), "n")


def hot_store_join(spark, sf_dir):
    """Views all go to one store, errors to none; the dimension is too large for a broadcast."""
    hot = F.when(F.col("channel") == "view", 1).when(F.col("channel") != "error", F.col("store_id"))
    rows = transform_sales(sales(spark, sf_dir).withColumn("store_id", hot.cast("bigint")))
    keyed = with_keys_split(rows, stores(spark, sf_dir), heavy_stores(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return shown(fact_rows(keyed))


def ledger_load(spark, sf_dir):
    flow = shared(mid_bug, spark, sf_dir)
    built = ledger.current_days(flow.store).select(
        F.col("sale_date").cast("string").alias("source_file"), "formula")
    return ledger.loaded_files(flow.store).join(built, "source_file", "left")


def ledger_contaminate(spark, sf_dir):
    flow = mid_bug(spark, sf_dir, "contaminated")
    flow.switch_formula(NET_PLUS_TAX)
    return ledger.contaminated_days(flow.store)


def _typed(staged):
    """Ids of the CSV text as numbers again, to compare with their table of origin."""
    return staged.withColumns({c: F.col(c).cast("bigint") for c in ("sale_id", "store_id")})


QUERIES = {f.__name__: f for f in (
    full_refresh_bugged, backfill_partial, backfill_partial_mart, backfill_full, replay_idempotent,
    replay_noop, load_next_day, late_rows_replay, refused_file_stays_out, refused_file_does_not_block,
    backfill_by_key, orphaned_by_dimension_change, master_from_file, range_replace, upsert_by_key, reset_empty, csv_ingest,
    landing_union, stream_ingest_daily, stream_parts_once, redelivery_unchanged, redelivery_changed, reconciliation_by_digest,
    cross_day_duplicates, hot_store_join, ledger_load, ledger_contaminate)}

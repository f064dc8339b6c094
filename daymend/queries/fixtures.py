"""Binding of the sale model to the given tables.

``events`` is the sale stream (one drop per calendar day of ``ts``), ``customer`` with its nation and
region is the store master.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymend.functions.measures import NET_PLUS_TAX
from daymend.plans import ledger
from daymend.plans.flow import FACT, SalesFlow
from daymend.session import fresh_root, shared_dir
from daymend.sources.landing import CsvLanding, FrameLanding
from daymend.sources.tables import TableStore

FIRST_DAY = date(2024, 1, 1)
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
CLOSED_REGION = "ASIA"


def day(n: int) -> date:
    """The n-th day of the stream, from 1."""
    return FIRST_DAY + timedelta(days=n - 1)


def days(first: int, last: int) -> list[date]:
    return [day(n) for n in range(first, last + 1)]


def names(first: int, last: int) -> list[str]:
    return [d.isoformat() for d in days(first, last)]


def waiting(flow: SalesFlow) -> list[str]:
    """Names of all files that have arrived, in order."""
    return sorted(r.source_file for r in flow.landing.arrived().collect())


def events_between(spark: SparkSession, sf_dir: str) -> Callable[[date | None, date | None], DataFrame]:
    """Landing rows of a date range; the range reaches the Parquet scan as a filter on ``ts``."""
    def rows(start: date | None, end: date | None) -> DataFrame:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        if start is not None:
            events = events.where(F.col("ts") >= _midnight(start))
        if end is not None:
            events = events.where(F.col("ts") < _midnight(end + timedelta(days=1)))
        gross = F.col("value").cast("decimal(10,2)")
        share = F.get_json_object("props", "$.k").cast("decimal(4,0)")
        tax = (gross * share * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(10,2)")
        sale_date = F.col("ts").cast("date")
        return events.select(
            F.col("event_id").alias("sale_id"), F.col("user_id").alias("store_id"),
            sale_date.alias("sale_date"), gross.alias("gross_amount"), tax.alias("tax_amount"),
            F.col("event_type").alias("channel"), sale_date.cast("string").alias("source_file"), "ts")
    return rows


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_between(spark, sf_dir)(None, None)


def store_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet")
                                for t in ("customer", "nation", "region"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("c_custkey").alias("store_id"), F.col("c_name").alias("store_name"),
                F.col("r_name").alias("region"))


def open_stores(stores: DataFrame) -> DataFrame:
    """The master list without one region: its sales become orphans."""
    return stores.where(F.col("region") != CLOSED_REGION)


def new_store(spark: SparkSession, label: str) -> TableStore:
    return TableStore(spark, fresh_root(spark, label))


def events_flow(spark: SparkSession, sf_dir: str, label: str, *, gate: bool = False, **options) -> SalesFlow:
    """A new flow over the event stream. The demo formula is wrong on purpose, so red is published."""
    options.setdefault("channels", EVENT_TYPES)
    options.setdefault("publish_on_red", True)
    options.setdefault("refresh_dimension", False)
    return SalesFlow(new_store(spark, label), FrameLanding(events_between(spark, sf_dir)),
                     store_master(spark, sf_dir), gate=gate, **options)


def mid_bug(spark: SparkSession, sf_dir: str, label: str, **options) -> SalesFlow:
    """Files up to the 20th day right, 21..25 loaded while the wrong formula was in force, all later ones pending."""
    flow = events_flow(spark, sf_dir, label, **options)
    flow.load_files([n for n in waiting(flow) if n <= day(20).isoformat()])
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    flow.load_files(names(21, 25))
    return flow


def five_loads(spark: SparkSession, sf_dir: str, label: str, **options) -> SalesFlow:
    """All days in five loads of equal length."""
    flow = events_flow(spark, sf_dir, label, **options)
    files = waiting(flow)
    step = -(-len(files) // 5)
    for first in range(0, len(files), step):
        flow.load_files(files[first:first + step])
    return flow


_BUILT: dict[tuple, SalesFlow] = {}


def shared(build: Callable[..., SalesFlow], spark: SparkSession, sf_dir: str, **options) -> SalesFlow:
    """A state that report queries only read, built once per session and input.

    Writing the whole fact again for every report would cost far more than the reports. The state
    is built anew when the input files changed or its tables are no longer complete.
    """
    key = (build.__name__, sf_dir, spark.sparkContext.applicationId, shared_dir(spark),
           _fingerprint(spark, sf_dir), str(sorted(options.items())))
    if key not in _BUILT or not _complete(_BUILT[key]):
        _BUILT[key] = build(spark, sf_dir, build.__name__, **options)
    return _BUILT[key]


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Number, size and newest time of the input files, from the listing alone."""
    paths = [f"{sf_dir}/{t}.parquet" for t in ("events", "customer", "nation", "region")]
    files = spark.read.format("binaryFile").load(paths)
    return tuple(files.agg(F.count("*"), F.sum("length"), F.max("modificationTime")).first())


def _complete(flow: SalesFlow) -> bool:
    """The fact still holds what the ledger says; counting reads Parquet footers only."""
    try:
        logged = ledger.current_days(flow.store).agg(F.sum("fact_rows").alias("n")).first().n
        return logged is not None and flow.store.read(FACT).count() == logged
    except PySparkException:
        return False


def drops_flow(spark: SparkSession, sf_dir: str, label: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows,
               **options) -> tuple[SalesFlow, str]:
    """A flow over written CSV drops, and their folder; ids are text there. ``change`` alters the rows of the drops."""
    folder = fresh_root(spark, "drops")
    write_drops(spark, sf_dir, folder, change=change)
    flow = events_flow(spark, sf_dir, label, **options)
    flow.landing = CsvLanding(flow.store, folder)
    flow.stores = store_master(spark, sf_dir).withColumn("store_id", F.col("store_id").cast("string"))
    return flow, folder


def mid_bug_drops(spark: SparkSession, sf_dir: str, label: str) -> SalesFlow:
    """``mid_bug`` over written drops: all of them lie in the folder, those after the 25th day are pending."""
    flow, _ = drops_flow(spark, sf_dir, label)
    flow.load_files([n for n in waiting(flow) if n <= day(20).isoformat()])
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    flow.load_files([n for n in waiting(flow) if day(20).isoformat() < n <= day(25).isoformat()])
    return flow


def write_drops(spark: SparkSession, sf_dir: str, folder: str, without_channel_after: int | None = None,
                change: Callable[[DataFrame], DataFrame] = lambda rows: rows, parts: int | None = None) -> None:
    """The stream as daily CSV drops. Odd and even days differ in column order and carry an extra
    column; on request late days lack the channel. ``parts`` deals each day into so many part files at least."""
    sales = change(raw_sales(spark, sf_dir).drop("ts"))
    plain = ["sale_id", "store_id", "sale_date", "gross_amount", "tax_amount", "channel"]
    swapped = ["tax_amount", "channel", "note", "gross_amount", "sale_date", "sale_id", "store_id"]
    odd = F.day("sale_date") % 2 == 1
    tagged = sales.withColumn("drop", F.concat("source_file", F.lit(".csv"))).withColumn("note", F.lit("x"))
    kinds = [(odd, plain), (~odd, swapped)]
    if without_channel_after is not None:
        late = F.col("sale_date") > F.lit(day(without_channel_after))
        kinds = [(odd & ~late, plain), (~odd & ~late, swapped),
                 (late, [c for c in plain if c != "channel"])]
    for condition, columns in kinds:
        rows = tagged.where(condition).select("drop", *columns)
        rows = rows.repartition(parts) if parts else rows.hint("rebalance", "drop")
        rows.write.mode("append").partitionBy("drop").option("header", True).csv(folder)


def _midnight(when: date):
    return F.to_timestamp_ntz(F.lit(when.isoformat()))

"""Ledgers: append-only tables from which the state of the flow is derived.

``day_ledger`` holds one row per build and day it touched. The latest row of a day says what the
day holds now, so status, contaminated days and snapshots are views of it and cannot drift apart.
``run_ledger`` holds one row per action, with the files it took in; it is written last, so
a file counts as loaded only once its rows are published. Both grow with days and actions, never with sales.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.functions.measures import CORRECT, days_inclusive, is_bugged
from daymend.operators.write import append_rows
from daymend.schema import DAY_LEDGER, RUN_LEDGER
from daymend.sources.local import local_frame
from daymend.sources.tables import TableStore


def append(store: TableStore, name: str, schema: T.StructType, rows: Sequence[tuple]) -> None:
    if rows:
        append_rows(store, name, local_frame(store.spark, schema, rows))


def day_ledger(store: TableStore) -> DataFrame:
    return store.read_or_empty("day_ledger", DAY_LEDGER)


def run_ledger(store: TableStore) -> DataFrame:
    return store.read_or_empty("run_ledger", RUN_LEDGER)


def loaded_files(store: TableStore) -> DataFrame:
    return run_ledger(store).where("published").select(F.explode("files").alias("source_file")).distinct()


def pending_files(arrived: DataFrame, store: TableStore) -> DataFrame:
    """Arrived files that are not loaded yet, in name order."""
    return arrived.select("source_file").join(loaded_files(store), "source_file", "left_anti") \
        .orderBy("source_file")


def next_file(arrived: DataFrame, store: TableStore) -> DataFrame:
    return pending_files(arrived, store).limit(1)


def position(store: TableStore) -> tuple[int, str]:
    """Number of the last build, and the formula in force."""
    runs = run_ledger(store).select("seq", "formula")
    builds = day_ledger(store).select("seq", F.lit(None).cast("string").alias("formula"))
    last = runs.unionByName(builds).agg(
        F.max("seq").alias("seq"),
        F.max_by("formula", F.when(F.col("formula").isNotNull(), F.col("seq"))).alias("formula")).first()
    return last.seq or 0, last.formula or CORRECT


def current_days(store: TableStore, as_of: int | None = None) -> DataFrame:
    """The latest ledger row of every day that holds rows, as the table stood after build ``as_of``."""
    log = day_ledger(store)
    if as_of is not None:
        log = log.where(F.col("seq") <= as_of)
    fields = [c for c in log.columns if c != "sale_date"]
    last = F.max_by(F.struct(*fields), F.struct("seq", "built_at"))
    return log.groupBy("sale_date").agg(last.alias("last")) \
        .select("sale_date", "last.*").where("row_count > 0")


def partition_status(store: TableStore) -> DataFrame:
    """One row per day: totals, bugged flag, who built it and when."""
    return current_days(store).select(
        "sale_date", "row_count", "gross_total", "net_total", is_bugged().alias("bugged"),
        F.col("action").alias("built_by_action"), F.col("built_at").alias("last_built_at"),
        F.col("built_at").alias("dbt_run_timestamp"))


def contaminated_days(store: TableStore) -> DataFrame:
    """Days whose current rows were built with a wrong formula."""
    return current_days(store).where(F.col("formula") != CORRECT).select("sale_date", "formula")


def snapshots(store: TableStore) -> DataFrame:
    """What each ever contaminated day showed while it was wrong; kept after the fix."""
    wrong = day_ledger(store).where((F.col("formula") != CORRECT) & (F.col("row_count") > 0))
    return wrong.groupBy("sale_date").agg(
        F.max_by("net_total", F.struct("seq", "built_at")).alias("bugged_total"))


def backfill_range(store: TableStore, start: date | None = None, end: date | None = None) -> DataFrame:
    """One row: the range to replay. Explicit ends win over those of the contaminated days."""
    return contaminated_days(store).agg(
        F.coalesce(F.lit(start).cast("date"), F.min("sale_date")).alias("start_date"),
        F.coalesce(F.lit(end).cast("date"), F.max("sale_date")).alias("end_date"))


def touched_partitions(ranges: DataFrame) -> DataFrame:
    """Calendar days of each range, both ends counted; 0 where an end is missing, an error where it is reversed."""
    days = F.when(F.col("start_date") > F.col("end_date"), F.raise_error(F.lit("range starts after it ends")).cast("int")) \
        .otherwise(days_inclusive(F.col("start_date"), F.col("end_date")))
    return ranges.select(F.coalesce(days, F.lit(0)).cast("long").alias("touched"))

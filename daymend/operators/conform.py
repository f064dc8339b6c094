"""Conformed layer: store dimension, sale fact, per-day totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymend.functions.keys import surrogate_key
from daymend.operators.write import lay_out_by_day
from daymend.schema import TOTAL

BROADCAST_LIMIT = 16 * 1024 * 1024
HEAVY = 200  # stores that are told apart as heavy
_ROW_OVERHEAD = 64  # bytes: decimal key, row header, hash slot


def conform_stores(staged: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return staged.select(surrogate_key("store_id").alias("store_key"), "store_id", "store_name",
                         "region", *_stamps(run_ts))


def with_keys(transformed: DataFrame, dim_store: DataFrame, lay_out: bool = False) -> DataFrame:
    """All sales with both keys; ``store_key`` is NULL where the store is unknown.

    No join hint: the caller's dimension may carry one. ``lay_out`` puts the joined rows in day
    order for a write, before the sale key makes them wider.
    """
    stores = dim_store.select("store_id", "store_key")
    joined = transformed.join(stores, "store_id", "left").select(*transformed.columns, "store_key")
    if lay_out:
        joined = lay_out_by_day(joined)
    return joined.select("*", surrogate_key("sale_id").alias("sale_key"))


def heavy_stores(rows: DataFrame, parts: int, most: int = HEAVY) -> list:
    """Store ids that hold more rows than an even share of ``parts`` shuffle partitions; ``most`` of them at most.

    A sketch of the most frequent ids, so one pass over one column whatever the number of stores. An id that it misses
    or overrates only changes which of two equal joins its rows take.
    """
    found = rows.agg(F.expr(f"approx_top_k(store_id, {most}, {8 * most})").alias("top"), F.count("*").alias("n")).first()
    return [x["item"] for x in found.top if x["item"] is not None and x["count"] * parts > found.n]


def with_keys_split(transformed: DataFrame, dim_store: DataFrame, heavy: Sequence, lay_out: bool = False) -> DataFrame:
    """``with_keys`` for a dimension that is too large for a broadcast while a few stores hold much of the sales.

    Rows of heavy stores, and rows without a store, meet a broadcast slice of the dimension, one row for each of them; all
    others are shuffled. No shuffle partition then holds more of one store than its even share.
    """
    if not heavy:
        return with_keys(transformed, dim_store.hint("merge"), lay_out)
    hot = F.coalesce(F.col("store_id").isin(list(heavy)), F.lit(True))
    stores = dim_store.select("store_id", "store_key")
    sides = [transformed.where(hot).join(F.broadcast(stores.where(F.col("store_id").isin(list(heavy)))), "store_id", "left"),
             transformed.where(~hot).join(stores.hint("merge"), "store_id", "left")]
    joined = sides[0].unionByName(sides[1]).select(*transformed.columns, "store_key")
    if lay_out:
        joined = lay_out_by_day(joined)
    return joined.select("*", surrogate_key("sale_id").alias("sale_key"))


def known_store() -> Column:
    return F.col("store_key").isNotNull()


def fact_rows(keyed: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """The fact: sales with a known store. The filter turns the left join into an inner one."""
    return keyed.where(known_store()).select(
        "sale_key", "sale_id", "store_key", "sale_date", "channel",
        "gross_amount", "tax_amount", "net_amount", *_stamps(run_ts))


def conform_sales(transformed: DataFrame, dim_store: DataFrame,
                  run_ts: datetime | None = None) -> DataFrame:
    return fact_rows(with_keys(transformed, dim_store), run_ts)


def orphan_sales(transformed: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Sales the inner join drops: unknown or NULL store."""
    return transformed.join(dim_store.select("store_id"), "store_id", "left_anti") \
        .select(*transformed.columns)


def day_totals(transformed: DataFrame, *more: Column) -> DataFrame:
    """Row count, gross and net per day, straight from the transform."""
    return transformed.groupBy("sale_date").agg(
        F.count("*").alias("row_count"),
        F.sum("gross_amount").cast(TOTAL).alias("gross_total"),
        F.sum("net_amount").cast(TOTAL).alias("net_total"),
        *more)


@dataclass(frozen=True)
class Dimension:
    """A dimension ready to join, and what was measured about it; ``plain`` is it without a hint."""

    frame: DataFrame
    plain: DataFrame
    rows: int
    small: bool
    unique: bool


def measured(dim: DataFrame, key: str, limit: int = BROADCAST_LIMIT) -> Dimension:
    """Count the dimension and hint a broadcast only if rows times the widest key fit the limit.

    Beyond it the frame stays as it is, and ``with_keys_split`` makes the join a shuffled one that AQE keeps free of
    skew by splitting hot partitions. The limit is low because every action broadcasts, and each broadcast goes
    through the driver.
    """
    size = dim.agg(F.count("*").alias("n"), F.count_distinct(key).alias("keys"),
                   F.max(F.octet_length(F.col(key).cast("string"))).alias("width")).first()
    small = size.n * ((size.width or 0) + _ROW_OVERHEAD) <= limit
    return Dimension(F.broadcast(dim) if small else dim, dim, size.n, small, size.n == size.keys)


def _stamps(run_ts: datetime | None):
    if run_ts is None:
        return []
    return [F.lit(run_ts).alias("loaded_at"), F.lit(run_ts).alias("dbt_run_timestamp")]

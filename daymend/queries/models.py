"""Queries over single models: stage, transform, conform, mart, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymend.functions.keys import surrogate_key as key_of
from daymend.functions.measures import CORRECT, NET_PLUS_TAX
from daymend.operators.conform import conform_sales, conform_stores
from daymend.operators.conform import orphan_sales as orphans
from daymend.operators.marts import daily_sales
from daymend.operators.stage import stage_sales, stage_stores
from daymend.operators.transform import transform_sales
from daymend.operators.write import in_days, overwrite_table
from daymend.plans import reports
from daymend.queries.fixtures import days, mid_bug_drops, new_store, open_stores, raw_sales, shared, store_master


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_sales(raw_sales(spark, sf_dir))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_stores(stage_stores(store_master(spark, sf_dir)))


def shown(fact: DataFrame) -> DataFrame:
    """Business columns of the fact, with keys as text."""
    return fact.select(F.col("sale_key").cast("string").alias("sale_key"), "sale_id",
                       F.col("store_key").cast("string").alias("store_key"), "sale_date", "channel",
                       "gross_amount", "tax_amount", "net_amount")


def stg_sale(spark, sf_dir):
    return sales(spark, sf_dir)


def stg_store(spark, sf_dir):
    return stage_stores(store_master(spark, sf_dir))


def _rebuilt(spark, sf_dir, formula):
    store = new_store(spark, "trn")
    overwrite_table(store, "trn_tbl_sale", transform_sales(sales(spark, sf_dir), formula), ["sale_date"])
    return store.read("trn_tbl_sale")


def trn_tbl_sale(spark, sf_dir):
    return _rebuilt(spark, sf_dir, CORRECT)


def trn_tbl_sale_bugged(spark, sf_dir):
    return _rebuilt(spark, sf_dir, NET_PLUS_TAX)


def dim_store(spark, sf_dir):
    store = new_store(spark, "dim")
    overwrite_table(store, "dim_store", stores(spark, sf_dir))
    return store.read("dim_store").withColumn("store_key", F.col("store_key").cast("string"))


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def surrogate_key(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", key_of("o_orderkey").cast("string").alias("order_key"))


def surrogate_key_composite(spark, sf_dir):
    key = key_of("o_orderkey", "o_orderpriority")
    return _orders(spark, sf_dir).select("o_orderkey", "o_orderpriority", key.cast("string").alias("order_key"))


def fact_sale(spark, sf_dir):
    return shown(conform_sales(transform_sales(sales(spark, sf_dir)), stores(spark, sf_dir)))


def orphan_sales(spark, sf_dir):
    known = conform_stores(stage_stores(open_stores(store_master(spark, sf_dir))))
    return orphans(transform_sales(sales(spark, sf_dir)), known)


def range_filter(spark, sf_dir):
    """Three days of the transform, by name; only their directories are listed and read."""
    rows = shared(mid_bug_drops, spark, sf_dir).store.read("trn_tbl_sale").where(in_days(F.col("sale_date"), days(6, 8)))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("sale_id", "store_id")})


def dm_daily_sales(spark, sf_dir):
    fact = conform_sales(transform_sales(sales(spark, sf_dir)), stores(spark, sf_dir))
    return daily_sales(fact).orderBy("sale_date")


def model_sample(spark, sf_dir):
    return reports.model_sample(sales(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    stg_sale, stg_store, trn_tbl_sale, trn_tbl_sale_bugged, dim_store, surrogate_key,
    surrogate_key_composite, fact_sale, orphan_sales, range_filter, dm_daily_sales, model_sample)}

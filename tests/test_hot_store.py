"""A store with half of all sales against a dimension that is too large for a broadcast."""

from collections import Counter

from pyspark.sql import functions as F

from daymend.operators.conform import fact_rows, heavy_stores, with_keys, with_keys_split
from daymend.functions.keys import surrogate_key
from daymend.plans.flow import SalesFlow
from daymend import CsvLanding
from sample import golden_folder, master


def sides(spark, n=40_000):
    """Half of all sales in one store, a tenth in none, the rest in 10,000 stores; 5,000 of these and the hot one are known."""
    store_id = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 != 5, F.concat(F.lit("s"), (F.col("id") % 10_007).cast("string")))
    sales = spark.range(n).select(
        F.col("id").cast("string").alias("sale_id"), store_id.alias("store_id"), F.lit("2024-01-01").cast("date").alias("sale_date"),
        F.lit("online").alias("channel"), *[F.lit(1).cast(t).alias(c) for c, t in (
            ("gross_amount", "decimal(10,2)"), ("tax_amount", "decimal(10,2)"), ("net_amount", "decimal(11,2)"))])
    dim = spark.range(5000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("store_id")).union(
        spark.createDataFrame([("hot",)], "store_id string"))
    return sales, dim.select("store_id", surrogate_key("store_id").alias("store_key"))


def rows(frame):
    return Counter(tuple(r) for r in frame.select("sale_id", "store_id", "store_key", "sale_key").collect())


def test_no_partition_holds_the_hot_store(spark):
    sales, dim = sides(spark)
    assert heavy_stores(sales, 8) == ["hot"] and heavy_stores(sales.where("false"), 8) == []
    parts, adaptive = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split, plain = with_keys_split(sales, dim, heavy_stores(sales, 8)), with_keys(sales, dim)
        size = lambda frame: sorted(r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect())
        assert size(plain)[-1] > 4 * size(plain)[4]  # the hot store is one task
        tasks = size(split)
        assert tasks[-1] <= 4 * tasks[len(tasks) // 2]
        assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()
        assert rows(split) == rows(plain) and sum(rows(split).values()) == 40_000
        assert fact_rows(split).count() == fact_rows(plain).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_flow_with_a_large_dimension(spark, store, folder, monkeypatch):
    """The same fact as with a broadcast, behind the gate."""
    from daymend.plans import flow as flows
    plain = flows.measured
    monkeypatch.setattr(flows, "measured", lambda dim, key: plain(dim, key, limit=0))
    told = []
    split = flows.with_keys_split
    monkeypatch.setattr(flows, "with_keys_split", lambda t, d, heavy, **o: (told.append(heavy), split(t, d, heavy, **o))[1])
    flow = SalesFlow(store, CsvLanding(store, golden_folder(folder, 1)), master(spark))
    assert flow.load_next().passed == 28 and store.read("fact_sale").count() == 22
    assert told and all(x.startswith("ST-") for x in told[0])

"""What grows with sales or stores is shuffled: none of it goes through the driver for a broadcast."""

import pytest
from pyspark.sql import functions as F

from daymend import ChecksFailed, CsvLanding, SalesFlow
from daymend.operators import checks as dq
from daymend.operators import day_index
from daymend.operators.conform import measured, with_keys_split
from sample import golden_day, golden_folder, master, write_csv


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def ran(spark, monkeypatch):
    """Plans of the collected frames, as they were run."""
    kind, told = type(spark.range(1)), []
    collect = kind.collect

    def watched(frame):
        rows = collect(frame)
        told.append(plan(frame))
        return rows

    monkeypatch.setattr(kind, "collect", watched)
    return told


def test_indexes_are_met_by_shuffles(spark, ran):
    day = F.lit("2026-07-01").cast("date").alias("sale_date")
    words = spark.range(9).select(day, F.col("id").alias("word"), F.lit(6).cast("bigint").alias("bits"))
    assert [str(d) for d in day_index.days_sharing_keys(words, words.where("word > 7").drop("sale_date"))] == ["2026-07-01"]
    assert day_index.days_sharing_keys(words, words.withColumn("bits", F.lit(1).cast("bigint"))) == []
    stores = spark.range(9).select(day, F.col("id").alias("store_key"))
    assert len(day_index.days_with_stores(stores, stores.where("store_key = 3").select("store_key"))) == 1
    assert len(ran) == 3 and not any("Broadcast" in p for p in ran)


def test_parents_are_met_by_a_shuffle(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "store_key int")
    models = {"fact_sale": dq.Model(facts), "dim_store": dq.Model(spark.createDataFrame([(1,), (3,)], "store_key int"))}
    tally = dq.evaluate([dq.relationships("fact_sale", "store_key", "dim_store", "store_key")], models)
    assert [(r.failures, r.status) for r in tally.collect()] == [(2, "fail")]
    assert "Broadcast" not in plan(tally) and "SortMergeJoin" in plan(tally)


def test_dimensions_of_a_few_hundred_thousand_stores_are_shuffled(spark):
    dim = spark.range(300_000).select(F.col("id").alias("store_id"), F.col("id").alias("store_key"))
    large = measured(dim, "store_id")
    assert not large.small and large.unique and measured(dim.limit(100_000), "store_id").small
    sales = spark.range(10).select(F.col("id").cast("string").alias("sale_id"), (F.col("id") + 299_995).alias("store_id"))
    joined = with_keys_split(sales, large.frame, [])
    assert joined.where("store_key is null").count() == 5 and joined.count() == 10
    assert "Broadcast" not in plan(joined)
    hot = with_keys_split(sales, large.frame, [299_995])
    assert sorted(map(str, hot.collect())) == sorted(map(str, joined.collect()))
    assert plan(hot).count("SortMergeJoin") >= 1


def test_gate_sends_no_keys_to_the_driver(spark, store, folder, ran):
    """A doubled id and a store that closed: found as before, by shuffled joins."""
    read = {}

    class Watched(SalesFlow):
        def _others(self, *args):
            others = super()._others(*args)
            for columns, frame in others.items():
                read[columns] = len(frame.collect()), ran[-1]
            return others

    golden_folder(folder, 2)
    rows = golden_day(2)
    rows[3][0] = "SL-1-5"
    write_csv(folder, "2026-07-02", rows)
    flow = Watched(store, CsvLanding(store, folder), master(spark))
    flow.load_next()
    flow.stores = master(spark).where("store_id <> 'ST-05'")
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert {"no_duplicate_sale_ids", "unique_fact_sale_sale_key"} <= set(caught.value.report.failed_checks)
    assert "relationships_fact_sale_store_key_dim_store" in caught.value.report.failed_checks
    for column in ("sale_id", "sale_key"):
        n, seen = read[column,]
        assert n == 1 and "Broadcast" not in seen
    gates = [p for p in ran if "from_key" in p]
    assert len(gates) == 2 and not any("BroadcastHashJoin [from_key" in p for p in gates)

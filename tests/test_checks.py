from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daymend.operators import checks as dq
from daymend.operators.conform import conform_sales, conform_stores, measured, orphan_sales
from daymend.operators.transform import transform_sales
from sample import SALE, d, master


def sales(spark, rows):
    return spark.createDataFrame(
        [(i, s, d("2024-01-01"), Decimal(g), Decimal(t), c, "f") for i, s, g, t, c in rows], SALE)


def frames(spark, rows):
    staged = sales(spark, rows)
    dim = conform_stores(master(spark))
    trn = transform_sales(staged)
    fact = conform_sales(trn, dim)
    day = spark.createDataFrame([(d("2024-01-01"), "load_next")], "sale_date date, built_by_action string")
    return {"stg_store": dq.Model(master(spark)), "dim_store": dq.Model(dim), "stg_sale": dq.Model(staged),
            "trn_tbl_sale": dq.Model(trn), "fact_sale": dq.Model(fact),
            "dim_partition_status": dq.Model(day), "dm_daily_sales": dq.Model(day)}


def red(spark, rows):
    results = dq.evaluate(dq.sale_suite(), frames(spark, rows)).collect()
    assert len(results) == 28
    return {r["check"]: r.failures for r in results if r.status == "fail"}


GOOD = ("s1", "ST-01", "10", "1", "online")


def test_suite_has_28_checks():
    kinds = [c.kind for c in dq.sale_suite()]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 9, "not_null": 13, "accepted_values": 3, "relationships": 1, "rule": 1, "duplicates": 1}
    assert len({c.name for c in dq.sale_suite()}) == 28


def test_green(spark):
    assert red(spark, [GOOD, ("s2", "ST-02", "5", "0", "phone")]) == {}


def test_each_defect(spark):
    assert red(spark, [GOOD, GOOD]) == {
        "unique_stg_sale_sale_id": 1, "unique_trn_tbl_sale_sale_id": 1, "unique_fact_sale_sale_key": 1,
        "unique_fact_sale_sale_id": 1, "no_duplicate_sale_ids": 1}
    assert red(spark, [GOOD, ("s2", "ST-01", "1", "0.1", "fax"), ("s3", "ST-01", "1", "0.1", "fax")]) == {
        "accepted_values_stg_sale_channel": 1, "accepted_values_fact_sale_channel": 1}
    assert red(spark, [GOOD, ("s2", "ST-01", "1", "0.1", None)]) == {}
    assert red(spark, [GOOD, ("s2", None, "1", "0.1", "online")]) == {"not_null_stg_sale_store_id": 1}
    assert red(spark, [GOOD, ("s2", "ST-01", "1", "-0.1", "online")]) == {"net_never_exceeds_gross": 1}


def test_unique_ignores_null_and_duplicates_does_not(spark):
    got = red(spark, [GOOD, (None, "ST-01", "1", "0.1", "online"), (None, "ST-01", "1", "0.1", "online")])
    assert "unique_fact_sale_sale_id" not in got and got["no_duplicate_sale_ids"] == 1
    assert got["not_null_fact_sale_sale_id"] == 2


def test_relationships_lets_null_pass(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    models = {"c": dq.Model(child), "p": dq.Model(spark.createDataFrame([(2,)], "k int"))}
    check = dq.relationships("c", "k", "p", "k")
    assert [r.failures for r in dq.evaluate([check], models).collect()] == [2]
    assert dq.failures(check, models).count() == 2


def test_scope_and_other_rows(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, day int")
    others = spark.createDataFrame([("b",)], "id string")
    models = {"all": dq.Model(frame), "some": dq.Model(frame, F.col("day") == 1, {("id",): others})}
    suite = [dq.unique("all", "id"), dq.unique("some", "id")]
    got = {r.model: r.failures for r in dq.evaluate(suite, models).collect()}
    assert got == {"all": 1, "some": 1}
    assert [r.id for r in dq.failures(suite[1], models).collect()] == ["b"]
    with pytest.raises(TypeError, match="by columns"):
        dq.Model(frame, None, others)


def test_shared_frame_is_scanned_once_for_row_checks(spark, store):
    models = frames(spark, [GOOD])
    row_checks = [c for c in dq.sale_suite() if c.kind in ("not_null", "rule") and c.model == "fact_sale"]
    plan = dq.evaluate(row_checks, models)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_failures_are_kept(spark, store):
    models = frames(spark, [GOOD, ("s2", "ST-01", "1", "-0.1", "fax")])
    suite = [c for c in dq.sale_suite() if c.name in ("net_never_exceeds_gross", "accepted_values_stg_sale_channel")]
    dq.store_failures(store, suite, models)
    kept = sorted(tuple(r) for r in dq.stored_failures(store, dq.sale_suite()).collect())
    assert kept == [("accepted_values_stg_sale_channel", "fax"), ("net_never_exceeds_gross", "s2")]


def test_orphans_and_broadcast_limit(spark):
    trn = transform_sales(sales(spark, [GOOD, ("s2", "ST-99", "1", "0", "online"), ("s3", None, "1", "0", "online")]))
    dim = conform_stores(master(spark))
    assert sorted(r.sale_id for r in orphan_sales(trn, dim).collect()) == ["s2", "s3"]
    small = measured(dim, "store_id")
    assert small.small and small.unique and small.rows == 5
    assert conform_sales(trn, small.frame).count() == 1
    large = measured(dim.union(dim), "store_id", limit=10)
    assert not large.small and not large.unique
    assert "ResolvedHint" not in conform_sales(trn, large.frame)._jdf.queryExecution().analyzed().toString()

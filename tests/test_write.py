from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daymend.operators.write import (
    append_rows, clear_table, overwrite_table, replace_days, upsert_by_key,
)
from daymend.sources.tables import TableStore
from sample import FACT, d, files_of


def fact(spark, rows):
    return spark.createDataFrame([(i, d(day) if day else None, Decimal(g), Decimal(g)) for i, day, g in rows], FACT)


def content(store, name="f"):
    return sorted(((r.sale_id, str(r.sale_date), str(r.gross_amount)) for r in store.read(name).collect()), key=str)


@pytest.fixture
def table(spark, store):
    overwrite_table(store, "f", fact(spark, [
        ("a", "2024-01-01", "1"), ("b", "2024-01-02", "2"), ("c", "2024-01-02", "3"), ("e", "2024-01-03", "4")]),
        ["sale_date"])
    return store


def test_replace_leaves_other_days_untouched(spark, table):
    before = files_of(table.path("f"))
    replace_days(table, "f", fact(spark, [("b", "2024-01-02", "9")]), [d("2024-01-02")])
    after = files_of(table.path("f"))
    kept = {p: t for p, t in before.items() if "sale_date=2024-01-02" not in p}
    assert kept and kept.items() <= after.items()
    assert not {p for p in before if "sale_date=2024-01-02" in p} & set(after)
    assert content(table) == [("a", "2024-01-01", "1.00"), ("b", "2024-01-02", "9.00"), ("e", "2024-01-03", "4.00")]


def test_replace_removes_emptied_days(spark, table):
    replace_days(table, "f", fact(spark, [("b", "2024-01-02", "9")]), [d("2024-01-02"), d("2024-01-03")])
    assert [r[0] for r in content(table)] == ["a", "b"]
    assert table.days("f") == [d("2024-01-01"), d("2024-01-02")]
    assert not [p for p in files_of(table.path("f")) if "2024-01-03" in p]


def test_replace_ignores_rows_outside_the_days(spark, table):
    replace_days(table, "f", fact(spark, [("x", "2024-01-01", "9"), ("b", "2024-01-02", "9")]), [d("2024-01-02")])
    assert ("a", "2024-01-01", "1.00") in content(table) and len(content(table)) == 3


def test_replace_without_days_does_nothing(spark, table):
    before = files_of(table.path("f"))
    assert replace_days(table, "f", fact(spark, [("x", "2024-01-01", "9")]), []) == []
    assert files_of(table.path("f")) == before


def test_replace_from_the_table_itself(spark, table):
    doubled = table.read("f").withColumn("gross_amount", (F.col("gross_amount") * 2).cast("decimal(10,2)"))
    replace_days(table, "f", doubled, [d("2024-01-02")])
    assert [r[2] for r in content(table)] == ["1.00", "4.00", "6.00", "4.00"]


def test_rows_without_a_date(spark, table):
    replace_days(table, "f", fact(spark, [("n", None, "7")]), [None])
    assert None in table.days("f") and len(content(table)) == 5
    replace_days(table, "f", fact(spark, []), [None])
    assert len(content(table)) == 4


def test_upsert_moves_rows_across_days(spark, table):
    touched = upsert_by_key(table, "f", fact(spark, [
        ("c", "2024-01-05", "30"), ("e", "2024-01-03", "40"), ("z", "2024-01-05", "50")]), ["sale_id"])
    assert [t[0] for t in touched] == [d("2024-01-02"), d("2024-01-03"), d("2024-01-05")]
    assert content(table) == [("a", "2024-01-01", "1.00"), ("b", "2024-01-02", "2.00"), ("c", "2024-01-05", "30.00"),
                              ("e", "2024-01-03", "40.00"), ("z", "2024-01-05", "50.00")]


def test_upsert_keeps_rows_missing_from_the_batch(spark, table):
    upsert_by_key(table, "f", fact(spark, [("b", "2024-01-02", "9")]), ["sale_id"])
    assert ("c", "2024-01-02", "3.00") in content(table)


def test_upsert_drops_a_day_that_lost_its_last_row(spark, table):
    upsert_by_key(table, "f", fact(spark, [("a", "2024-01-02", "1")]), ["sale_id"])
    assert table.days("f") == [d("2024-01-02"), d("2024-01-03")]
    assert len(content(table)) == 4


def test_upsert_keeps_null_keys_and_inserts_duplicates(spark, table):
    replace_days(table, "f", fact(spark, [(None, "2024-01-04", "1")]), [d("2024-01-04")])
    batch = fact(spark, [(None, "2024-01-04", "2"), ("q", "2024-01-04", "3"), ("q", "2024-01-04", "4")])
    upsert_by_key(table, "f", batch, ["sale_id"])
    assert len([r for r in content(table) if r[1] == "2024-01-04"]) == 4


def test_upsert_reads_only_the_key_range(spark, table):
    batch = fact(spark, [("b", "2024-01-02", "9")])
    keys = table.read("f").where(F.col("sale_id").between("b", "b")).select("sale_id", "sale_date")
    plan = keys.join(batch.select("sale_id").distinct(), ["sale_id"], "left_semi") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sale_id,b), LessThanOrEqual(sale_id,b)" in plan
    assert "ReadSchema: struct<sale_id:string>" in plan


def test_replay_reads_only_its_days(spark, table):
    plan = table.read("f").where(F.col("sale_date").isin([d("2024-01-02")])) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(sale_date" in plan
    assert "sale_date=2024-01-02" in plan and "sale_date=2024-01-01" not in plan


def test_hot_day_is_written_by_many_tasks(spark, store):
    rows = spark.range(0, 200_000, 1, 16).select(
        F.uuid().alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.date_add(F.lit(d("2024-01-01")), (F.col("id") % 300).cast("int")))
         .otherwise(F.lit(d("2024-03-01"))).alias("sale_date"),
        F.lit(1).cast("decimal(10,2)").alias("gross_amount"), F.lit(1).cast("decimal(11,2)").alias("net_amount"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        overwrite_table(store, "hot", rows, ["sale_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = files_of(store.path("hot"))
    assert len([f for f in files if "sale_date=2024-03-01" in f]) > 4
    assert store.read("hot").count() == 200_000


def test_clear_and_append(spark, table):
    clear_table(table, "f")
    assert content(table) == [] and table.days("f") == []
    replace_days(table, "f", fact(spark, [("a", "2024-01-01", "1")]), [d("2024-01-01")])
    assert len(content(table)) == 1
    append_rows(table, "log", spark.range(2))
    append_rows(table, "log", spark.range(3))
    assert table.read("log").count() == 5


def test_another_session_opens_the_same_folder(spark, table):
    append_rows(table, "log", spark.range(2))
    again = TableStore(spark, table.root, database=table.database + "_again")
    assert again.exists("f") and again.exists("log") and not again.exists("nothing")
    assert content(again) == content(table) and again.days("f") == table.days("f")
    replace_days(again, "f", fact(spark, [("a", "2024-01-01", "8")]), [d("2024-01-01")])
    assert ("a", "2024-01-01", "8.00") in content(again)
    assert again.names() == ["f", "log"]


def test_upsert_cut_short_is_finished_by_the_next(spark, store, monkeypatch):
    from daymend.operators import write
    overwrite_table(store, "f", fact(spark, [("a", "2024-01-01", "1"), ("b", "2024-01-01", "2"), ("c", "2024-01-02", "3")]),
                    ["sale_date"])
    move = write.files.replace
    calls = []

    def dies(spark, moves):
        """The first folder is moved, then the driver is lost."""
        moves = sorted(moves)
        calls.append(len(moves))
        move(spark, moves[:1])
        raise RuntimeError("lost in the swap")

    batch = fact(spark, [("a", "2024-01-02", "9")])
    monkeypatch.setattr(write.files, "replace", dies)
    with pytest.raises(RuntimeError):
        upsert_by_key(store, "f", batch, ["sale_id"])
    assert calls == [2]
    monkeypatch.setattr(write.files, "replace", move)
    upsert_by_key(store, "f", batch, ["sale_id"])
    assert [r[:2] for r in content(store)] == [("a", "2024-01-02"), ("b", "2024-01-01"), ("c", "2024-01-02")]
    assert [r[2] for r in content(store)] == ["9.00", "2.00", "3.00"]
    # the same where the swap has to take away a day
    monkeypatch.setattr(write.files, "replace", dies)
    with pytest.raises(RuntimeError):
        upsert_by_key(store, "f", fact(spark, [("b", "2024-01-03", "5"), ("d", "2024-01-04", "6")]), ["sale_id"])
    monkeypatch.setattr(write.files, "replace", move)
    upsert_by_key(store, "f", fact(spark, [("e", "2024-01-04", "7")]), ["sale_id"])
    assert [r[:2] for r in content(store)] == [("a", "2024-01-02"), ("b", "2024-01-03"), ("c", "2024-01-02"), ("d", "2024-01-04"),
                                               ("e", "2024-01-04")]
    assert store.days("f") == [d("2024-01-02"), d("2024-01-03"), d("2024-01-04")]


def jobs_and_statements(spark, monkeypatch, work):
    """Spark jobs and catalog statements of some work."""
    group, statements, sql = f"jobs-{id(work)}", [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (statements.append(text), sql(self, text, *a, **b))[1])
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        monkeypatch.undo()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), statements


def test_a_thousand_days_are_emptied_at_once(spark, store, monkeypatch):
    from daymend.operators.write import empty_partitions
    rows = spark.range(1000).select(
        F.col("id").cast("string").alias("sale_id"), F.date_add(F.lit(d("2020-01-01")), F.col("id").cast("int")).alias("sale_date"),
        F.lit(1).cast("decimal(10,2)").alias("gross_amount"), F.lit(1).cast("decimal(11,2)").alias("net_amount"))
    overwrite_table(store, "many", rows.withColumn("sale_date", F.when(F.col("sale_id") != "7", F.col("sale_date"))), ["sale_date"])
    kept = (d("2020-01-04"),)
    gone = [s for s in store.partitions("many") if s != kept]
    jobs, statements = jobs_and_statements(spark, monkeypatch, lambda: empty_partitions(store, "many", gone))
    assert jobs == 0 and len([s for s in statements if s.startswith("ALTER")]) == 1
    assert store.partitions("many") == [kept] and store.read("many").count() == 1
    assert all("2020-01-04" in p for p in files_of(store.path("many")))


def test_failed_rebuild_leaves_the_old_table(spark, store):
    """A rebuild that dies after some of its files were written; readers that had begun keep their version."""
    overwrite_table(store, "dim", spark.range(5).selectExpr("id AS store_id"))
    reader = store.read("dim")
    broken = spark.range(0, 100, 1, 4).selectExpr("if(id = 90, raise_error('lost'), id) AS store_id")
    with pytest.raises(Exception, match="lost"):
        overwrite_table(store, "dim", broken)
    assert store.read("dim").count() == 5
    again = TableStore(spark, store.root, database=store.database + "_later")
    assert again.read("dim").count() == 5  # also for a session that finds the folder with half a version in it
    overwrite_table(store, "dim", spark.range(7).selectExpr("id AS store_id"))
    assert (reader.count(), store.read("dim").count(), again.versions("dim")[-1]) == (5, 7, store.versions("dim")[-1])
    assert TableStore(spark, store.root, database=store.database + "_last").read("dim").count() == 7


def test_rebuild_that_was_not_shown_is_shown_by_the_next_store(spark, store, monkeypatch):
    overwrite_table(store, "dim", spark.range(5))
    monkeypatch.setattr(TableStore, "point_to", lambda *_: None)
    overwrite_table(store, "dim", spark.range(6))
    monkeypatch.undo()
    assert store.read("dim").count() == 5
    assert TableStore(spark, store.root, database=store.database).read("dim").count() == 6


def test_log_is_folded(spark, store, monkeypatch):
    from daymend.operators import write
    monkeypatch.setattr(write, "FOLD_AT", 6)
    for n in range(40):
        append_rows(store, "log", spark.range(n, n + 1, 1, 1))
        assert len(store.read("log").inputFiles()) <= 7
    assert sorted(r.id for r in store.read("log").collect()) == list(range(40))
    assert len(store.versions("log", complete=False)) <= 2

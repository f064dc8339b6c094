"""Checks across days read only the days whose index says that they matter."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daymend import ChecksFailed, CsvLanding, SalesFlow
from daymend.functions.keys import surrogate_key
from daymend.operators import day_index
from daymend.plans import ledger
from sample import d, golden_day, golden_folder, master, write_csv

FACT = "fact_sale"


class Watched(SalesFlow):
    """Keeps what the gate read of other days."""

    def _others(self, *args):
        self.read = super()._others(*args)
        return self.read

    def days_read(self):
        return {f.split("sale_date=")[1][:10] for frame in self.read.values() for f in frame.inputFiles() if "/fact_sale/" in f}


def flow_over(spark, store, folder, **options):
    return Watched(store, CsvLanding(store, folder), master(spark), **options)


def names(first, last):
    return [f"2026-07-0{n}" for n in range(first, last + 1)]


def test_planted_id_is_found_in_its_day_only(spark, store, folder):
    """A load reads no other day, unless it brings a key of that day."""
    golden_folder(folder, 5)
    rows = golden_day(5)
    rows[3][0] = "SL-2-5"
    write_csv(folder, "2026-07-05", rows)
    flow = flow_over(spark, store, folder)
    flow.load_files(names(1, 3))
    flow.load_next()
    assert flow.read == {} and len(store.partitions(day_index.KEYS)) == len(store.partitions(day_index.STORES)) == 4
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert caught.value.report.failed_checks == ["no_duplicate_sale_ids", "unique_fact_sale_sale_id", "unique_fact_sale_sale_key"]
    assert flow.days_read() == {"2026-07-02"}
    assert {s[0].isoformat(): s[1] for s in store.partitions(day_index.KEYS)} == {  # that of the refused build is gone
        **dict.fromkeys(names(1, 3), "1"), "2026-07-04": "2"}


def test_unknown_days_are_read_until_they_are_indexed(spark, store, folder):
    golden_folder(folder, 5)
    flow = flow_over(spark, store, folder, gate=False)
    flow.load_files([f"2026-07-0{n}" for n in range(1, 4)])
    flow.gate = True
    flow.load_next()
    assert flow.days_read() == {"2026-07-01", "2026-07-02", "2026-07-03"}
    assert flow.index_days() == [d("2026-07-01"), d("2026-07-02"), d("2026-07-03")] and flow.index_days() == []
    flow.load_next()
    assert flow.read == {}
    assert len(store.partitions(day_index.KEYS)) == 5


def test_day_of_a_lost_build_is_unknown(spark, store, folder):
    """An index whose build the ledger does not name does not count for its day."""
    flow = flow_over(spark, store, golden_folder(folder, 3))
    flow.load_files(names(1, 2))
    rows = store.read(FACT).where("sale_date = '2026-07-01'").limit(1)
    day_index.keep(store, day_index.KEYS, day_index.key_words(rows), 9)
    day_index.settle(store, day_index.KEYS, [d("2026-07-01")], 9)
    flow.load_next()
    assert flow.days_read() == {"2026-07-01"}


def test_lost_store_reads_the_days_that_sold_there(spark, store, folder):
    for n in range(1, 6):
        rows = golden_day(n)
        write_csv(folder, f"2026-07-0{n}", [r for r in rows if (r[1] == "ST-02") <= (n in (2, 4))])
    flow = flow_over(spark, store, folder)
    flow.load_files(names(1, 5))
    flow.stores = flow.stores.where("store_id <> 'ST-02'")
    with pytest.raises(ChecksFailed, match="relationships"):
        flow.replay([d("2026-07-05")])
    assert flow.days_read() == {"2026-07-02", "2026-07-04"}
    lost = [r.n for r in flow.read["store_key",].agg(F.count("*").alias("n")).collect()]
    assert lost == [sum(r[1] == "ST-02" for n in (2, 4) for r in golden_day(n))]


def test_by_key_days_are_unknown(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 1), by_key=True)
    flow.load_next()
    assert not store.exists(day_index.KEYS) and store.read(FACT).count() == 22


def test_bitmaps_meet_where_keys_do(spark):
    """Words of random keys, of the smallest and the largest ones, against sets of the first 58 bits."""
    rows = spark.range(4000).select((F.col("id") % 20).cast("int").alias("k"), surrogate_key("id").alias("sale_key"))
    ends = spark.createDataFrame([(20, Decimal(0)), (20, Decimal(2**64 - 1)), (21, Decimal(63)), (22, Decimal(64)), (23, Decimal(2**63))],
                                 "k int, sale_key decimal(20,0)")
    days = rows.union(ends).select(F.date_add(F.lit(d("2024-01-01")), "k").alias("sale_date"), "sale_key")
    words = day_index.key_words(days).withColumn("built", F.lit("1"))
    assert words.agg(F.sum(F.bit_count("bits"))).first()[0] == len({(r.sale_date, int(r.sale_key) >> 6) for r in days.collect()})
    batch = days.where("sale_date = '2024-01-06'").limit(1).union(
        spark.createDataFrame([(d("2030-01-01"), Decimal(1)), (d("2030-01-01"), Decimal(2**64 - 2))], days.schema))
    got = day_index.days_sharing_keys(words, day_index.key_words(batch))
    assert sorted(got) == [d("2024-01-06"), d("2024-01-21"), d("2024-01-22")]  # 0, 1 and 63 share their first 58 bits


def test_row_and_value_checks_ride_on_the_write(spark, store, folder, monkeypatch):
    """What is left for the suite to read from the staged batch are keys."""
    from daymend.operators import checks as dq
    asked = []
    evaluate = dq.evaluate
    monkeypatch.setattr(dq, "evaluate", lambda checks, models: (asked.append(list(checks)), evaluate(checks, models))[1])
    flow = flow_over(spark, store, golden_folder(folder, 2))
    assert flow.load_next().passed == 28
    staged = [c for c in asked[0] if c.model in ("stg_sale", "trn_tbl_sale", "fact_sale")]
    assert {c.kind for c in staged} == {"unique", "duplicates", "relationships"}
    rows = golden_day(2)
    rows[0][5], rows[1][5], rows[2][5], rows[4][1] = "fax", "fax", "mail", ""
    write_csv(folder, "2026-07-02", rows)
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert caught.value.report.failed_checks == [
        "accepted_values_fact_sale_channel", "accepted_values_stg_sale_channel", "not_null_stg_sale_store_id"]
    failures = {r["check"]: r.failures for r in store.read("check_results").where("seq = 2").collect()}
    assert failures["accepted_values_stg_sale_channel"] == 2 and failures["not_null_stg_sale_store_id"] == 1 and len(failures) == 28


def test_kept_mart_is_the_mart(spark, store, folder):
    """After loads, a wrong formula, a replay and an upsert; the fact is not read."""
    def marts():
        return [sorted((r.sale_date, r.orders, r.gross_total, r.tax_total, r.net_total) for r in store.read(name).collect())
                for name in ("dm_daily_sales", "dm_daily_sales_kept")]

    flow = flow_over(spark, store, golden_folder(folder, 4), gate=False)
    for work in (lambda: flow.load_files(names(1, 3)), lambda: flow.switch_formula("net_plus_tax"), flow.fix_and_backfill):
        work()
        first, kept = marts()
        assert first == kept and first
    moved = [*golden_day(4), ["SL-1-0", "ST-01", "2026-07-04", "5.00", "0.50", "online"]]
    write_csv(folder, "2026-07-04", moved)
    by_key = SalesFlow(store, flow.landing, flow.stores, gate=False, by_key=True)
    by_key.load_next()
    first, kept = marts()
    assert first == kept and sum(r[1] for r in first) == 22 + 28 + 19 + 31
    assert all("fact_sale" not in f for f in store.read("dm_daily_sales_kept").inputFiles())
    assert ledger.current_days(store).count() == 4

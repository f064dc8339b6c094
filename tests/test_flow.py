import os
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymend import ChecksFailed, CsvLanding, FrameLanding, SalesFlow, TableStore
from daymend.functions.measures import CORRECT, NET_PLUS_TAX
from daymend.operators import day_index
from daymend.operators.write import overwrite_table
from daymend.plans import audit, ledger, reports
from daymend.session import fresh_root
from daymend.streaming.arrivals import run_drops
from sample import DAYS, SALE, d, files_of, golden_day, golden_folder, master, write_csv


def flow_over(spark, store, folder, **options):
    return SalesFlow(store, CsvLanding(store, folder), master(spark), **options)


def state(flow):
    store = flow.store
    fact = store.read("fact_sale").agg(F.count("*").alias("n"), F.sum("net_amount").alias("net")).first()
    bugged = reports.bugged_partitions(store).count()
    wrong = sorted(str(r.sale_date) for r in ledger.contaminated_days(store).collect())
    shown = {str(r.sale_date): str(r.bugged_total) for r in ledger.snapshots(store).collect()}
    return ledger.loaded_files(store).count(), wrong, shown, fact.n, str(fact.net or Decimal("0.00")), bugged


def test_golden_sequence(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder), publish_on_red=True)
    for _ in range(3):
        report = flow.load_next()
        assert (report.passed, report.failed, report.touched) == (28, 0, 1)
    assert state(flow) == (3, [], {}, 69, "14874.11", 0)

    report = flow.switch_formula(NET_PLUS_TAX)
    assert report.failed_checks == ["net_never_exceeds_gross"] and report.touched == 3
    days = ["2026-07-01", "2026-07-02", "2026-07-03"]
    shown = dict(zip(days, ["5511.20", "6728.47", "5010.76"]))
    assert state(flow) == (3, days, shown, 69, "17250.43", 3)

    flow.load_next()
    shown["2026-07-04"] = "6420.34"
    assert state(flow) == (4, [*days, "2026-07-04"], shown, 100, "23670.77", 4)
    series = reports.daily_reconciliation(flow).orderBy("sale_date").collect()
    assert [str(r.correct) for r in series] == ["4727.88", "5793.09", "4353.14", "5535.40"]
    assert not any(r.converged for r in series)

    report = flow.fix_and_backfill()
    assert report.failed == 0 and report.touched == 4
    assert state(flow) == (4, [], shown, 100, "20409.51", 0)
    files = files_of(store.path("fact_sale"))
    assert flow.fix_and_backfill().touched == 0
    assert files_of(store.path("fact_sale")) == files

    flow.load_next()
    assert state(flow) == (5, [], shown, 124, "25106.32", 0)
    assert all(r.converged for r in reports.daily_reconciliation(flow).collect())
    assert reports.affected_days(reports.daily_reconciliation(flow)).count() == 4
    counts = [r.row_count for r in audit.latest(store).where("model_name = 'fact_sale'")
              .orderBy("loaded_at").collect()]
    assert counts == [22, 50, 69, 69, 100, 100, 124]
    marts = audit.latest(store).where("model_name = 'dm_daily_sales'").count()
    assert marts == 5
    assert [r.action for r in reports.run_history(store).collect()] == [
        "load_next", "fix_and_backfill", "fix_and_backfill", "load_next", "inject_bug",
        "load_next", "load_next", "load_next"]

    report = flow.reset()
    assert state(flow) == (0, [], {}, 0, "0.00", 0)
    assert reports.run_history(store).count() == 1 and flow.pending().count() == 14
    assert store.read("dim_store").count() == 5
    assert flow.load_next().days == [d("2026-07-01")]


def test_all_days_by_name(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder), gate=False)
    flow.load_files([date(2026, 7, n).isoformat() for n in range(1, 15)])
    mart = store.read("dm_daily_sales").orderBy("sale_date").collect()
    assert [(r.orders, str(r.gross_total), str(r.tax_total)) for r in mart] == DAYS
    report = flow.load_next()
    assert report.message == "no file is waiting" and report.touched == 0


def test_red_batch_is_not_published(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2))
    flow.load_next()
    files = files_of(store.path("fact_sale"))
    with pytest.raises(ChecksFailed) as caught:
        flow.switch_formula(NET_PLUS_TAX)
    assert caught.value.report.failed_checks == ["net_never_exceeds_gross"]
    assert files_of(store.path("fact_sale")) == files
    assert ledger.position(store)[1] == CORRECT
    assert [r["check"] for r in reports.failed_checks(store).collect()] == ["net_never_exceeds_gross"]
    assert store.read("dbt_audit__net_never_exceeds_gross").count() == 22
    assert flow.load_next().failed == 0
    assert store.read("fact_sale").count() == 50


def test_red_file_stays_pending(spark, store, folder):
    rows = golden_day(1)
    write_csv(folder, "2026-07-01", rows + rows[:1])
    flow = flow_over(spark, store, folder)
    with pytest.raises(ChecksFailed, match="no_duplicate_sale_ids"):
        flow.load_next()
    assert flow.pending().count() == 1
    write_csv(folder, "2026-07-01", rows)
    assert flow.load_next().published and store.read("fact_sale").count() == 22


def test_id_of_another_day_is_found(spark, store, folder):
    golden_folder(folder, 2)
    rows = golden_day(2)
    rows[0][0] = "SL-1-0"
    write_csv(folder, "2026-07-02", rows)
    flow = flow_over(spark, store, folder)
    flow.load_next()
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert caught.value.report.failed_checks == [
        "no_duplicate_sale_ids", "unique_fact_sale_sale_id", "unique_fact_sale_sale_key"]
    lenient = flow_over(spark, store, folder, unique_across_days=False)
    assert lenient.load_next().published


def test_rows_without_date_turn_the_build_red(spark, store, folder):
    write_csv(folder, "2026-07-01", [*golden_day(1), ["u1", "ST-01", "", "1.00", "0.10", "online"]])
    flow = flow_over(spark, store, folder)
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert "not_null_stg_sale_sale_date" in caught.value.report.failed_checks


def test_ranges(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 5), gate=False)
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    for _ in range(5):
        flow.load_next()
    with pytest.raises(ValueError):
        flow.fix_and_backfill(d("2026-07-03"), d("2026-07-02"))
    files = files_of(store.path("fact_sale"))
    assert flow.fix_and_backfill(d("2026-07-02"), d("2026-07-03")).touched == 2
    kept = {p for p in files if "2026-07-02" not in p and "2026-07-03" not in p}
    assert kept <= set(files_of(store.path("fact_sale")))
    left = [str(r.sale_date) for r in ledger.contaminated_days(store).orderBy("sale_date").collect()]
    assert left == ["2026-07-01", "2026-07-04", "2026-07-05"]
    span = ledger.backfill_range(store)
    assert ledger.touched_partitions(span).first().touched == 5
    assert flow.fix_and_backfill(contiguous=True).touched == 5
    assert flow.replay([]) is None


def test_redelivered_day_loses_a_row(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 3))
    flow.load_files(["2026-07-01", "2026-07-02", "2026-07-03"])
    write_csv(folder, "2026-07-02", golden_day(2)[:-1])
    flow.load_files(["2026-07-02"])
    assert store.read("fact_sale").count() == 68
    write_csv(folder, "2026-07-02", [])
    flow.load_files(["2026-07-02"])
    assert store.days("fact_sale") == [d("2026-07-01"), d("2026-07-03")]
    assert ledger.partition_status(store).count() == 2


def test_status_of_other_days_keeps_its_time(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 3), gate=False)
    flow.load_files(["2026-07-01", "2026-07-02", "2026-07-03"])
    before = {r.sale_date: r.last_built_at for r in store.read("dim_partition_status").collect()}
    flow.fix_and_backfill(d("2026-07-02"), d("2026-07-02"))
    after = {r.sale_date: r for r in store.read("dim_partition_status").collect()}
    same = {day for day in before if after[day].last_built_at == before[day]}
    assert same == {d("2026-07-01"), d("2026-07-03")}
    assert after[d("2026-07-02")].built_by_action == "fix_and_backfill"


def test_zero_tax_and_negative_tax(spark, store):
    rows = [("z", "ST-01", d("2024-01-01"), Decimal("5"), Decimal("0"), "online", "2024-01-01"),
            ("n", "ST-01", d("2024-01-02"), Decimal("5"), Decimal("-1"), "online", "2024-01-02")]
    frame = spark.createDataFrame(rows, SALE)
    flow = SalesFlow(store, FrameLanding(lambda lo, hi: frame), master(spark), gate=False)
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    flow.load_files(["2024-01-01", "2024-01-02"])
    assert reports.bugged_partitions(store).count() == 0
    series = {str(r.sale_date): r for r in reports.daily_reconciliation(flow).collect()}
    assert series["2024-01-01"].converged and series["2024-01-01"].wrong_rows == 0
    assert not series["2024-01-02"].converged and series["2024-01-02"].wrong_rows == 1
    flow.fix_and_backfill()
    assert [str(r.sale_date) for r in reports.bugged_partitions(store).collect()] == ["2024-01-02"]


def test_stream_takes_late_files(spark, store, folder):
    golden_folder(folder, 3)
    flow = flow_over(spark, store, folder)
    checkpoint = fresh_root(spark, "testcheckpoint")
    run_drops(flow, folder, checkpoint, max_files_per_trigger=2)
    assert state(flow)[3:5] == (69, "14874.11")
    write_csv(folder, "late-02", [["late", "ST-01", "2026-07-02", "10.00", "1.00", "online"]])
    run_drops(flow, folder, checkpoint)
    assert state(flow)[3:5] == (70, "14883.11")
    run_drops(flow, folder, checkpoint)
    assert state(flow)[3:5] == (70, "14883.11")


def test_reports_as_json(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2))
    flow.load_next()
    out = fresh_root(spark, "testjson")
    reports.export_json(flow, out)
    row = spark.read.json(f"{out}/summary").first()
    assert (row.files_loaded, row.files_pending, row.next_file, row.net_total) == (1, 1, "2026-07-02", 4727.88)
    assert spark.read.json(f"{out}/next_file").count() == 28
    assert spark.read.json(f"{out}/sample_trn_tbl_sale").count() == spark.read.json(f"{out}/sample_fact_sale").count() == 22
    assert not os.path.exists(f"{out}/table_fact_sale")
    reports.export_json(flow, out, whole_tables=True)
    assert spark.read.json(f"{out}/table_fact_sale").count() == 22


def test_flow_goes_on_in_another_session(spark, store, folder):
    flow_over(spark, store, golden_folder(folder, 2)).load_next()
    again = TableStore(spark, store.root, database=store.database + "_again")
    flow = flow_over(spark, again, folder)
    assert flow.load_next().seq == 2
    assert again.read("fact_sale").count() == 50 and again.read("dim_partition_status").count() == 2


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.lists(st.integers(1, 5), max_size=3), wrong_from=st.integers(1, 6),
       replays=st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), max_size=2))
def test_any_history_ends_in_the_one_shot_build(spark, cuts, wrong_from, replays):
    folder = golden_folder(fresh_root(spark, "testprop"), 6)
    flow = flow_over(spark, TableStore(spark, fresh_root(spark, "testprop")), folder, gate=False)
    bounds = sorted({0, 6, *cuts})
    for lo, hi in zip(bounds, bounds[1:]):
        if lo + 1 >= wrong_from:
            flow.switch_formula(NET_PLUS_TAX, rebuild=False)
        flow.load_files([date(2026, 7, n).isoformat() for n in range(lo + 1, hi + 1)])
    for a, b in replays:
        flow.fix_and_backfill(date(2026, 7, min(a, b)), date(2026, 7, max(a, b)))
    flow.fix_and_backfill()
    mart = flow.store.read("dm_daily_sales").orderBy("sale_date").collect()
    assert [(r.orders, str(r.gross_total), str(r.tax_total)) for r in mart] == DAYS[:6]
    assert all(r.net_total == r.gross_total - r.tax_total for r in mart)


def test_replay_pushes_its_days_into_the_scan(spark):
    from daymend.queries.fixtures import days, events_between
    landing = FrameLanding(events_between(spark, "/root/testdata/sf0.001"))
    plan = landing.rows([*days(6, 8), None])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-06T00:00), LessThan(ts,2024-01-09T00:00)" in plan


def test_layout_shuffle_is_narrow_and_single(spark, store):
    """Ahead of a broadcast join the rows are shuffled once, without keys and stamps."""
    from daymend.operators.conform import conform_stores, fact_rows, measured, with_keys
    from daymend.operators.transform import transform_sales
    from daymend.operators.write import lay_out_by_day
    from daymend.queries.fixtures import events_between
    from daymend.operators.stage import stage_sales
    rows = stage_sales(events_between(spark, "/root/testdata/sf0.001")(None, None)).drop("source_file")
    dim = measured(conform_stores(master(spark).withColumn("store_id", F.lit(1).cast("bigint"))), "store_id")
    fact = fact_rows(with_keys(transform_sales(lay_out_by_day(rows)), dim.frame))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plan
    below = plan[plan.index("REBALANCE_PARTITIONS_BY_COL"):]
    assert "md5" not in below.split("BroadcastExchange")[0]


def test_by_key_keeps_lost_sales_and_follows_moved_ones(spark, store, folder):
    golden_folder(folder, 2)
    flow = flow_over(spark, store, folder, by_key=True)
    flow.load_next()
    rows = golden_day(2)
    moved = golden_day(1)[0]
    rows.append([moved[0], moved[1], "2026-07-02", *moved[3:]])
    write_csv(folder, "2026-07-02", rows)
    report = flow.load_next()
    assert report.failed == 0 and store.read("fact_sale").count() == 50
    counts = {str(r.sale_date): (r.row_count, r.fact_rows) for r in ledger.current_days(store).collect()}
    assert counts == {"2026-07-01": (22, 21), "2026-07-02": (29, 29)}
    write_csv(folder, "2026-07-02", rows[:5])
    flow.load_files(["2026-07-02"])
    assert store.read("fact_sale").count() == 50
    assert ledger.partition_status(store).where("sale_date = '2026-07-02'").first().row_count == 5


def test_odd_file_names(spark, store, folder):
    write_csv(folder, "a b%1#x", golden_day(1))
    flow = flow_over(spark, store, folder)
    flow.load_next()
    write_csv(folder, "a b%1#x", golden_day(1)[:-1])
    flow.load_files(["a b%1#x"])
    assert store.read("fact_sale").count() == 21
    assert store.partitions("incoming_sale") == [(d("2026-07-01"), "a b%1#x")]


def test_nothing_loaded_yet(spark, store, folder):
    write_csv(folder, "2026-07-01", [])
    flow = flow_over(spark, store, folder)
    assert flow.switch_formula(NET_PLUS_TAX).touched == 0
    assert ledger.position(store) == (1, NET_PLUS_TAX)
    assert flow.fix_and_backfill().outcome == "rebuilt 0 days"
    assert flow.load_next().touched == 0 and flow.pending().count() == 0
    assert flow.reset().published and flow.pending().count() == 1


def test_replay_with_another_formula_changes_only_its_days(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2), gate=False)
    flow.load_files(["2026-07-01", "2026-07-02"])
    flow.replay([d("2026-07-02")], NET_PLUS_TAX)
    assert ledger.position(store)[1] == CORRECT
    assert [str(r.sale_date) for r in ledger.contaminated_days(store).collect()] == ["2026-07-02"]


def test_audit_of_any_relation(spark, store):
    first, second = (datetime(2026, 7, n, tzinfo=timezone.utc) for n in (1, 2))
    overwrite_table(store, "numbers", spark.range(7))
    audit.record(store, ["numbers", "nothing"], "run-a", first)
    overwrite_table(store, "numbers", spark.range(9))
    audit.record(store, ["numbers"], "run-b", second)
    assert [(r.model_name, r.row_count, r.invocation_id) for r in audit.latest(store).collect()] == [
        ("numbers", 9, "run-b"), ("numbers", 7, "run-a")]
    audit.record(store, ["nothing"], "run-c", second)
    assert audit.latest(store).count() == 2


def test_refused_file_is_not_published_later(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 3))
    flow.load_next()
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    with pytest.raises(ChecksFailed):
        flow.load_next()
    flow.fix_and_backfill(d("2026-07-01"), d("2026-07-03"))
    assert store.days("fact_sale") == [d("2026-07-01")]
    assert [str(r.sale_date) for r in reports.daily_reconciliation(flow).collect()] == ["2026-07-01"]
    assert flow.load_next().published and store.read("fact_sale").count() == 50


def test_refused_file_does_not_block_and_leaves_the_landed_one(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2))
    flow.load_next()
    flow.load_next()
    rows = golden_day(2)
    write_csv(folder, "2026-07-02", rows + rows[:1])
    with pytest.raises(ChecksFailed):
        flow.load_files(["2026-07-02"])
    assert flow.fix_and_backfill(d("2026-07-01"), d("2026-07-02")).published
    assert store.read("fact_sale").count() == 50 and flow.landed_rows().count() == 50


def test_by_key_behind_the_gate_for_a_frame(spark, store):
    rows = [(f"s{n}-{k}", f"ST-0{k + 1}", d(f"2024-01-0{n}"), Decimal("5"), Decimal("1"), "online", f"2024-01-0{n}")
            for n in (1, 2, 3) for k in range(5)]
    frame = spark.createDataFrame(rows, SALE)
    flow = SalesFlow(store, FrameLanding(lambda lo, hi: frame), master(spark), by_key=True)
    for n in (1, 2, 3):
        assert flow.load_next().failed == 0
    assert store.read("fact_sale").count() == 15


def test_dateless_rows_of_a_frame_turn_the_build_red(spark, store):
    rows = [(i, "ST-01", when, Decimal("5"), Decimal("1"), "online", str(when) if when else None)
            for i, when in (("a", d("2024-01-01")), ("b", d("2024-01-01")), ("c", None))]
    frame = spark.createDataFrame(rows, SALE)
    flow = SalesFlow(store, FrameLanding(lambda lo, hi: frame), master(spark))
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert caught.value.report.failed_checks == ["not_null_stg_sale_sale_date"]


def test_refused_master_list_leaves_the_dimension(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2))
    flow.load_next()
    before = sorted(map(tuple, store.read("dim_store").select("store_id", "store_name").collect()))
    flow.stores = master(spark).union(master(spark).limit(1))
    with pytest.raises(ChecksFailed):
        flow.load_next()
    assert sorted(map(tuple, store.read("dim_store").select("store_id", "store_name").collect())) == before


def test_store_that_left_the_master_orphans_other_days(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2))
    flow.load_next()
    flow.stores = master(spark).where("store_id <> 'ST-02'")
    with pytest.raises(ChecksFailed) as caught:
        flow.load_next()
    assert "relationships_fact_sale_store_key_dim_store" in caught.value.report.failed_checks


def test_audit_and_run_log(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2), publish_on_red=True)
    flow.load_next()
    flow.switch_formula(NET_PLUS_TAX)
    last = ledger.run_ledger(store).orderBy(F.desc("seq")).first()
    assert last.failed_checks == ["net_never_exceeds_gross"] and last.converged is False
    flow.fix_and_backfill()
    assert ledger.run_ledger(store).orderBy(F.desc("seq")).first().converged is True
    flow.reset()
    assert store.read("dbt_audit__net_never_exceeds_gross").count() == 0


def test_empty_resolved_range_is_an_error(spark, store, folder):
    flow = flow_over(spark, store, golden_folder(folder, 2), gate=False)
    flow.switch_formula(NET_PLUS_TAX, rebuild=False)
    flow.load_next()
    with pytest.raises(ValueError):
        flow.fix_and_backfill(start=d("2026-07-02"))


def test_one_build_reads_the_drop_once_and_checks_what_it_publishes(spark, store, folder, monkeypatch):
    """The checks and the fact come from the staged files: what lands meanwhile changes neither."""
    flow = flow_over(spark, store, golden_folder(folder, 1))
    reads = []
    plain = flow.landing.preview
    monkeypatch.setattr(flow.landing, "preview", lambda names: reads.append(names) or plain(names))
    flow.load_next()
    assert reads == [["2026-07-01"]]

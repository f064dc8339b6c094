"""Drops that arrive in parts are built once."""

import time

import pytest

from daymend import CsvLanding, SalesFlow
from daymend.plans import ledger
from daymend.sources.files import write_text
from daymend.streaming.arrivals import run_drops, stream_drops
from sample import d, golden_day, master, write_csv


@pytest.fixture
def flow(spark, store, folder):
    return SalesFlow(store, CsvLanding(store, folder), master(spark), gate=False)


def parts_of(folder, n, first, last):
    """Part files first..last of ten of the n-th day."""
    for k in range(first, last + 1):
        write_csv(f"{folder}/2026-07-0{n}.csv", f"part-{k}", golden_day(n)[k::10])


def builds(flow):
    return sorted((r.sale_date, r.row_count) for r in ledger.day_ledger(flow.store).collect())


def test_parts_wait_for_their_marker(spark, flow, folder):
    checkpoint = f"{folder}_checkpoint"
    parts_of(folder, 1, 0, 5)
    write_csv(folder, "2026-07-02", golden_day(2))  # one file: complete as it is
    run_drops(flow, folder, checkpoint, max_files_per_trigger=2)
    assert builds(flow) == [(d("2026-07-02"), 28)]
    write_text(spark, f"{folder}/2026-07-01.of-10.done", "all ten")
    run_drops(flow, folder, checkpoint, max_files_per_trigger=2)
    assert len(builds(flow)) == 1  # four parts are still missing
    parts_of(folder, 1, 6, 9)
    run_drops(flow, folder, checkpoint, max_files_per_trigger=1)
    assert builds(flow) == [(d("2026-07-01"), 22), (d("2026-07-02"), 28)]
    run_drops(flow, folder, checkpoint)
    assert len(builds(flow)) == 2
    write_csv(f"{folder}/2026-07-01.csv", "part-late", [["late", "ST-01", "2026-07-01", "1.00", "0.10", "online"]])
    write_text(spark, f"{folder}/2026-07-01.again-2.done", "one more")
    run_drops(flow, folder, checkpoint, max_files_per_trigger=5)
    assert builds(flow)[:2] == [(d("2026-07-01"), 22), (d("2026-07-01"), 23)]


def test_quiet_drop_is_taken_in_without_a_marker(spark, flow, folder):
    parts_of(folder, 3, 0, 9)
    query = stream_drops(flow, folder, f"{folder}_checkpoint", max_files_per_trigger=4, quiet=4, every="1 second")
    try:
        until = time.time() + 90
        while not builds(flow) and time.time() < until:
            time.sleep(1)
    finally:
        query.stop()
    assert query.exception() is None and builds(flow) == [(d("2026-07-03"), 19)]

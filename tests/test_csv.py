import pytest

from daymend.operators.stage import stage_sales
from daymend.sources.csv_files import read_drops, read_master
from daymend.sources.files import drops
from daymend.sources.landing import CsvLanding
from sample import HEADER, STORES, d, write_csv


def staged(spark, *paths):
    return {r.sale_id: r for r in stage_sales(read_drops(spark, list(paths))).collect()}


def test_columns_go_by_name(spark, folder):
    a = write_csv(folder, "2024-01-01", [["s1", "ST-01", "2024-01-01", "10.00", "1.00", "online"]])
    b = write_csv(folder, "2024-01-02", [["2.00", "20.00", "s2", "ST-02", "2024-01-02", "phone", "?"]],
                  ["tax_amount", "gross_amount", "sale_id", "store_id", "sale_date", "channel", "extra"])
    c = write_csv(folder, "2024-01-03", [["s3", "ST-01", "2024-01-03", "30.00", "3.00"]], HEADER[:-1])
    rows = staged(spark, a, b, c)
    assert (str(rows["s2"].gross_amount), str(rows["s2"].tax_amount)) == ("20.00", "2.00")
    assert rows["s3"].channel is None and rows["s2"].source_file == "2024-01-02"


def test_empty_fields_are_null(spark, folder):
    path = write_csv(folder, "2024-01-01", [["s1", "", "2024-01-01", "10.00", '""', "online"]])
    row = staged(spark, path)["s1"]
    assert row.store_id is None and row.tax_amount is None


def test_bad_number_fails(spark, folder):
    path = write_csv(folder, "2024-01-01", [["s1", "ST-01", "2024-01-01", "ten", "1.00", "online"]])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_sales(read_drops(spark, [path])).collect()


def test_quotes(spark, folder):
    path = write_csv(folder, "2024-01-01", [['"a ""b"", c"', "ST-01", "2024-01-01", "1.00", "0.10", "online"]])
    assert set(staged(spark, path)) == {'a "b", c'}


def test_line_breaks_inside_quotes(spark, folder):
    path = write_csv(folder, "2024-01-01", [['"two\nlines"', "ST-01", "2024-01-01", "1.00", "0.10", "online"]])
    rows = read_drops(spark, [path], multi_line=True).collect()
    assert [r.sale_id for r in rows] == ["two\nlines"]


def test_listing_and_names(spark, folder):
    write_csv(folder, "2024-01-02", [])
    write_csv(folder + "/2024-01-01.csv", "part-0", [["s1", "ST-01", "2024-01-01", "1.00", "0.10", "online"]])
    write_csv(folder, "a+b c", [["s2", "ST-01", "2024-01-01", "1.00", "0.10", "online"]])
    found = dict(drops(spark, folder))
    assert set(found) == {"2024-01-01", "2024-01-02", "a+b c"}
    rows = staged(spark, *found.values())
    assert rows["s1"].source_file == "2024-01-01" and rows["s2"].source_file == "a+b c"


def test_relanding_a_file_replaces_its_rows(spark, store, folder):
    landing = CsvLanding(store, folder)
    write_csv(folder, "2024-01-01", [["s1", "ST-01", "2024-01-01", "1.00", "0.10", "online"],
                                     ["s0", "ST-01", "2023-12-31", "1.00", "0.10", "online"]])
    write_csv(folder, "2024-01-02", [["s2", "ST-01", "2024-01-01", "2.00", "0.10", "online"]])
    assert landing.land(["2024-01-01", "2024-01-02"]) == [d("2023-12-31"), d("2024-01-01")]
    write_csv(folder, "2024-01-01", [["s1", "ST-01", "2024-01-01", "5.00", "0.10", "online"]])
    assert landing.land(["2024-01-01"]) == [d("2023-12-31"), d("2024-01-01")]
    rows = sorted((r.sale_id, str(r.gross_amount), r.source_file) for r in landing.rows(landing.days(["2024-01-01", "2024-01-02"])).collect())
    assert rows == [("s1", "5.00", "2024-01-01"), ("s2", "2.00", "2024-01-02")]


def test_days_that_come_again_as_they_were_are_left_out(spark, store, folder):
    one, two = (["s1", "ST-01", "2024-01-01", "1.00", "0.10", "online"], ["s2", "ST-02", "2024-01-02", "2.00", "0.20", "phone"])
    more = ["s3", "ST-02", "2024-01-02", "3.00", "0.20", ""]
    landing = CsvLanding(store, folder)

    def landed():
        return sorted((r.sale_id, str(r.gross_amount)) for r in landing.rows(landing.days(["f", "g"])).collect())

    write_csv(folder, "f", [one, two, more])
    write_csv(folder, "g", [["s9", "ST-01", "2024-01-02", "9.00", "0.10", "online"]])
    assert landing.take(["f", "g"]) == [d("2024-01-01"), d("2024-01-02")]
    landing.accept(["f", "g"])
    write_csv(folder, "f", [more, two, one])  # another order
    assert landing.take(["f"]) == [d("2024-01-01"), d("2024-01-02")]  # not known to be loaded
    landing.refuse(["f"])
    assert landing.take(["f", "g"], ["f", "g"]) == []
    landing.accept(["f", "g"])
    assert landed() == [("s1", "1.00"), ("s2", "2.00"), ("s3", "3.00"), ("s9", "9.00")]
    write_csv(folder, "f", [one, two, two])  # a row for another, the same number of rows
    assert landing.take(["f"], ["f"]) == [d("2024-01-02")]
    rows = landing.rows([d("2024-01-01"), d("2024-01-02")], ["f", "g"], ["f"])
    assert sorted(r.sale_id for r in rows.collect()) == ["s1", "s2", "s2", "s9"]
    landing.accept(["f"])
    assert landed() == [("s1", "1.00"), ("s2", "2.00"), ("s2", "2.00"), ("s9", "9.00")]
    write_csv(folder, "f", [two, two])
    assert landing.take(["f"], ["f"]) == [d("2024-01-01")]
    landing.accept(["f"])
    write_csv(folder, "f", [])
    assert landing.take(["f", "g"], ["f", "g"]) == [d("2024-01-02")]
    landing.accept(["f", "g"])
    assert landed() == [("s9", "9.00")]
    assert [(r.sale_date, r.n) for r in landing.digests(["f", "g"]).collect()] == [(d("2024-01-02"), 1)]


def test_two_loaders_hold_apart(spark, store, folder):
    """Files are held by name: what one loader refuses or takes does not touch what another holds."""
    for n in (1, 2, 3):
        write_csv(folder, f"2024-01-0{n}", [[f"s{n}", "ST-01", f"2024-01-0{n}", "1.00", "0.10", "online"]])
    one, two = CsvLanding(store, folder), CsvLanding(store, folder)
    one.take(["2024-01-01"])
    two.take(["2024-01-02", "2024-01-03"])
    two.refuse(["2024-01-03"])
    one.accept(["2024-01-01"])
    two.accept(["2024-01-02"])
    assert sorted(r.sale_id for r in one.rows(one.days([f"2024-01-0{n}" for n in (1, 2, 3)])).collect()) == ["s1", "s2"]


def test_master(spark, folder):
    path = write_csv(folder, "stores", [list(s[:3]) for s in STORES], ["store_id", "store_name", "region"])
    assert sorted(tuple(r) for r in read_master(spark, path).collect()) == [s[:3] for s in STORES]

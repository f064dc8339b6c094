"""Hand-made rows for tests."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

SALE = "sale_id string, store_id string, sale_date date, gross_amount decimal(10,2), " \
       "tax_amount decimal(10,2), channel string, source_file string"
FACT = "sale_id string, sale_date date, gross_amount decimal(10,2), net_amount decimal(11,2)"
HEADER = ["sale_id", "store_id", "sale_date", "gross_amount", "tax_amount", "channel"]

# Store names and regions are made up; the keys are fixed values that the key function must give.
STORES = [("ST-01", "Mill Lane", "Coast", "4107152013173585981"),
          ("ST-02", "Old Pier", "Coast", "2327920453883448302"),
          ("ST-03", "Long Field", "Plain", "17763199528127575263"),
          ("ST-04", "Red Rock", "Hills", "15934552467445253649"),
          ("ST-05", "Ferry Street", "Plain", "1513165664181054485")]

# Rows, gross and tax of fourteen consecutive days from 2026-07-01.
DAYS = [(22, "5119.54", "391.66"), (28, "6260.78", "467.69"), (19, "4681.95", "328.81"),
        (31, "5977.87", "442.47"), (24, "5062.03", "365.22"), (26, "4751.10", "357.78"),
        (33, "7298.61", "560.14"), (20, "3734.11", "275.89"), (29, "7565.30", "557.27"),
        (25, "4994.05", "378.05"), (18, "3544.07", "265.28"), (34, "7435.77", "578.06"),
        (23, "5237.22", "403.16"), (27, "5540.73", "425.67")]


def d(text: str) -> date:
    return date.fromisoformat(text)


def master(spark):
    return spark.createDataFrame([s[:3] for s in STORES], "store_id string, store_name string, region string")


def golden_day(n: int) -> list[list[str]]:
    """CSV rows of the n-th day (from 1) that add up to its totals: equal rows, the rest in the last."""
    rows, gross, tax = DAYS[n - 1]
    day = date(2026, 7, n).isoformat()
    one, part = Decimal("10.00"), Decimal("1.00")
    out = []
    for i in range(rows):
        last = i == rows - 1
        g = Decimal(gross) - one * (rows - 1) if last else one
        t = Decimal(tax) - part * (rows - 1) if last else part
        out.append([f"SL-{n}-{i}", f"ST-0{i % 5 + 1}", day, str(g), str(t), ["online", "in_store", "phone"][i % 3]])
    return out


def write_csv(folder: str, name: str, rows: list[list[str]], header: list[str] = HEADER) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}.csv")
    with open(path, "w") as out:
        out.write("\n".join(",".join(r) for r in [header, *rows]) + "\n")
    return path


def golden_folder(folder: str, days: int = 14) -> str:
    for n in range(1, days + 1):
        write_csv(folder, date(2026, 7, n).isoformat(), golden_day(n))
    return folder


def files_of(path: str) -> dict[str, float]:
    """Data files below a path with their times."""
    return {os.path.join(base, f): os.stat(os.path.join(base, f)).st_mtime_ns
            for base, _, files in os.walk(path) for f in files if f.endswith(".parquet")}

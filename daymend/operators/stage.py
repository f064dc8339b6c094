"""Stage layer: names and types, no logic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.schema import MONEY


def stage_sales(landed: DataFrame) -> DataFrame:
    """Typed sale rows. Casts are ANSI: text that is no date or number fails the job."""
    return landed.select(
        "sale_id",
        "store_id",
        F.col("sale_date").cast("date").alias("sale_date"),
        F.col("gross_amount").cast(MONEY).alias("gross_amount"),
        F.col("tax_amount").cast(MONEY).alias("tax_amount"),
        "channel",
        "source_file",
    )


def stage_stores(master: DataFrame) -> DataFrame:
    return master.select("store_id", "store_name", "region")

"""Transform layer: the versioned business formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from daymend.functions.measures import CORRECT, net_amount


def transform_sales(staged: DataFrame, formula: str | Column = CORRECT) -> DataFrame:
    """Sale rows with their net amount; a Column may pick the formula per row."""
    net = net_amount(formula) if isinstance(formula, str) else formula
    return staged.select(
        "sale_id", "store_id", "sale_date", "channel", "gross_amount", "tax_amount",
        net.alias("net_amount"),
    )

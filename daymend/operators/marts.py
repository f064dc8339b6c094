"""Datamart layer: what BI reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.functions.measures import is_bugged, net_ratio
from daymend.schema import TOTAL


#: The mart as a view over the fact.
DAILY_SALES_SQL = """
SELECT sale_date, count(*) AS orders, sum(gross_amount) AS gross_total,
       sum(tax_amount) AS tax_total, sum(net_amount) AS net_total
FROM {fact_sale} GROUP BY sale_date
"""
#: The same from the sums that each build logs of the days it wrote; the fact is not read.
KEPT_SALES_SQL = """
SELECT sale_date, last.fact_rows AS orders, last.fact_gross_total AS gross_total,
       last.fact_tax_total AS tax_total, last.fact_net_total AS net_total
FROM (SELECT sale_date, max_by(struct(fact_rows, fact_gross_total, fact_tax_total, fact_net_total),
                               struct(seq, built_at)) AS last
      FROM {day_ledger} GROUP BY sale_date)
WHERE last.fact_rows > 0
"""


def daily_sales(fact: DataFrame) -> DataFrame:
    """Orders and totals per day. Unsorted: order it where it is shown."""
    return fact.groupBy("sale_date").agg(
        F.count("*").alias("orders"),
        F.sum("gross_amount").cast(TOTAL).alias("gross_total"),
        F.sum("tax_amount").cast(TOTAL).alias("tax_total"),
        F.sum("net_amount").cast(TOTAL).alias("net_total"))


def daily_sales_flagged(fact: DataFrame) -> DataFrame:
    """The mart with the flipped-sign mark and the net share of gross."""
    return daily_sales(fact).select("*", is_bugged().alias("bugged"), net_ratio().alias("net_ratio"))

"""Digests of rows that do not depend on their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymend.functions.keys import surrogate_key

#: What a landed sale and its row in the fact have in common; the store goes by its key.
_SALE = ("sale_id", "sale_date", "channel", "gross_amount", "tax_amount")


def row_hash(*columns: Column) -> Column:
    """64-bit hash of a row; NULL is a value of its own in each column."""
    nulls = F.concat(*[c.isNull().cast("string") for c in columns])
    return F.xxhash64(*columns, nulls)


def sale_hash(store_key: Column) -> Column:
    return row_hash(*map(F.col, _SALE), store_key)


def landed_hash() -> Column:
    """Hash of a landed sale, equal to that of the fact row it becomes."""
    return sale_hash(surrogate_key("store_id"))


def order_free(hashed: Column) -> list[Column]:
    """Aggregates n and digest of a set of rows: the same rows in any order and layout give the same, repeated ones count."""
    return [F.count("*").alias("n"), F.sum(hashed.cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest")]

"""What each day of the fact holds, kept beside it so that checks across days read only the days that matter.

``day_keys`` is a bitmap of the surrogate keys of a day: key 2**6 * word + place (of the first 58 bits) is one bit of a word, and
only words with a bit are kept. Two days can share a key only where words meet. At this width two days of a hundred million
random keys meet by chance in one of thirty cases, and then only cost a read. ``day_stores`` counts the sales of a day by store key.

An index is written when a build has staged its batch, in a partition of (day, build), next to the one of the build before. It
counts from the moment the day ledger names that build for the day; ``settle`` then drops the others. So an index that a
refused batch or a lost run left behind is never taken for the day, at worst days are read that need not be. Days whose
newest build has no index (built without the gate, or by key) are unknown, and the caller reads them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.operators.write import empty_partitions, in_days, replace_partitions
from daymend.sources.local import local_frame
from daymend.sources.tables import TableStore

KEYS, STORES = "day_keys", "day_stores"
_PARTITION = ["sale_date", "built"]
_BUILDS = T.StructType([T.StructField("sale_date", T.DateType()), T.StructField("built", T.StringType())])
_BIT = "shiftleft(1L, cast((sale_key div 64) & 63 AS int))"


def key_words(rows: DataFrame) -> DataFrame:
    """Bitmaps of the keys by day: sale_date, word, bits."""
    return rows.groupBy("sale_date", F.expr("shiftright(sale_key div 64, 6)").alias("word")).agg(F.bit_or(F.expr(_BIT)).alias("bits"))


def store_counts(rows: DataFrame) -> DataFrame:
    """Sales by day and store key: sale_date, store_key, n."""
    return rows.groupBy("sale_date", "store_key").agg(F.count("*").alias("n"))


def keep(store: TableStore, name: str, rows: DataFrame, build: int) -> DataFrame:
    """Write the index of a build's days; returns it as it was written."""
    tagged = rows.withColumn("built", F.lit(str(build)))
    store.create(name, tagged.schema, _PARTITION)
    again = [s for s in store.partitions(name) if s[1] == str(build)]  # of a run that died with this number
    replace_partitions(store, name, tagged, again)
    return store.read(name).where(F.col("built") == str(build))


def fill(store: TableStore, name: str, rows: DataFrame, builds: dict[date | None, int]) -> None:
    """Write the index of published days as that of their newest builds."""
    days = local_frame(store.spark, _BUILDS, [(day, str(build)) for day, build in builds.items()]).withColumnRenamed("sale_date", "day")
    tagged = rows.join(F.broadcast(days), F.col("sale_date").eqNullSafe(F.col("day"))).drop("day")
    store.create(name, tagged.schema, _PARTITION)
    replace_partitions(store, name, tagged, [s for s in store.partitions(name) if s[0] in builds])


def known_days(store: TableStore, name: str, builds: dict[date | None, int]) -> list[date | None]:
    """The days of ``builds`` (day to newest build) whose index is that of the build."""
    have = set(store.partitions(name))
    return [day for day, build in builds.items() if (day, str(build)) in have]


def read(store: TableStore, name: str, days: Iterable[date | None]) -> DataFrame:
    return store.read(name).where(in_days(F.col("sale_date"), days))


def settle(store: TableStore, name: str, days: Iterable[date | None], build: int) -> None:
    """Drop what other builds told about these days."""
    wanted = set(days)
    empty_partitions(store, name, [s for s in store.partitions(name) if s[0] in wanted and s[1] != str(build)])


def forget(store: TableStore, name: str, build: int) -> None:
    """Drop the index of a build that was refused."""
    empty_partitions(store, name, [s for s in store.partitions(name) if s[1] == str(build)])


def days_sharing_keys(index: DataFrame, words: DataFrame) -> list[date | None]:
    """Days of the index with a bit that the given words have too.

    Words grow with the sales of a batch, so both sides are shuffled and none goes through the driver.
    """
    own = words.groupBy("word").agg(F.bit_or("bits").alias("own")).hint("merge")
    met = index.join(own, "word").where(F.col("bits").bitwiseAND(F.col("own")) != 0)
    return [r.sale_date for r in met.select("sale_date").distinct().collect()]


def days_with_stores(index: DataFrame, keys: DataFrame) -> list[date | None]:
    """Days of the index with sales of the given store keys."""
    met = index.join(keys.hint("merge"), "store_key", "left_semi")
    return [r.sale_date for r in met.select("sale_date").distinct().collect()]

"""Small DataFrame helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymend.session import fresh_root
from daymend.sources import files as folders


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(frame: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts the lineage and survives lost executors.

    ``files`` bounds their number where the rows are known to be few.
    """
    path = f"{fresh_root(frame.sparkSession, label)}"
    (frame.coalesce(files) if files else frame).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def dropped(frame: DataFrame) -> None:
    """Delete the folder of a ``stored`` frame that nothing reads any more."""
    folders.delete(frame.sparkSession, {x.rsplit("/", 1)[0] for x in frame.inputFiles()})


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of each action, not when the driver's memory is next cleaned."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def total_bytes(frame: DataFrame, column: str) -> int:
    return frame.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every id in ``edges(a, b)``: rows (id, component_id).

    Alternates large-star and small-star steps; each halves the depth of the trees, so the rounds grow with the
    logarithm of the longest chain. A round sends every edge to both ends at most; groups are reduced by ``min``
    with map-side combine and then joined, so a hub with millions of edges is never collected into a row.
    """
    known = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    files = 1 + known.count() // 100_000  # a round never has more edges than the one before
    for _ in range(max_rounds):
        # done when every id hangs on one other that hangs on none
        tops = known.select(F.col("b").alias("a")).distinct().withColumn("top", F.lit(1))
        if known.groupBy("a").agg(F.count("*").alias("n")).join(tops, "a", "left").where(
                "n > 1 or top is not null").isEmpty():
            break
        both = known.union(known.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        known = stored(small.union(low.select("a", F.col("low").alias("b"))).distinct(), label, files)
    else:
        raise RuntimeError("components did not settle")
    return known.toDF("id", "component_id").union(known.select("b", "b").distinct())

"""Daily CSV drops, read by header name."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.functions.measures import file_stem
from daymend.schema import LANDING_COLUMNS, MASTER_STORE

_CSV = {"header": True, "quote": '"', "escape": '"', "recursiveFileLookup": True,
        "pathGlobFilter": "*.csv", "mode": "PERMISSIVE"}
_HEADER_JOBS = 8  # first lines read at a time


def read_drops(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = LANDING_COLUMNS,
               multi_line: bool = False) -> DataFrame:
    """Rows of the given drops as text, with ``source_file`` first; a path is a file or the folder of a drop.

    Columns are matched by name: drops with the same header are read together, a missing column
    is NULL, an extra one is dropped, an empty field is NULL. One header is read for each drop; a part file whose
    header differs from that of its drop fails the read. Typing is left to the stage casts, which
    fail on bad text where a typed CSV read would turn it into NULL. A day may be one file ``2024-01-05.csv`` or a folder
    of that name holding part files, which is what a distributed producer writes. ``multi_line`` allows line breaks inside
    quotes; such a file is read by one task, so ask for it only where producers write them.
    """
    by_header = defaultdict(list)
    with ThreadPoolExecutor(_HEADER_JOBS) as pool:
        headers = list(pool.map(lambda path: _header(spark, path), paths))
    for path, header in zip(paths, headers):
        by_header[tuple(header)].append(path)
    groups = [_read_group(spark, header, files, columns, multi_line)
              for header, files in sorted(by_header.items())]
    if not groups:
        text = T.StructType([T.StructField(c, T.StringType()) for c in ["source_file", *columns]])
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in text.fields])
    return reduce(DataFrame.unionByName, groups)


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """The store master list, typed."""
    return spark.read.schema(MASTER_STORE).option("header", True).option("enforceSchema", False).csv(path)


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file. Spark reads its first line only."""
    return spark.read.options(**_CSV, inferSchema=False).csv(path).columns


def _read_group(spark: SparkSession, header: tuple, files: list[str], columns: Sequence[str],
                multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(schema).options(**_CSV, enforceSchema=False, multiLine=multi_line).csv(files)
    # Spark escapes the path in _metadata; a literal + must survive the decoding.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    values = [F.nullif(F.col(f"`{c}`"), F.lit("")) if c in header else F.lit(None).cast("string")
              for c in columns]
    return raw.select(file_stem(path).alias("source_file"), *[v.alias(c) for v, c in zip(values, columns)])

"""Small frames from driver-side rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.LongType: pa.int64(),
    T.StringType: pa.string(),
    T.DateType: pa.date32(),
    T.BooleanType: pa.bool_(),
    T.TimestampType: pa.timestamp("us", "UTC"),
    T.DecimalType: pa.decimal128(38, 2),
    T.ArrayType: pa.list_(pa.string()),
}


def local_frame(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """Bookkeeping rows (days, files, checks) as one partition. Going through Arrow keeps
    them a local relation of the plan, so a write needs no Python worker."""
    fields = pa.schema([(f.name, _ARROW[type(f.dataType)]) for f in schema.fields])
    columns = zip(*rows) if rows else [()] * len(fields)
    table = pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(table, schema).coalesce(1)

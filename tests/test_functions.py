from pyspark.sql import functions as F

from daymend.functions.keys import surrogate_key
from daymend.functions.measures import drop_root, file_stem, net_ratio
from sample import STORES


def test_published_keys(spark):
    frame = spark.createDataFrame([(s[0], s[3]) for s in STORES], "store_id string, expected string")
    got = frame.select(surrogate_key("store_id").cast("string").alias("k"), "expected").collect()
    assert all(r.k == r.expected for r in got)


def test_key_type_holds_unsigned_64_bit(spark):
    frame = spark.range(1000).select(surrogate_key("id").alias("k"))
    assert frame.schema["k"].dataType.simpleString() == "decimal(20,0)"
    top = frame.agg(F.max("k").alias("hi"), F.min("k").alias("lo")).first()
    assert top.hi > 2**63 and 0 <= top.lo and top.hi < 2**64


def test_composite_keys_collide_as_documented(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")]
    keys = [r.k for r in spark.createDataFrame(rows, "a string, b string")
            .select(surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] == keys[1] and keys[2] == keys[3] and keys[0] != keys[2]


def test_stems(spark):
    paths = ["file:/in/2024-01-05.csv", "hdfs://n/in/2024-01-05.csv/part-0.csv",
             "s3a://b/in/drop=2024-01-05.csv/part-00001-x.c000.csv"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string") \
        .select(file_stem(F.col("p")).alias("s"), drop_root(F.col("p")).alias("r")).collect()
    assert {r.s for r in rows} == {"2024-01-05"}
    assert [r.r.rsplit("/", 1)[1] for r in rows] == ["2024-01-05.csv", "2024-01-05.csv", "drop=2024-01-05.csv"]


def test_ratio_of_zero_gross(spark):
    row = spark.sql("select cast(5 as decimal(10,2)) net_total, cast(0 as decimal(10,2)) gross_total") \
        .select(net_ratio().alias("r")).first()
    assert row.r == 0.0

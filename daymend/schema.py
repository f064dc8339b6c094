"""Column lists, types and closed lists of the sale model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data model.
LANDING_COLUMNS = ["sale_id", "store_id", "sale_date", "gross_amount", "tax_amount", "channel"]
STORE_COLUMNS = ["store_id", "store_name", "region"]
CHANNELS = ["online", "in_store", "phone"]
ACTIONS = ["load_next", "inject_bug", "fix_and_backfill", "reset"]
EXPORT_TABLES = ["fact_sale", "dim_store", "dim_partition_status", "dm_daily_sales"]
STAGE_RELATIONS = ["stg_store", "stg_sale", "trn_tbl_sale"]
SAMPLE_LIMIT = 120
AUDIT_LIMIT = 200
HISTORY_LIMIT = 12

MONEY = "decimal(10,2)"
TOTAL = "decimal(38,2)"
SURROGATE = "decimal(20,0)"

MASTER_STORE = T.StructType([T.StructField(c, T.StringType()) for c in STORE_COLUMNS])

PARTITION_TYPES = {"sale_date": T.DateType(), "source_file": T.StringType(), "built": T.StringType()}

DAY_LEDGER = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("fact_rows", T.LongType()),
    T.StructField("fact_net_total", T.DecimalType(38, 2)),
    T.StructField("fact_gross_total", T.DecimalType(38, 2)),
    T.StructField("fact_tax_total", T.DecimalType(38, 2)),
    T.StructField("gross_total", T.DecimalType(38, 2)),
    T.StructField("net_total", T.DecimalType(38, 2)),
    T.StructField("formula", T.StringType()),
    T.StructField("built_at", T.TimestampType()),
])

RUN_LEDGER = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("formula", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("touched", T.LongType()),
    T.StructField("passed", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("published", T.BooleanType()),
    T.StructField("files", T.ArrayType(T.StringType())),
    T.StructField("message", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("failed_checks", T.ArrayType(T.StringType())),
    T.StructField("converged", T.BooleanType()),
])

CHECK_RESULTS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("check", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])

LANDED_DIGEST = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("digest", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])

AUDIT = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("invocation_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
])

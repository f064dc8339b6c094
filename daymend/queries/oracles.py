"""The same results in plain SQL over the given tables: closed forms of the end states."""

from __future__ import annotations

from daymend.operators.checks import Check, sale_suite
from daymend.queries.fixtures import CLOSED_REGION, EVENT_TYPES
from daymend.queries.quality import KNOWN_CHANNELS

_T = """t AS (
  SELECT event_id AS sale_id, user_id AS store_id, CAST(ts AS DATE) AS sale_date,
         CAST(value AS DECIMAL(10,2)) AS gross_amount,
         CAST(CAST(value AS DECIMAL(10,2)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(4,0))
              * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(10,2)) AS tax_amount,
         event_type AS channel, CAST(CAST(ts AS DATE) AS VARCHAR) AS source_file
  FROM events)"""

_DIM = """dim AS (
  SELECT CAST(md5_number_upper(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), ''))) AS VARCHAR) AS store_key,
         c_custkey AS store_id, c_name AS store_name, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CLEAN = "gross_amount - tax_amount"
_BAD = "gross_amount + tax_amount"
_MIXED = f"CASE WHEN sale_date >= DATE '2024-01-21' THEN {_BAD} ELSE {_CLEAN} END"

# State in the middle of the bug: days 1..25 loaded, 21..25 wrong.
_M = f"m AS (SELECT *, {_MIXED} AS net_amount FROM t WHERE sale_date <= DATE '2024-01-25')"

_SALE_KEY = "CAST(md5_number_upper(concat_ws('|', coalesce(CAST(sale_id AS VARCHAR), ''))) AS VARCHAR)"


def _total(expression: str, name: str) -> str:
    return f"CAST(sum({expression}) AS DECIMAL(38,2)) AS {name}"


def _fact(net: str, rows: str = "t", where: str = "true") -> str:
    """Published fact rows for one net formula over the rows."""
    return f"""WITH {_T}, {_DIM}
        SELECT {_SALE_KEY} AS sale_key, sale_id, store_key, sale_date, channel, gross_amount, tax_amount,
               {net} AS net_amount
        FROM {rows} JOIN dim USING (store_id) WHERE {where}"""


def _mart(net: str) -> str:
    return f"""WITH {_T}
        SELECT sale_date, count(*) AS orders, {_total('gross_amount', 'gross_total')},
               {_total('tax_amount', 'tax_total')}, {_total(net, 'net_total')}
        FROM t GROUP BY sale_date"""


_PARTIAL = f"CASE WHEN sale_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-08' THEN {_CLEAN} ELSE {_BAD} END"

_STATUS = f"""SELECT sale_date, count(*) AS row_count, {_total('gross_amount', 'gross_total')},
    {_total('net_amount', 'net_total')}, sum(net_amount) > sum(gross_amount) AS bugged,
    'load_next' AS built_by_action FROM m GROUP BY sale_date"""

_SERIES = f"""SELECT sale_date, {_total(_CLEAN, 'correct')},
    CASE WHEN sale_date >= DATE '2024-01-21' THEN {_total(_BAD, '').removesuffix(' AS ')} END AS bugged,
    {_total('net_amount', 'current')},
    CAST(count(*) FILTER (WHERE net_amount IS DISTINCT FROM {_CLEAN}) AS BIGINT) AS wrong_rows,
    sum({_CLEAN}) = sum(net_amount) AS converged
    FROM m GROUP BY sale_date"""

_SUITE_MODELS = f"""{_T}, {_DIM}, {_M},
    stg_store AS (SELECT store_id, store_name, region FROM dim), dim_store AS (SELECT * FROM dim),
    stg_sale AS (SELECT * FROM t WHERE sale_date <= DATE '2024-01-25'), trn_tbl_sale AS (SELECT * FROM m),
    fact_sale AS (SELECT {_SALE_KEY} AS sale_key, m.*, store_key FROM m JOIN dim USING (store_id)),
    dim_partition_status AS ({_STATUS}),
    dm_daily_sales AS (SELECT sale_date, count(*) AS orders FROM fact_sale GROUP BY sale_date)"""


def _failing(check: Check) -> str:
    columns = ", ".join(check.columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in check.columns)
    values = ", ".join(f"'{v}'" for v in check.values)
    first = check.columns[0]
    return {
        "unique": f"SELECT {columns} FROM {check.model} WHERE {known} GROUP BY {columns} HAVING count(*) > 1",
        "duplicates": f"SELECT {columns} FROM {check.model} GROUP BY {columns} HAVING count(*) > 1",
        "not_null": f"SELECT {first} FROM {check.model} WHERE {first} IS NULL",
        "accepted_values": f"SELECT DISTINCT {first} FROM {check.model} WHERE {first} NOT IN ({values})",
        "relationships": f"SELECT {first} FROM {check.model} WHERE {first} NOT IN "
                         f"(SELECT {check.parent_column} FROM {check.parent})",
        "rule": f"SELECT {columns} FROM {check.model} WHERE {check.predicate}",
    }[check.kind]


def _suite(channels: list[str]) -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT '{c.name}' AS \"check\", '{c.model}' AS model, '{c.kind}' AS kind, "
        f"(SELECT count(*) FROM ({_failing(c)})) AS failures" for c in sale_suite(channels))
    return f"""WITH {_SUITE_MODELS}, tallies AS ({rows})
        SELECT "check", model, kind, failures, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status
        FROM tallies"""


_LOADS = """load_days AS (
    SELECT sale_date, CAST(day(sale_date) + 5 AS BIGINT) // 6 AS seq, count(*) AS n FROM t GROUP BY sale_date),
  loads AS (
    SELECT seq, sum(sum(n)) OVER (ORDER BY seq) AS n_rows, sum(count(*)) OVER (ORDER BY seq) AS n_days,
           min(sale_date) AS first_day, max(sale_date) AS last_day, count(*) AS touched
    FROM load_days GROUP BY seq),
  audit AS (
    SELECT seq, 'fact_sale' AS model_name, n_rows AS row_count FROM loads
    UNION ALL SELECT seq, 'dim_partition_status', n_days FROM loads
    UNION ALL SELECT seq, 'dm_daily_sales', n_days FROM loads
    UNION ALL SELECT seq, 'dim_store', (SELECT count(*) FROM dim) FROM loads)"""

_KNOWN = ", ".join(f"'{c}'" for c in KNOWN_CHANNELS)
_UNKNOWN = [t for t in EVENT_TYPES if t not in KNOWN_CHANNELS][0]

ORACLES = {
    # models
    "stg_sale": f"WITH {_T} SELECT * FROM t",
    "stg_store": f"WITH {_DIM} SELECT store_id, store_name, region FROM dim",
    "trn_tbl_sale": f"""WITH {_T} SELECT sale_id, store_id, sale_date, channel, gross_amount, tax_amount,
        {_CLEAN} AS net_amount FROM t""",
    "trn_tbl_sale_bugged": f"""WITH {_T} SELECT sale_id, store_id, sale_date, channel, gross_amount, tax_amount,
        {_BAD} AS net_amount FROM t""",
    "dim_store": f"WITH {_DIM} SELECT store_key, store_id, store_name, region FROM dim",
    "surrogate_key": """SELECT o_orderkey,
        CAST(md5_number_upper(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''))) AS VARCHAR) AS order_key
        FROM orders""",
    "surrogate_key_composite": """SELECT o_orderkey, o_orderpriority,
        CAST(md5_number_upper(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''),
             coalesce(CAST(o_orderpriority AS VARCHAR), ''))) AS VARCHAR) AS order_key FROM orders""",
    "fact_sale": _fact(_CLEAN),
    "orphan_sales": f"""WITH {_T}, {_DIM} SELECT sale_id, store_id, sale_date, channel, gross_amount, tax_amount,
        {_CLEAN} AS net_amount FROM t
        WHERE store_id NOT IN (SELECT store_id FROM dim WHERE region <> '{CLOSED_REGION}')""",
    "range_filter": f"""WITH {_T} SELECT sale_id, store_id, sale_date, channel, gross_amount, tax_amount,
        {_CLEAN} AS net_amount FROM t WHERE sale_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-08'""",
    "dm_daily_sales": _mart(_CLEAN),
    "model_sample": f"""WITH {_T} SELECT * FROM t ORDER BY sale_id NULLS LAST, store_id NULLS LAST,
        sale_date NULLS LAST, gross_amount NULLS LAST, tax_amount NULLS LAST, channel NULLS LAST,
        source_file NULLS LAST LIMIT 120""",
    # write path
    "full_refresh_bugged": _fact(_BAD),
    "backfill_partial": _fact(_PARTIAL),
    "backfill_partial_mart": _mart(_PARTIAL),
    "backfill_full": _fact(_CLEAN),
    "replay_idempotent": _fact(_PARTIAL),
    "replay_noop": _fact(_CLEAN),
    "load_next_day": _fact(_CLEAN),
    "late_rows_replay": _fact(_CLEAN),
    "stream_ingest_daily": _fact(_CLEAN),
    "refused_file_stays_out": _fact(_CLEAN, where="sale_date <= DATE '2024-01-25'"),
    "refused_file_does_not_block": _fact(_CLEAN),
    "backfill_by_key": _fact(_CLEAN),
    "orphaned_by_dimension_change": f"""WITH {_T}, {_DIM}
        SELECT 'relationships_fact_sale_store_key_dim_store' AS "check", count(*) AS failures, 'fail' AS status
        FROM t JOIN dim USING (store_id) WHERE region = '{CLOSED_REGION}' AND sale_date <> DATE '2024-01-07'""",
    "master_from_file": f"""WITH {_DIM} SELECT store_key, CAST(store_id AS VARCHAR) AS store_id, store_name, region
        FROM dim""",
    "range_replace": _fact(_CLEAN, where="""sale_date <> DATE '2024-01-11'
        AND NOT (sale_date = DATE '2024-01-12' AND channel = 'error')"""),
    "upsert_by_key": f"""WITH {_T}, {_DIM}, changed AS (
        SELECT sale_id, store_id, channel, tax_amount,
            CASE WHEN sale_date >= DATE '2024-01-28' AND channel = 'view'
                 THEN CAST(sale_date + INTERVAL 1 DAY AS DATE) ELSE sale_date END AS sale_date,
            CAST(CASE WHEN sale_date >= DATE '2024-01-28' THEN gross_amount + 1 ELSE gross_amount END
                 AS DECIMAL(10,2)) AS gross_amount FROM t)
        SELECT {_SALE_KEY} AS sale_key, sale_id, store_key, sale_date, channel, gross_amount, tax_amount,
               {_CLEAN} AS net_amount FROM changed JOIN dim USING (store_id)""",
    "reset_empty": f"""WITH {_DIM} SELECT 'dim_store' AS name, count(*) AS n FROM dim
        UNION ALL SELECT 'fact_sale', 0 UNION ALL SELECT 'dim_partition_status', 0
        UNION ALL SELECT 'dm_daily_sales', 0""",
    "csv_ingest": f"WITH {_T} SELECT * FROM t",
    "landing_union": f"""WITH {_T} SELECT * REPLACE (
        CASE WHEN sale_date <= DATE '2024-01-20' THEN channel END AS channel) FROM t""",
    "ledger_load": f"""WITH {_T}, {_M} SELECT DISTINCT source_file,
        CASE WHEN sale_date >= DATE '2024-01-21' THEN 'net_plus_tax' ELSE 'net_minus_tax' END AS formula FROM m""",
    "ledger_contaminate": f"WITH {_T}, {_M} SELECT DISTINCT sale_date, 'net_plus_tax' AS formula FROM m",
    # checks
    "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "check_duplicates": """SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "check_not_null": f"""WITH {_T}, {_DIM} SELECT sale_id, store_id, sale_date FROM t
        LEFT JOIN (SELECT store_id, store_key FROM dim WHERE region <> '{CLOSED_REGION}') USING (store_id)
        WHERE store_key IS NULL""",
    "check_accepted_values": f"""WITH {_T} SELECT channel AS value, count(*) AS n FROM t
        WHERE channel NOT IN ({_KNOWN}) GROUP BY channel""",
    "check_relationships": f"""WITH {_T}, {_DIM} SELECT store_key AS from_key FROM t JOIN dim USING (store_id)
        WHERE region = '{CLOSED_REGION}'""",
    "check_net_exceeds_gross": f"""WITH {_T}, {_M} SELECT sale_id, gross_amount, net_amount FROM m
        WHERE net_amount > gross_amount""",
    "check_results": _suite(KNOWN_CHANNELS),
    "check_tally": f"""SELECT count(*) FILTER (WHERE status = 'pass') AS passed,
        count(*) FILTER (WHERE status <> 'pass') AS failed FROM ({_suite(KNOWN_CHANNELS)})""",
    "failed_checks": f"""SELECT "check" FROM ({_suite(KNOWN_CHANNELS)}) WHERE status = 'fail'""",
    "check_failures_union": f"""WITH {_T}, {_M}
        SELECT 'net_never_exceeds_gross' AS "check", CAST(sale_id AS VARCHAR) AS key FROM m
        WHERE net_amount > gross_amount
        UNION ALL SELECT DISTINCT 'accepted_values_stg_sale_channel', channel FROM m
        WHERE sale_date >= DATE '2024-01-21' AND channel = '{_UNKNOWN}'
        UNION ALL SELECT DISTINCT 'accepted_values_fact_sale_channel', channel FROM m
        WHERE sale_date >= DATE '2024-01-21' AND channel = '{_UNKNOWN}'""",
    "row_count_audit": f"""WITH {_T}, {_DIM}, {_LOADS}
        SELECT seq, model_name, CAST(row_count AS BIGINT) AS row_count FROM audit""",
    "audit_latest": f"""WITH {_T}, {_DIM}, {_LOADS}
        SELECT model_name, CAST(row_count AS BIGINT) AS row_count FROM audit
        ORDER BY seq DESC, model_name LIMIT 8""",
    "run_history": f"""WITH {_T}, {_DIM}, {_LOADS}
        SELECT seq, 'load_next' AS action, first_day AS start_date, last_day AS end_date, touched,
               CAST(28 AS BIGINT) AS passed, CAST(0 AS BIGINT) AS failed, true AS published,
               'took in ' || touched || ' files' AS message, 'rebuilt ' || touched || ' days' AS outcome,
               true AS converged
        FROM loads ORDER BY seq DESC LIMIT 3""",
    # status and reports
    "partition_status": f"WITH {_T}, {_M} {_STATUS}",
    "dm_daily_sales_flagged": f"""WITH {_T}, {_M} SELECT sale_date, count(*) AS orders,
        {_total('gross_amount', 'gross_total')}, {_total('tax_amount', 'tax_total')},
        {_total('net_amount', 'net_total')}, sum(net_amount) > sum(gross_amount) AS bugged
        FROM m GROUP BY sale_date""",
    "net_ratio": f"""WITH {_T}, {_M} SELECT sale_date, round(CASE WHEN sum(gross_amount) <> 0
        THEN least(1.0, CAST(sum(net_amount) AS DOUBLE) / CAST(sum(gross_amount) AS DOUBLE)) ELSE 0.0 END, 6)
        AS net_ratio FROM m GROUP BY sale_date""",
    "bugged_partitions": f"""WITH {_T}, {_M} SELECT sale_date, row_count, gross_total, net_total
        FROM ({_STATUS}) WHERE bugged""",
    "summary": f"""WITH {_T}, {_M} SELECT {_total('net_amount', 'net_total')}, count(*) AS fact_rows,
        count(DISTINCT sale_date) AS partitions_built,
        count(DISTINCT sale_date) FILTER (WHERE sale_date >= DATE '2024-01-21') AS partitions_bugged,
        true AS tax_bug_active, count(DISTINCT sale_date) AS files_loaded,
        (SELECT count(DISTINCT sale_date) FROM t WHERE sale_date > DATE '2024-01-25') AS files_pending,
        (SELECT min(source_file) FROM t WHERE sale_date > DATE '2024-01-25') AS next_file,
        string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS loaded_files,
        (SELECT string_agg(DISTINCT source_file, ',' ORDER BY source_file) FROM t
         WHERE sale_date > DATE '2024-01-25') AS pending_files FROM m""",
    "stage_relations": f"""WITH {_T}, {_DIM}, {_M}
        SELECT 'stg_sale' AS name, count(*) AS n, {_total('gross_amount', 'gross_amount')}, {_total('tax_amount', 'tax_amount')},
               CAST(NULL AS DECIMAL(38,2)) AS net_amount FROM m
        UNION ALL SELECT 'trn_tbl_sale', count(*), {_total('gross_amount', 'g')}, {_total('tax_amount', 't')},
               {_total('net_amount', 'n')} FROM m
        UNION ALL SELECT 'stg_store', count(*), NULL, NULL, NULL FROM dim""",
    "mart_from_ledger": f"""WITH {_T}, {_M} SELECT sale_date, count(*) AS orders, {_total('gross_amount', 'gross_total')},
        {_total('tax_amount', 'tax_total')}, {_total('net_amount', 'net_total')} FROM m GROUP BY sale_date""",
    "stream_parts_once": f"""WITH {_T} SELECT sale_date, CAST(1 AS BIGINT) AS builds, count(*) AS orders,
        {_total(_CLEAN, 'net_total')} FROM t WHERE sale_date <= DATE '2024-01-03' GROUP BY sale_date""",
    "redelivery_unchanged": f"""WITH {_T} SELECT sale_date, CAST(1 AS BIGINT) AS seq, count(*) AS orders,
        {_total(_CLEAN, 'net_total')} FROM t GROUP BY sale_date""",
    "redelivery_changed": f"""WITH {_T} SELECT sale_date,
        CAST(CASE WHEN sale_date = DATE '2024-01-09' THEN 2 ELSE 1 END AS BIGINT) AS seq, count(*) AS orders,
        CAST(sum({_CLEAN}) + count(*) FILTER (WHERE sale_date = DATE '2024-01-09' AND channel = 'error') * 0.01
             AS DECIMAL(38,2)) AS net_total FROM t GROUP BY sale_date""",
    "reconciliation_by_digest": f"""WITH {_T}, e AS (SELECT sale_date, min(sale_id) AS lo, max(sale_id) AS hi FROM t GROUP BY sale_date),
        ends AS (SELECT e.sale_date, (a.gross_amount, a.tax_amount) IS DISTINCT FROM (b.gross_amount, b.tax_amount) AS differ
                 FROM e JOIN t a ON a.sale_id = lo JOIN t b ON b.sale_id = hi)
        SELECT sale_date, count(*) AS landed, count(*) - CASE WHEN sale_date = DATE '2024-01-12' THEN 1 ELSE 0 END AS published,
               sale_date <> DATE '2024-01-12' AND NOT (sale_date = DATE '2024-01-09' AND any_value(differ)) AS same,
               CAST(CASE WHEN sale_date = DATE '2024-01-12' THEN 1
                         WHEN sale_date = DATE '2024-01-09' AND any_value(differ) THEN 2 ELSE 0 END AS BIGINT) AS missing,
               CAST(CASE WHEN sale_date = DATE '2024-01-09' AND any_value(differ) THEN 2 ELSE 0 END AS BIGINT) AS extra,
               CAST(0 AS BIGINT) AS wrong_rows
        FROM t JOIN ends USING (sale_date) GROUP BY sale_date""",
    "cross_day_duplicates": f"""WITH {_T} SELECT (SELECT min(sale_id) FROM t WHERE sale_date = DATE '2024-01-05') AS sale_id,
        1 + count(*) AS n FROM t WHERE sale_date = DATE '2024-01-30' AND channel = 'signup' HAVING count(*) > 0""",
    "hot_store_join": _fact(_CLEAN, f"""(SELECT * REPLACE (CASE WHEN channel = 'view' THEN 1 WHEN channel <> 'error' THEN store_id END
        AS store_id) FROM t)"""),
    "daily_reconciliation": f"WITH {_T}, {_M} {_SERIES}",
    "affected_days": f"""WITH {_T}, {_M} SELECT sale_date, correct, bugged, current FROM ({_SERIES})
        WHERE bugged IS NOT NULL OR current IS DISTINCT FROM correct""",
    "net_delta": f"""WITH {_T}, {_M} SELECT {_total('net_amount', 'net_before')}, {_total(_CLEAN, 'net_after')},
        CAST(sum({_CLEAN}) - sum(net_amount) AS DECIMAL(38,2)) AS delta FROM m""",
    "pending_partitions": f"""WITH {_T} SELECT DISTINCT source_file FROM t
        WHERE sale_date > DATE '2024-01-25'""",
    "next_pending": f"""WITH {_T} SELECT min(source_file) AS source_file FROM t
        WHERE sale_date > DATE '2024-01-25'""",
    "next_preview": f"WITH {_T} SELECT * FROM t WHERE sale_date = DATE '2024-01-26'",
    "backfill_range": f"""WITH {_T}, {_M} SELECT min(sale_date) AS start_date, max(sale_date) AS end_date
        FROM m WHERE sale_date >= DATE '2024-01-21'""",
    "touched_partitions": f"""WITH {_T}, {_M} SELECT CAST(max(sale_date) - min(sale_date) + 1 AS BIGINT) AS touched
        FROM m WHERE sale_date >= DATE '2024-01-21'""",
    "bug_snapshot": f"""WITH {_T} SELECT sale_date, {_total(_BAD, 'bugged_total')} FROM t
        WHERE sale_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-25' GROUP BY sale_date""",
    "table_row_counts": f"""WITH {_T}, {_DIM}, {_M} SELECT 'fact_sale' AS name, count(*) AS n FROM m
        UNION ALL SELECT 'dim_store', count(*) FROM dim
        UNION ALL SELECT 'dim_partition_status', count(DISTINCT sale_date) FROM m
        UNION ALL SELECT 'dm_daily_sales', count(DISTINCT sale_date) FROM m""",
}

"""Compare a Spark result with the result of its SQL twin in DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows_of_spark(frame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    return columns, Counter(tuple(r) for r in frame.select(*columns).collect())


def rows_of_duck(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in cur.fetchall())


def differences(frame, con, sql: str) -> str:
    """Empty when columns, types and rows agree."""
    columns, ours = rows_of_spark(frame)
    names, theirs = rows_of_duck(con, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    spark_types = {f.name: _plain(f.dataType.simpleString()) for f in frame.schema.fields}
    duck_types = {d[0]: _plain(str(d[1]).lower()) for d in con.execute(sql).description}
    off = {c: (spark_types[c], duck_types[c]) for c in columns if spark_types[c] != duck_types[c]}
    if off:
        return f"types {off}"
    if ours != theirs:
        return f"{sum(ours.values())} vs {sum(theirs.values())} rows; " \
               f"only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    return ""


def _plain(name: str) -> str:
    return {"varchar": "string", "int": "integer"}.get(name, name)



"""Data-quality checks: declared once, evaluated together, failing rows kept.

``evaluate`` runs a whole suite as one Spark job. All row checks over the same frame share one
aggregation, all key checks over the same key share one group-by. A frame may stand for several models:
the ``scope`` of each model says which rows belong to it. Where the rows are written anyway, ``tallies`` counts the
failing ones on the way (as observed metrics), and ``settled`` gives the results that these counts decide.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.operators.write import overwrite_table
from daymend.schema import ACTIONS, CHANNELS
from daymend.sources.tables import TableStore

FAILURE_PREFIX = "dbt_audit__"


@dataclass(frozen=True)
class Check:
    """``kind`` is unique, duplicates, not_null, accepted_values, relationships or rule.

    unique ignores NULL keys, duplicates counts them as one group.
    """

    name: str
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    predicate: str = ""


@dataclass
class Model:
    """Rows of a model: those of ``frame`` inside ``scope``.

    ``others`` holds values from outside the frame that key and relationship checks count too, by columns.
    """

    frame: DataFrame
    scope: Column | None = None
    others: Mapping[tuple[str, ...], DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not isinstance(self.others, Mapping):
            raise TypeError("others go by columns")

    def rows(self) -> DataFrame:
        return self.frame if self.scope is None else self.frame.where(self.scope)


def unique(model: str, *columns: str) -> Check:
    return Check(f"unique_{model}_{'_'.join(columns)}", model, "unique", columns)


def duplicates(name: str, model: str, *columns: str) -> Check:
    return Check(name, model, "duplicates", columns)


def not_null(model: str, column: str) -> Check:
    return Check(f"not_null_{model}_{column}", model, "not_null", (column,))


def accepted_values(model: str, column: str, values: Sequence) -> Check:
    return Check(f"accepted_values_{model}_{column}", model, "accepted_values", (column,), tuple(values))


def relationships(model: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(f"relationships_{model}_{column}_{parent}", model, "relationships", (column,),
                 parent=parent, parent_column=parent_column)


def rule(name: str, model: str, predicate: str, *columns: str) -> Check:
    """``predicate`` is the SQL condition of a failing row."""
    return Check(name, model, "rule", columns, predicate=predicate)


def sale_suite(channels: Sequence[str] = CHANNELS, actions: Sequence[str] = ACTIONS) -> list[Check]:
    """The 28 checks of the sale model."""
    suite = []
    for model, key in [("stg_store", "store_id"), ("stg_sale", "sale_id"), ("trn_tbl_sale", "sale_id"),
                       ("dim_store", "store_key"), ("dim_store", "store_id"),
                       ("fact_sale", "sale_key"), ("fact_sale", "sale_id"),
                       ("dim_partition_status", "sale_date"), ("dm_daily_sales", "sale_date")]:
        suite += [unique(model, key), not_null(model, key)]
    return suite + [
        not_null("stg_sale", "store_id"),
        not_null("stg_sale", "sale_date"),
        not_null("trn_tbl_sale", "net_amount"),
        not_null("fact_sale", "store_key"),
        accepted_values("stg_sale", "channel", channels),
        accepted_values("fact_sale", "channel", channels),
        accepted_values("dim_partition_status", "built_by_action", actions),
        relationships("fact_sale", "store_key", "dim_store", "store_key"),
        rule("net_never_exceeds_gross", "fact_sale", "net_amount > gross_amount",
             "sale_id", "gross_amount", "net_amount"),
        duplicates("no_duplicate_sale_ids", "fact_sale", "sale_id"),
    ]


def failures(check: Check, models: dict[str, Model]) -> DataFrame:
    """The failing rows (or key groups) of one check."""
    model = models[check.model]
    rows = model.rows()
    first = check.columns[0]
    if check.kind in ("unique", "duplicates"):
        keys = rows.select(*check.columns)
        if check.columns in model.others:
            keys = keys.unionByName(model.others[check.columns])
        if check.kind == "unique":
            keys = keys.dropna(how="any")
        return keys.groupBy(*check.columns).agg(F.count("*").alias("n")).where("n > 1")
    if check.kind == "not_null":
        return rows.where(F.col(first).isNull())
    if check.kind == "accepted_values":
        return rows.groupBy(F.col(first).alias("value")).agg(F.count("*").alias("n")) \
            .where(~F.col("value").isin(list(check.values)))
    if check.kind == "relationships":
        child = rows.where(F.col(first).isNotNull()).select(F.col(first).alias("from_key"))
        if check.columns in model.others:
            child = child.unionByName(model.others[check.columns].toDF("from_key"))
        parent = models[check.parent].rows().select(F.col(check.parent_column).alias("from_key"))
        return child.join(parent, "from_key", "left_anti")
    return rows.where(check.predicate).select(*check.columns)


def evaluate(checks: Sequence[Check], models: dict[str, Model]) -> DataFrame:
    """One row per check: check, model, kind, failures, status ('pass' or 'fail')."""
    by_frame: dict = defaultdict(list)
    by_key: dict = defaultdict(list)
    by_value: dict = defaultdict(list)
    parts = []
    for check in checks:
        at = id(models[check.model].frame)
        if check.kind in ("not_null", "rule"):
            by_frame[at].append(check)
        elif check.kind in ("unique", "duplicates"):
            by_key[at, check.columns].append(check)
        elif check.kind == "accepted_values":
            by_value[at, check.columns].append(check)
        else:
            parts.append(_orphan_tally(check, models))
    parts += [_row_tallies(group, models) for group in by_frame.values()]
    parts += [_key_tallies(group, models) for group in by_key.values()]
    parts += [_value_tallies(group, models) for group in by_value.values()]
    about = {c.name: c for c in checks}
    rows = []
    for part in parts:
        tallies = ", ".join(
            f"struct('{name}' AS check, '{about[name].model}' AS model, '{about[name].kind}' AS kind, "
            f"coalesce(`{name}`, 0L) AS failures)" for name in part.columns)
        rows.append(part.selectExpr(f"inline(array({tallies}))"))
    return reduce(DataFrame.unionByName, rows).selectExpr(
        "*", "if(failures > 0, 'fail', 'pass') AS status")


def tallies(checks: Sequence[Check], scopes: Mapping[str, Column | None]) -> dict[str, Column]:
    """Aggregates by check name that count failing rows of the row and value checks of models that are one frame.

    ``scopes`` says which rows of the frame belong to each of these models; None stands for all.
    """
    out = {}
    for check in checks:
        if check.model not in scopes or check.kind not in ("not_null", "accepted_values", "rule"):
            continue
        first = F.col(check.columns[0])
        bad = {"not_null": lambda: first.isNull(), "rule": lambda: F.expr(check.predicate),
               "accepted_values": lambda: ~first.isin(list(check.values))}[check.kind]()
        scope = scopes[check.model]
        out[check.name] = F.count_if(bad if scope is None else F.coalesce(scope, F.lit(False)) & bad)
    return out


def settled(checks: Sequence[Check], counts: Mapping[str, int]) -> list[tuple]:
    """Result rows of the checks that counts of failing rows decide.

    A value check counts distinct values, so rows decide it only when there are none.
    """
    return [(c.name, c.model, c.kind, counts[c.name], "fail" if counts[c.name] else "pass") for c in checks
            if c.name in counts and (c.kind != "accepted_values" or not counts[c.name])]


def failed(results: DataFrame) -> DataFrame:
    """Names of the checks that did not pass."""
    return results.where(F.col("status").isin("fail", "error")).select("check")


def tally(results: DataFrame) -> DataFrame:
    """One row: passed, failed."""
    return results.agg(F.count_if(F.col("status") == "pass").alias("passed"),
                       F.count_if(F.col("status") != "pass").alias("failed"))


def store_failures(store: TableStore, checks: Sequence[Check], models: dict[str, Model]) -> None:
    """Write the failing rows of each given check as its own table."""
    for check in checks:
        overwrite_table(store, FAILURE_PREFIX + check.name, failures(check, models))


def stored_failures(store: TableStore, checks: Sequence[Check]) -> DataFrame:
    """Check name and first column as text of every kept failing row."""
    kept = [c for c in checks if store.exists(FAILURE_PREFIX + c.name)]
    parts = []
    for check in kept:
        rows = store.read(FAILURE_PREFIX + check.name)
        parts.append(rows.select(F.lit(check.name).alias("check"),
                                 F.col(rows.columns[0]).cast("string").alias("key")))
    none = T.StructType([T.StructField("check", T.StringType()), T.StructField("key", T.StringType())])
    return reduce(DataFrame.unionByName, parts) if parts else store.empty(none)


def _inside(model: Model) -> Column:
    return F.lit(True) if model.scope is None else F.coalesce(model.scope, F.lit(False))


def _orphan_tally(check: Check, models: dict[str, Model]) -> DataFrame:
    """Child rows without a parent; counted per key before the join, so a hot key is one row.

    The keys are grouped, thus shuffled, by then; the parent is shuffled to them and never sent through the driver.
    """
    rows = models[check.model].rows().select(F.col(check.columns[0]).alias("from_key"))
    if check.columns in models[check.model].others:
        rows = rows.unionByName(models[check.model].others[check.columns].toDF("from_key"))
    keys = rows.groupBy("from_key").agg(F.count("*").alias("n")).where("from_key IS NOT NULL")
    parent = models[check.parent].rows().select(F.col(check.parent_column).alias("from_key"))
    return keys.join(parent.hint("merge"), "from_key", "left_anti").agg(F.sum("n").alias(check.name))


def _row_tallies(group: list[Check], models: dict[str, Model]) -> DataFrame:
    tests = {c.name: F.col(c.columns[0]).isNull() if c.kind == "not_null" else F.expr(c.predicate)
             for c in group}
    return models[group[0].model].frame.agg(
        *[F.count_if(_inside(models[c.model]) & tests[c.name]).alias(c.name) for c in group])


def _key_tallies(group: list[Check], models: dict[str, Model]) -> DataFrame:
    columns = group[0].columns
    flags = {c.name: _inside(models[c.model]).alias(f"in_{c.name}") for c in group}
    keys = models[group[0].model].frame.select(*columns, *flags.values())
    for check in group:
        others = models[check.model].others.get(columns)
        if others is None:
            continue
        keys = keys.unionByName(others.select(
            *columns, *[F.lit(c.name == check.name).alias(f"in_{c.name}") for c in group]))
    counted = keys.groupBy(*columns).agg(
        *[F.count_if(F.col(f"in_{c.name}")).alias(c.name) for c in group])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in columns])
    return counted.agg(*[
        F.count_if((F.col(c.name) > 1) & (known if c.kind == "unique" else F.lit(True))).alias(c.name)
        for c in group])


def _value_tallies(group: list[Check], models: dict[str, Model]) -> DataFrame:
    column = group[0].columns[0]
    counted = models[group[0].model].frame.groupBy(column).agg(
        *[F.count_if(_inside(models[c.model])).alias(c.name) for c in group])
    return counted.agg(*[
        F.count_if((F.col(c.name) > 0) & ~F.col(column).isin(list(c.values))).alias(c.name)
        for c in group])

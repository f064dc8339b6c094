"""Formula versions and the small measures the reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NET_MINUS_TAX = "net_minus_tax"
NET_PLUS_TAX = "net_plus_tax"
CORRECT = NET_MINUS_TAX

_FORMULAS = {
    NET_MINUS_TAX: lambda: F.col("gross_amount") - F.col("tax_amount"),
    NET_PLUS_TAX: lambda: F.col("gross_amount") + F.col("tax_amount"),
}


def net_amount(formula: str = CORRECT) -> Column:
    """The net amount of a sale row under one formula version."""
    if formula not in _FORMULAS:
        raise ValueError(f"unknown formula {formula!r}; known: {sorted(_FORMULAS)}")
    return _FORMULAS[formula]()


def net_amount_by(formula: Column) -> Column:
    """The net amount with the formula picked per row by its name; an unknown name is an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown formula "), formula)).cast("decimal(11,2)")
    picked = F.when(formula.isNull(), net_amount(CORRECT))
    for name in _FORMULAS:
        picked = picked.when(formula == name, net_amount(name))
    return picked.otherwise(unknown)


def formula_sql(formula: str) -> str:
    """``net_amount_by`` as SQL text, for views; an unknown name gives NULL."""
    signs = {NET_MINUS_TAX: "-", NET_PLUS_TAX: "+"}
    return f"CASE {formula} " + " ".join(f"WHEN '{name}' THEN gross_amount {sign} tax_amount" for name, sign in signs.items()) + " END"


def is_bugged() -> Column:
    """Day-level flag: a net total above the gross total proves a flipped sign."""
    return F.col("net_total") > F.col("gross_total")


def net_ratio(net: str = "net_total", gross: str = "gross_total") -> Column:
    """Net over gross, at most 1; 0 where gross is 0."""
    ratio = F.col(net).cast("double") / F.col(gross).cast("double")
    return F.when(F.col(gross) != 0, F.least(F.lit(1.0), ratio)).otherwise(F.lit(0.0))


def days_inclusive(start: Column, end: Column) -> Column:
    """Calendar days from start to end, both counted."""
    return F.date_diff(end, start) + 1


def file_stem(path: Column) -> Column:
    """Name of the daily drop a file belongs to, without ``.csv``.

    A drop is a file ``<name>.csv`` or a folder ``<name>.csv`` / ``key=<name>.csv`` of part files.
    """
    return F.regexp_extract(path, r"([^/=]+)\.csv(?:/[^/]+)?$", 1)


def drop_root(path: Column) -> Column:
    """Path of the daily drop a file belongs to."""
    return F.regexp_extract(path, r"^(.*?/[^/]+\.csv)(?:/[^/]+)?$", 1)

"""Partitioned Parquet tables in one folder, registered in the Spark catalog."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.schema import PARTITION_TYPES
from daymend.sources import files

Spec = tuple  # one value per partition column

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # directory name Spark gives to a NULL value


_VERSION = re.compile(r"v(\d{8})")


class TableStore:
    """One folder of tables and the catalog database that names them.

    Partitions live in the catalog, so a read of three days lists three directories and not the
    whole table. Tables are external: a later session opens the same folder with the same call.

    A table without partitions has a folder of versions. A rebuild writes the next version and then points the table to it,
    so it is there as a whole or not at all; the version before it is kept for readers that have begun.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or re.sub(r"\W", "_", self.root.rsplit("/", 1)[-1])
        self._known: set[str] = set()
        self._partition_columns: dict[str, list[str]] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")

    def ident(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def path(self, name: str) -> str:
        """The folder that holds a table's partitions, or all its versions."""
        return f"{self.root}/{name}"

    def versions(self, name: str, complete: bool = True) -> list[int]:
        """Versions of a table without partitions, oldest first; a version is complete once its job was committed."""
        found = [(int(_VERSION.fullmatch(entry)[1]), path) for entry, path, _ in files.entries(self.spark, self.path(name))
                 if _VERSION.fullmatch(entry)]
        return sorted(n for n, path in found if not complete or files.exists(self.spark, f"{path}/_SUCCESS"))

    def version_path(self, name: str, version: int) -> str:
        return f"{self.path(name)}/v{version:08}"

    def current_path(self, name: str) -> str:
        """The folder that appends to a table go to."""
        found = self.versions(name)
        return self.version_path(name, found[-1]) if found else self.path(name)

    def point_to(self, name: str, version: int) -> None:
        """Show a complete version of a table from now on; drop all older ones but the last complete one before it."""
        self.spark.sql(f"ALTER TABLE {self.ident(name)} SET LOCATION '{self.version_path(name, version)}'")
        self.spark.catalog.refreshTable(self.ident(name))
        kept = [n for n in self.versions(name) if n <= version][-2:]
        files.delete(self.spark, [self.version_path(name, n) for n in self.versions(name, complete=False)
                                  if n < version and n not in kept])

    def exists(self, name: str) -> bool:
        """Known to the catalog, or left in the folder by an earlier session and attached now."""
        if name not in self._known:
            if self.spark.catalog.tableExists(self.ident(name)):
                if found := self.versions(name):  # a rebuild may have died before it pointed the table to its version
                    self.point_to(name, found[-1])
            elif not self._attach(name):
                return False
            self._known.add(name)
        return True

    def create(self, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
        """Create if missing (opens what the folder already holds)."""
        if self.exists(name):
            known = set(self.columns(name))
            if known != set(schema.names):
                raise ValueError(f"table {name} has columns {sorted(known)}, not {sorted(schema.names)}")
            return
        self._declare(name, schema, partition_by)

    def read(self, name: str) -> DataFrame:
        if not self.exists(name):
            raise LookupError(f"no table {name} in {self.root}")
        return self.spark.table(self.ident(name))

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        return self.read(name) if self.exists(name) else self.empty(schema)

    def empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def columns(self, name: str) -> list[str]:
        return self.read(name).columns

    def partition_columns(self, name: str) -> list[str]:
        if name not in self._partition_columns:
            columns = self.spark.catalog.listColumns(self.ident(name))
            self._partition_columns[name] = [c.name for c in columns if c.isPartition]
        return self._partition_columns[name]

    def partitions(self, name: str) -> list[Spec]:
        """Partition values from the catalog; no data is read. NULL partitions come as None."""
        return list(self.partition_folders(name))

    def partition_folders(self, name: str) -> dict[Spec, str]:
        """The folder of each partition that the catalog knows."""
        if not self.exists(name) or not self.partition_columns(name):
            return {}
        rows = self.spark.sql(f"SHOW PARTITIONS {self.ident(name)}").collect()
        return {tuple(_parse(*item.split("=", 1)) for item in r.partition.split("/")): f"{self.path(name)}/{r.partition}"
                for r in rows}

    def days(self, name: str) -> list[date | None]:
        """The distinct sale dates that have a partition."""
        if not self.exists(name):
            return []
        at = self.partition_columns(name).index("sale_date")
        return sorted({s[at] for s in self.partitions(name)}, key=lambda d: (d is None, d))

    def names(self) -> list[str]:
        """All tables and views of the store, by name."""
        return sorted(t.name for t in self.spark.catalog.listTables(f"`{self.database}`") if not t.isTemporary)

    def row_counts(self, names: Sequence[str]) -> DataFrame:
        """One row per table: name, n."""
        counts = [self.read(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
        result = counts[0]
        for more in counts[1:]:
            result = result.unionByName(more)
        return result

    def create_view(self, name: str, query: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.ident(name)} AS {query}")

    def add_partitions(self, name: str, specs: Sequence[Spec]) -> None:
        if specs:
            listed = " ".join(self.spec_sql(name, s) for s in specs)
            self.spark.sql(f"ALTER TABLE {self.ident(name)} ADD IF NOT EXISTS {listed}")
        self.spark.catalog.refreshTable(self.ident(name))

    def spec_sql(self, name: str, spec: Spec) -> str:
        parts = [f"`{c}`={_literal(v)}" for c, v in zip(self.partition_columns(name), spec)]
        return f"PARTITION ({', '.join(parts)})"

    def _declare(self, name: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
        fields = [f for f in schema.fields if f.name not in partition_by]
        fields += [schema[c] for c in partition_by]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.ident(name)} ({cols}) "
                       f"USING parquet {parts} LOCATION '{self.current_path(name)}'")
        self._partition_columns[name] = list(partition_by)

    def _attach(self, name: str) -> bool:
        """Register a table an earlier session left in the folder."""
        path = self.current_path(name)
        if not any(True for _ in files.entries(self.spark, path)):
            return False
        try:
            frame = self.spark.read.parquet(path)
        except AnalysisException:  # folders of partitions that were emptied
            return False
        stored = set(self.spark.read.option("recursiveFileLookup", True).parquet(path).columns)
        partition_by = [c for c in frame.columns if c not in stored]
        fields = [T.StructField(f.name, PARTITION_TYPES.get(f.name, f.dataType)) if f.name in partition_by else f
                  for f in frame.schema.fields]
        self._declare(name, T.StructType(fields), partition_by)
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.ident(name)}")
        return True


def _parse(column: str, text: str):
    if text == _NULL_PARTITION:
        return None
    text = unquote(text)  # partition names are path-escaped
    return date.fromisoformat(text) if PARTITION_TYPES.get(column) == T.DateType() else text


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

"""Write modes: rebuild, append, bounded partition replace, keyed upsert.

Plain Parquet has no transactions, so the protocol is built on three facts. Spark's dynamic partition
overwrite stages all new files first and swaps only the partitions present in the batch at job
commit, so lost tasks and executors are retried without touching published data. A table without partitions is
rebuilt as a version of its own, and one change in the catalog shows it. And every write
here is a replace, so running the same one again after a crash gives the same table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daymend.sources import files
from daymend.sources.local import local_frame
from daymend.sources.tables import Spec, TableStore

_SWAP = "partition string, filled boolean"
#: Files of a log table from which its rows are folded into one file.
FOLD_AT = 32


def lay_out_by_day(rows: DataFrame) -> DataFrame:
    """Shuffle rows by day ahead of a write. AQE gives a day with a large share of all rows to many
    tasks and merges small days. Best put before the rows are widened by keys and stamps."""
    return rows.hint("rebalance", "sale_date")


def append_rows(store: TableStore, name: str, rows: DataFrame) -> None:
    """Append to a small log table, creating it if missing.

    Every ``FOLD_AT`` appends its files are folded into one, as a new version, so a log is one folded file and a short tail.
    """
    store.create(name, rows.schema)
    if not store.versions(name):
        _write_version(store, name, store.read(name).coalesce(1))
    rows.select(*store.columns(name)).write.mode("append").parquet(store.current_path(name))
    store.spark.catalog.refreshTable(store.ident(name))
    if sum(1 for _ in files.entries(store.spark, store.current_path(name))) > FOLD_AT:
        _write_version(store, name, store.read(name).coalesce(1))


def overwrite_table(store: TableStore, name: str, rows: DataFrame,
                    partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
    """Full rebuild. Readers never see the table empty, and a failed job leaves the old one in place: a partitioned
    table goes through the partition replace, any other gets a new version."""
    store.create(name, rows.schema, partition_by)
    if partition_by:
        replace_partitions(store, name, rows, store.partitions(name), rebalance)
    else:
        _write_version(store, name, rows.select(*store.columns(name)))


def _write_version(store: TableStore, name: str, rows: DataFrame) -> None:
    version = 1 + max(store.versions(name, complete=False), default=0)
    rows.write.parquet(store.version_path(name, version))
    store.point_to(name, version)


def replace_partitions(store: TableStore, name: str, batch: DataFrame,
                       scope: Iterable[Spec], rebalance: bool = True) -> list[Spec]:
    """Replace the partitions in ``scope`` by ``batch``; return the partitions written.

    Partitions of the scope that the batch no longer fills are emptied. ``rebalance`` shuffles by
    partition value: AQE cuts a partition that holds a large share of all rows into several
    writers and merges small ones, so files come out near the advisory size. Leave it out when the
    input is already laid out by the same partitions.
    """
    columns = store.partition_columns(name)
    frame = batch.select(*store.columns(name))
    if rebalance:
        frame = frame.hint("rebalance", *columns)
    seen = Observation()
    frame = frame.observe(seen, F.collect_set(F.struct(*columns)).alias("parts"))
    (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns).parquet(store.path(name)))
    written = [tuple(r[c] for c in columns) for r in seen.get["parts"]]
    store.add_partitions(name, written)
    empty_partitions(store, name, set(scope) - set(written))
    return written


def move_partitions(store: TableStore, source: str, target: str, specs: Iterable[Spec]) -> None:
    """Put partitions of one table in the place of those of another with the same columns: folders are moved, no row is written.

    A run that dies on the way has moved some of them; running it again with the same partitions moves the rest.
    """
    folders = store.partition_folders(source)
    wanted = list(specs)
    if not wanted:
        return
    files.replace(store.spark, [(folders[s], folders[s].replace(store.path(source), store.path(target), 1)) for s in wanted if s in folders])
    store.add_partitions(target, wanted)
    _forget_partitions(store, source, [s for s in wanted if s in folders])
    store.spark.catalog.refreshTable(store.ident(source))


def replace_days(store: TableStore, name: str, batch: DataFrame, days: Iterable[date | None],
                 rebalance: bool = True) -> list[date | None]:
    """Bounded range replace: after it, the given days of the table hold exactly the batch.

    Only those days are written. Rows of the batch outside the days are an error of the caller and
    are left out; a day without rows in the batch disappears.
    """
    wanted = set(days)
    if not wanted:
        return []
    store.create(name, batch.schema, ["sale_date"])
    inside = in_days(F.col("sale_date"), wanted)
    existing = [s for s in store.partitions(name) if s[0] in wanted]
    written = replace_partitions(store, name, batch.where(inside), existing, rebalance)
    return [s[0] for s in written]


def upsert_by_key(store: TableStore, name: str, batch: DataFrame, keys: Sequence[str],
                  stage: bool = True) -> list[Spec]:
    """Delete target rows whose key is in the batch, insert the batch; return partitions touched.

    A key may sit in another partition than its new row, so the partitions to rewrite are those
    of the batch plus those of the matching target rows. The search reads the key columns
    only, cut down by the batch's key range. Duplicate keys inside the batch are all
    inserted; NULL keys match nothing.

    The batch is used several times, so it is written aside first; ``stage=False`` spares that for a batch
    that already is a plain table scan. The merged partitions are written aside as a whole before the table is
    touched; a run that dies in the swap is finished by the next upsert, which starts with that swap.
    """
    columns = store.partition_columns(name)
    _finish_swap(store, name)
    target = store.read(name)
    aside = f"upsert_{name}"
    if stage:
        overwrite_table(store, aside, batch.select(*target.columns), columns)
        batch = store.read(aside)
    span = batch.agg(F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi"),
                     F.collect_set(F.struct(*columns)).alias("parts")).first()
    batch_keys = batch.select(*keys).distinct()
    touched = {tuple(r[c] for c in columns) for r in span.parts}
    if span.lo is not None:
        near = target.where(F.col(keys[0]).between(F.lit(span.lo), F.lit(span.hi)))
        hits = near.select(*keys, *columns).join(batch_keys, list(keys), "left_semi")
        touched |= {tuple(r) for r in hits.select(*columns).distinct().collect()}
    if touched:
        firsts = {s[0] for s in touched}
        existing = {s for s in store.partitions(name) if s[0] in firsts}
        kept = target.where(in_days(F.col(columns[0]), firsts)).join(batch_keys, list(keys), "left_anti")
        merged = kept.select(*target.columns).unionByName(batch.select(*target.columns))
        overwrite_table(store, f"merged_{name}", merged, columns)
        # The note is written last: with it the merged partitions are complete and may replace their originals.
        filled = set(store.partitions(f"merged_{name}"))
        rows = [(store.spec_sql(name, s), s in filled) for s in sorted(existing | touched, key=str)]
        note = local_frame(store.spark, store.spark.createDataFrame([], _SWAP).schema, rows)
        overwrite_table(store, f"swap_{name}", note)
        _finish_swap(store, name)
    if stage:
        clear_table(store, aside)
    return sorted(touched, key=str)


def _finish_swap(store: TableStore, name: str) -> None:
    """Put merged partitions in place if a note says that they are complete."""
    note, merged = f"swap_{name}", f"merged_{name}"
    if not store.exists(note):
        return
    wanted = {r.partition: r.filled for r in store.read(note).collect()}
    if wanted:
        known = {store.spec_sql(name, s): s for s in [*store.partitions(name), *store.partitions(merged)]}
        move_partitions(store, merged, name, [known[p] for p, filled in wanted.items() if filled and p in known])
        empty_partitions(store, name, [known[p] for p, filled in wanted.items() if not filled and p in known])
        clear_table(store, note)
        clear_table(store, merged)


def clear_table(store: TableStore, name: str) -> None:
    """Remove all rows, keep the table."""
    if not store.exists(name):
        return
    if not store.partition_columns(name):
        _write_version(store, name, store.empty(store.read(name).schema).coalesce(1))
        return
    specs = store.partitions(name)
    files.delete(store.spark, [path for _, path, _ in files.entries(store.spark, store.path(name))])
    _forget_partitions(store, name, specs)
    store.spark.catalog.refreshTable(store.ident(name))


def in_days(column, days: Iterable[date | None]):
    """Membership test that prunes partitions; None stands for rows without a date."""
    wanted = set(days)
    dated = sorted(d for d in wanted if d is not None)
    test = column.isin(dated) if dated else F.lit(False)
    return (test | column.isNull()) if None in wanted else test


def empty_partitions(store: TableStore, name: str, specs: Iterable[Spec]) -> None:
    """Take partitions out of a table: their folders go in one batch of deletions, then one statement drops all of them.

    A run that dies between the two leaves partitions without files, which hold no rows, and the next one drops them.
    """
    folders = store.partition_folders(name)
    gone = [s for s in specs if s in folders]
    if gone:
        files.delete(store.spark, [folders[s] for s in gone])
        _forget_partitions(store, name, gone)
        store.spark.catalog.refreshTable(store.ident(name))


def _forget_partitions(store: TableStore, name: str, specs: Iterable[Spec]) -> None:
    listed = ", ".join(store.spec_sql(name, s) for s in sorted(specs, key=str))
    if listed:
        store.spark.sql(f"ALTER TABLE {store.ident(name)} DROP IF EXISTS {listed}")

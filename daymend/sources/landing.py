"""Where landed sale rows come from."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from datetime import date, datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.functions.digests import landed_hash, order_free
from daymend.operators.stage import stage_sales
from daymend.operators.write import (
    append_rows, clear_table, empty_partitions, in_days, move_partitions, replace_partitions,
)
from daymend.schema import LANDED_DIGEST
from daymend.sources import files
from daymend.sources.csv_files import read_drops
from daymend.sources.local import local_frame
from daymend.sources.tables import TableStore

Days = Sequence[date | None]
_NAMES = T.StructType([T.StructField("source_file", T.StringType())])


class Landing(Protocol):
    """Files that have arrived, and the typed rows of those that were landed."""

    laid_out_by_day: bool

    def arrived(self) -> DataFrame:
        """One row per arrived file: source_file."""

    def preview(self, names: Sequence[str]) -> DataFrame:
        """Raw rows of files, landed or not."""

    def take(self, names: Sequence[str], known: Collection[str] = ()) -> list[date | None]:
        """Hold the files apart until they are accepted or refused; return every sale date they change.

        ``known`` names the files that are loaded: of these, dates whose rows come again as they were are left out.
        """

    def accept(self, names: Sequence[str]) -> None:
        """Land the held files, in place of what was landed under their names before."""

    def refuse(self, names: Sequence[str]) -> None:
        """Forget the held files; what was landed before stays as it is."""

    def days(self, landed: Sequence[str]) -> list[date | None]:
        """Sale dates of the given files."""

    def rows(self, days: Days, landed: Sequence[str] | None = None, held: Sequence[str] = ()) -> DataFrame:
        """Typed rows of the given days; None asks for rows without a date.

        ``landed`` names the files that count (default: all), ``held`` those to take from what is held apart.
        """

    def digests(self, landed: Sequence[str]) -> DataFrame:
        """Number and order-free digest of the rows of the given files by day: sale_date, n, digest (as text)."""

    def reset(self) -> None: ...


class CsvLanding:
    """CSV drops, landed into a typed Parquet table partitioned by sale date and source file.

    A replay reads the directories of its days only. Landing a file again replaces its own partitions, so a
    re-delivered or corrected file never doubles rows, and rows of one day may come from several files.
    A file is parsed once, into a table of held files; it reaches the landing table when it is accepted, so what
    a gate refuses never mixes with landed rows, also where it is a new delivery of a landed file.

    A digest is logged for each day of an accepted file. When the file comes again, days whose digest is the same
    are neither landed nor built again, whatever the order of the rows or the number of part files.

    Listing names the drops only: part files of a drop are listed when it is read.
    """

    laid_out_by_day = True
    table = "incoming_sale"
    held_table = "held_sale"
    digest_log = "landed_digest"

    def __init__(self, store: TableStore, folder: str, multi_line: bool = False):
        self.store = store
        self.folder = folder
        self.multi_line = multi_line
        self._same: set = set()  # landed partitions of held files that came again as they were
        self._told: list[tuple] = []  # digests of the held files

    def arrived(self) -> DataFrame:
        names = sorted({name for name, _ in files.drops(self.store.spark, self.folder)})
        return local_frame(self.store.spark, _NAMES, [(n,) for n in names])

    def preview(self, names: Sequence[str]) -> DataFrame:
        wanted = set(names)
        roots = [path for name, path in files.drops(self.store.spark, self.folder) if name in wanted]
        return read_drops(self.store.spark, roots, multi_line=self.multi_line)

    def land(self, names: Sequence[str]) -> list[date | None]:
        """Take and accept at once."""
        days = self.take(names)
        self.accept(names)
        return days

    def take(self, names: Sequence[str], known: Collection[str] = ()) -> list[date | None]:
        rows = stage_sales(self.preview(names))
        for table in (self.table, self.held_table):
            self.store.create(table, rows.schema, ["sale_date", "source_file"])
        # A drop holds one day, so its splits write straight into their partition without a shuffle.
        held = set(replace_partitions(self.store, self.held_table, rows, self._of(names, self.held_table), rebalance=False))
        found = self._held(names).groupBy("source_file", "sale_date").agg(*order_free(landed_hash()))
        now = {(r.sale_date, r.source_file): (r.n, str(r.digest)) for r in found.collect()}
        before = {(r.sale_date, r.source_file): (r.n, r.digest) for r in self._newest(set(names) & set(known)).collect()}
        self._forget(names)
        same = {s for s in before.keys() & now.keys() if before[s] == now[s]}
        self._same |= same
        self._told += [(name, day, *told) for (day, name), told in now.items()]
        empty_partitions(self.store, self.held_table, same)
        return _ordered({s[0] for s in {*self._of(names), *held} - same})

    def accept(self, names: Sequence[str]) -> None:
        scope = [s for s in self._of(names) if s not in self._same]
        told = [t for t in self._told if t[0] in set(names)]
        if scope or any((day, name) not in self._same for name, day, *_ in told):
            held = self._of(names, self.held_table)
            move_partitions(self.store, self.held_table, self.table, held)
            empty_partitions(self.store, self.table, set(scope) - set(held))
            landed_at = datetime.now(timezone.utc)
            empty = [(name, None, 0, None) for name in sorted(set(names) - {t[0] for t in told})]
            rows = [(*t, landed_at) for t in [*told, *empty]]
            append_rows(self.store, self.digest_log, local_frame(self.store.spark, LANDED_DIGEST, rows))
        self.refuse(names)

    def refuse(self, names: Sequence[str]) -> None:
        empty_partitions(self.store, self.held_table, self._of(names, self.held_table))
        self._forget(names)

    def days(self, landed: Sequence[str]) -> list[date | None]:
        return _ordered({s[0] for s in self._of(landed)})

    def rows(self, days: Days, landed: Sequence[str] | None = None, held: Sequence[str] = ()) -> DataFrame:
        wanted = in_days(F.col("sale_date"), days)
        known = set(self.store.partitions(self.table))
        names = {s[1] for s in known}
        left_out = (names - set(landed) if landed is not None else set()) | (names & set(held))
        rows = self.store.read(self.table).where(wanted)
        if left_out:
            # what came again as it was is not held: it still counts where it landed
            stays = [(F.col("source_file") == name) & in_days(F.col("sale_date"), [day]) for day, name in self._same if name in left_out]
            kept = ~F.col("source_file").isin(sorted(left_out))
            for one in stays:
                kept = kept | one
            rows = rows.where(kept)
        return rows.unionByName(self._held(held).where(wanted)) if held else rows

    def digests(self, landed: Sequence[str]) -> DataFrame:
        return self._newest(landed).groupBy("sale_date").agg(
            F.sum("n").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias("digest"))

    def reset(self) -> None:
        for table in (self.table, self.held_table, self.digest_log):
            clear_table(self.store, table)

    def _forget(self, names: Sequence[str]) -> None:
        gone = set(names)
        self._same = {s for s in self._same if s[1] not in gone}
        self._told = [t for t in self._told if t[0] not in gone]

    def _newest(self, names: Collection[str]) -> DataFrame:
        """The digests that were logged last for each of the given files."""
        log = self.store.read_or_empty(self.digest_log, LANDED_DIGEST).where(F.col("source_file").isin(sorted(names)))
        last = log.groupBy("source_file").agg(F.max("landed_at").alias("landed_at"))
        return log.join(last, ["source_file", "landed_at"], "left_semi").where("n > 0")

    def _held(self, names: Sequence[str]) -> DataFrame:
        return self.store.read(self.held_table).where(F.col("source_file").isin(list(names)))

    def _of(self, names: Sequence[str], table: str | None = None) -> list:
        wanted = set(names)
        return [s for s in self.store.partitions(table or self.table) if s[1] in wanted]


class FrameLanding:
    """Landed rows served from any frame with the landing columns; one source file per sale date.

    ``rows_between(start, end)`` returns the rows of a date range, so that the source can push
    the range into its own scan. Rows without a date belong to no file; the gate asks for them and turns red.
    """

    def __init__(self, rows_between: Callable[[date | None, date | None], DataFrame],
                 laid_out_by_day: bool = False):
        self._rows_between = rows_between
        self.laid_out_by_day = laid_out_by_day

    def arrived(self) -> DataFrame:
        return self._rows_between(None, None).select("source_file").dropna().distinct()

    def preview(self, names: Sequence[str]) -> DataFrame:
        return self.rows([date.fromisoformat(n) for n in names])

    def take(self, names: Sequence[str], known: Collection[str] = ()) -> list[date | None]:
        return _ordered({date.fromisoformat(n) for n in names})

    def accept(self, names: Sequence[str]) -> None:
        return None

    def refuse(self, names: Sequence[str]) -> None:
        return None

    def days(self, landed: Sequence[str]) -> list[date | None]:
        return self.take(landed)

    def rows(self, days: Days, landed: Sequence[str] | None = None, held: Sequence[str] = ()) -> DataFrame:
        dated = sorted(d for d in days if d is not None)
        bounds = (dated[0], dated[-1]) if dated else (None, None)
        rows = stage_sales(self._rows_between(*bounds)).where(in_days(F.col("sale_date"), dated))
        if None in days:
            rows = rows.unionByName(stage_sales(self._rows_between(None, None).where("sale_date IS NULL")))
        return rows

    def digests(self, landed: Sequence[str]) -> DataFrame:
        n, digest = order_free(landed_hash())
        return self.rows(self.days(landed)).groupBy("sale_date").agg(n, digest.cast("string").alias("digest"))

    def reset(self) -> None:
        return None


def _ordered(days) -> list[date | None]:
    return sorted(days, key=lambda d: (d is None, d))

"""The actions: load, switch formula, fix and backfill, reset.

Every action ends in one build over an explicit list of days: read the landed rows of those days,
transform, check, replace exactly those days in the fact, then append to the ledgers. Ledgers come
last, so an action cut short is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymend.functions.measures import CORRECT, formula_sql, net_amount_by
from daymend.operators import checks as dq
from daymend.operators import day_index
from daymend.operators.conform import (
    Dimension, conform_stores, day_totals, fact_rows, heavy_stores, known_store, measured, with_keys, with_keys_split,
)
from daymend.operators.marts import DAILY_SALES_SQL, KEPT_SALES_SQL, daily_sales
from daymend.operators.stage import stage_stores
from daymend.operators.transform import transform_sales
from daymend.operators.write import (
    clear_table, in_days, lay_out_by_day, overwrite_table, replace_days, upsert_by_key,
)
from daymend.plans import audit, ledger
from daymend.schema import AUDIT, CHANNELS, CHECK_RESULTS, DAY_LEDGER, RUN_LEDGER, TOTAL
from daymend.sources.landing import Landing
from daymend.sources.local import local_frame
from daymend.sources.tables import TableStore

FACT = "fact_sale"
DIM = "dim_store"
STAGE = "batch_fact_sale"
STAGED_DIM = "batch_dim_store"

_TOTALS = ("row_count", "gross_total", "net_total")
_STATUS_KEYS = T.StructType([T.StructField("sale_date", T.DateType()),
                             T.StructField("built_by_action", T.StringType())])

_STATUS_VIEW = """
SELECT sale_date, last.row_count, last.gross_total, last.net_total,
       last.net_total > last.gross_total AS bugged, last.action AS built_by_action,
       last.built_at AS last_built_at, last.built_at AS dbt_run_timestamp
FROM (SELECT sale_date, max_by(struct(row_count, gross_total, net_total, action, built_at),
                               struct(seq, built_at)) AS last
      FROM {day_ledger} GROUP BY sale_date)
WHERE last.row_count > 0
"""


_STAGE_STORES = "SELECT store_id, store_name, region FROM {dim_store}"

_STAGE_SALES = """
SELECT sale_id, store_id, sale_date, gross_amount, tax_amount, channel, source_file
FROM {landed} LEFT SEMI JOIN (SELECT explode(files) AS source_file FROM {run_ledger} WHERE published) USING (source_file)
"""

_TRANSFORMED = f"""
SELECT sale_id, store_id, sale_date, channel, gross_amount, tax_amount, {formula_sql('formula')} AS net_amount
FROM {{stg_sale}} JOIN (SELECT sale_date, max_by(formula, struct(seq, built_at)) AS formula FROM {{day_ledger}} GROUP BY sale_date)
USING (sale_date)
"""


@dataclass
class RunReport:
    """What one action did."""

    seq: int
    action: str
    formula: str
    days: list = field(default_factory=list)
    files: list = field(default_factory=list)
    touched: int = 0
    passed: int = 0
    failed: int = 0
    failed_checks: list = field(default_factory=list)
    published: bool = False
    message: str = ""
    outcome: str = ""


class ChecksFailed(RuntimeError):
    """The staged batch was red and was not published."""

    def __init__(self, report: RunReport):
        super().__init__(f"{report.action}: not published, failed checks: {', '.join(report.failed_checks)}")
        self.report = report


class SalesFlow:
    """Build and repair of one sale fact.

    ``gate``: run the check suite on the batch before it is published.
    ``publish_on_red``: publish a red batch all the same and only report it.
    ``unique_across_days``: look for the batch's sale ids and keys in the other days too. Each build keeps a bitmap of its
    keys by day (``day_index``), and only days whose bitmap meets that of the batch are read. Equal ids have equal keys,
    so this finds both.
    ``by_key``: write by sale id instead of by day. A sale that left its file then stays in the fact, and one
    that moved to another day leaves the old one.
    ``refresh_dimension``: rebuild the dimension from the master list in every action, not only when missing. With
    the gate it is checked aside and put in place when the batch is published.
    """

    def __init__(self, store: TableStore, landing: Landing, stores: DataFrame, *,
                 channels: Sequence[str] = CHANNELS, gate: bool = True, publish_on_red: bool = False,
                 unique_across_days: bool = True, by_key: bool = False, refresh_dimension: bool = True):
        self.store = store
        self.landing = landing
        self.stores = stores
        self.suite = dq.sale_suite(channels)
        self.gate = gate
        self.publish_on_red = publish_on_red
        self.unique_across_days = unique_across_days and not by_key
        self.by_key = by_key
        self.refresh_dimension = refresh_dimension
        #: What is kept by day, unless days are written by key: a batch is then not all that its days hold.
        self.indexes = {} if by_key else {day_index.STORES: day_index.store_counts} | (
            {day_index.KEYS: day_index.key_words} if self.unique_across_days else {})
        self._measured: Dimension | None = None
        store.create("day_ledger", DAY_LEDGER)
        store.create("run_ledger", RUN_LEDGER)
        store.create(audit.TABLE, AUDIT)
        store.create("check_results", CHECK_RESULTS)
        store.create_view("dim_partition_status", _STATUS_VIEW.format(day_ledger=store.ident("day_ledger")))
        store.create_view("dm_daily_sales_kept", KEPT_SALES_SQL.format(day_ledger=store.ident("day_ledger")))

    # -- actions -----------------------------------------------------------------------------

    def load_next(self) -> RunReport:
        """Take in the first pending file by name and build the days it holds."""
        following = ledger.next_file(self.landing.arrived(), self.store).first()
        if following is None:
            report = self._report("load_next")
            report.message, report.outcome = "no file is waiting", _rebuilt(0)
            return self._close(report)
        return self.load_files([following.source_file])

    def load_files(self, names: Sequence[str]) -> RunReport:
        """Take in the given files, new or re-delivered, and rebuild every day whose rows they change."""
        report = self._report("load_next")
        report.message = f"took in {names[0]}" if len(names) == 1 else f"took in {len(names)} files"
        loaded = self.loaded()
        return self._build(report, self.landing.take(names, loaded), report.formula, files=names, loaded=loaded)

    def switch_formula(self, formula: str, rebuild: bool = True) -> RunReport:
        """Put another formula in force; rebuild all loaded days with it, or leave them for later."""
        report = self._report("inject_bug" if formula != CORRECT else "fix_and_backfill")
        report.message = f"formula {formula} in force"
        if not rebuild:
            report.formula, report.outcome = formula, _rebuilt(0)
            return self._close(report)
        return self._build(report, self._all_days(), formula, in_force=formula)

    def fix_and_backfill(self, start: date | None = None, end: date | None = None,
                         contiguous: bool = False) -> RunReport:
        """Put the right formula in force and replay the wrong days.

        Without arguments exactly the contaminated days; with an end given, or ``contiguous``, every
        day of the range from ``start`` (else the first contaminated day) to ``end`` (else the last).
        """
        if start and end and start > end:
            raise ValueError(f"range starts after it ends: {start} > {end}")
        report = self._report("fix_and_backfill")
        if start or end or contiguous:
            span = ledger.backfill_range(self.store, start, end).first()
            lo, hi = span.start_date, span.end_date
            if lo and hi and lo > hi:
                raise ValueError(f"the range {lo} to {hi} is empty; give both ends")
            days = [] if lo is None or hi is None else \
                [d for d in self._all_days() if d is not None and lo <= d <= hi]
        else:
            days = [r.sale_date for r in ledger.contaminated_days(self.store).collect()]
        if not days:
            report.formula = CORRECT
            report.message, report.outcome = "no day is wrong", _rebuilt(0)
            return self._close(report)
        dated = [d for d in days if d is not None]
        report.message = f"backfill {min(dated)} to {max(dated)}" if dated else "backfill of undated rows"
        return self._build(report, days, CORRECT, in_force=CORRECT)

    def replay(self, days: Iterable[date], formula: str | None = None,
               action: str = "fix_and_backfill") -> RunReport | None:
        """Rebuild exactly these days, with the formula in force or another one for this build only.
        No days, no change."""
        wanted = list(days)
        if not wanted:
            return None
        report = self._report(action)
        report.message = f"replay of {len(wanted)} days"
        return self._build(report, wanted, formula or report.formula)

    def reset(self) -> RunReport:
        """Empty fact, landing and ledgers; the audit log stays."""
        report = self._report("reset")
        for table in ("day_ledger", "run_ledger", "check_results", FACT, day_index.KEYS, day_index.STORES):
            clear_table(self.store, table)
        for check in self.suite:
            clear_table(self.store, dq.FAILURE_PREFIX + check.name)
        self.landing.reset()
        overwrite_table(self.store, DIM, conform_stores(stage_stores(self.stores), _now()))
        self._measured = None
        report.formula, report.published = CORRECT, True
        report.message, report.outcome = "all files wait again", "the fact is empty"
        return self._close(report, counted=True)

    # -- state -------------------------------------------------------------------------------

    def pending(self) -> DataFrame:
        return ledger.pending_files(self.landing.arrived(), self.store)

    def next_preview(self) -> DataFrame:
        """Rows of the next pending file."""
        names = [r.source_file for r in ledger.next_file(self.landing.arrived(), self.store).collect()]
        return self.landing.preview(names)

    def landed_rows(self) -> DataFrame:
        """All typed rows of the loaded files."""
        names = self.loaded()
        return self.landing.rows(self.landing.days(names), names)

    def loaded(self) -> list[str]:
        """Names of the files that count as loaded."""
        return [r.source_file for r in ledger.loaded_files(self.store).collect()]

    def _landed_days(self) -> list[date | None]:
        return self.landing.days(self.loaded())

    def _all_days(self) -> list[date | None]:
        return sorted({*self._landed_days(), *self.store.days(FACT)}, key=lambda d: (d is None, d))

    # -- the build ---------------------------------------------------------------------------

    def _build(self, report: RunReport, days: Sequence[date | None], formula: str,
               files: Sequence[str] = (), in_force: str | None = None, loaded: Sequence[str] | None = None) -> RunReport:
        if not days:
            if files:
                self.landing.accept(files)
            report.formula, report.published, report.files = in_force or report.formula, True, list(files)
            report.outcome = _rebuilt(0)
            return self._close(report)
        run_ts = _now()
        dim, staged_dim = self._dimension(run_ts)
        report.days = list(days)
        aligned = dim.small and self.landing.laid_out_by_day
        loaded = sorted({*(self.loaded() if loaded is None else loaded), *files})
        landed = self.landing.rows([*days, None] if self.gate and None not in days else days, loaded, files) \
            .drop("source_file")
        transformed = transform_sales(landed, formula)
        wanted = F.coalesce(in_days(F.col("sale_date"), days), F.lit(False))
        # One shuffle at most: ahead of a broadcast join where rows are narrow, after a shuffled one.
        if dim.small and not aligned:
            keyed = with_keys(transform_sales(lay_out_by_day(landed), formula), dim.frame)
        elif dim.small:
            keyed = with_keys(transformed, dim.frame)
        else:
            heavy = heavy_stores(landed, int(self.store.spark.conf.get("spark.sql.shuffle.partitions")))
            keyed = with_keys_split(transformed, dim.frame, heavy, lay_out=True)

        seen: dict = {}
        if self.gate:
            keyed, seen = self._stage(keyed, known_store() & wanted, wanted)
        # The join adds no rows if store ids are unique; then the staged rows serve for totals too.
        if seen and len(days) == 1 and dim.unique:
            totals = [Row(sale_date=days[0], **{k: seen[k] for k in _TOTALS})] if seen["row_count"] else []
        else:
            counted = keyed if self.gate and dim.unique else transformed
            totals = day_totals(counted.where(wanted)).collect()

        if self.gate:
            batch = keyed.where(known_store() & wanted)
            kept = {name: day_index.keep(self.store, name, told(batch), report.seq) for name, told in self.indexes.items()}
            models = self._models(report.action, keyed, wanted, dim.plain, days, totals, kept)
            results = dq.settled(self.suite, seen)
            decided = {name for name, *_ in results}
            results += [tuple(r) for r in dq.evaluate([c for c in self.suite if c.name not in decided], models).collect()]
            report.failed_checks = sorted(name for name, *_, status in results if status != "pass")
            report.failed = len(report.failed_checks)
            report.passed = len(results) - report.failed
            ledger.append(self.store, "check_results", CHECK_RESULTS, [(report.seq, *r) for r in results])
            self._keep_failures(report, models)
        if report.failed and not self.publish_on_red:
            clear_table(self.store, STAGE)
            for name in self.indexes:
                day_index.forget(self.store, name, report.seq)
            if files:
                self.landing.refuse(files)
            self._measured = None
            report.outcome = _rebuilt(0)
            self._close(report)
            raise ChecksFailed(report)

        if staged_dim:
            overwrite_table(self.store, DIM, self.store.read(STAGED_DIM))
            clear_table(self.store, STAGED_DIM)
            self._measured = None
        written = self._publish(fact_rows(keyed.where(wanted), run_ts), days)
        report.touched = len(written)
        clear_table(self.store, STAGE)
        if files:
            self.landing.accept(files)
        self._ensure_views()
        report.formula, report.published = in_force or report.formula, True
        self._log_days(report, formula, days, totals, run_ts)
        self._log_moved(report.seq, set(written) - set(days))
        if self.gate:
            for name in self.indexes:
                day_index.settle(self.store, name, days, report.seq)
        report.files = list(files)
        report.outcome = _rebuilt(report.touched)
        return self._close(report, counted=True)

    def _publish(self, fact: DataFrame, days: Sequence[date | None]) -> list[date | None]:
        if self.by_key and self.store.exists(FACT):
            return [s[0] for s in upsert_by_key(self.store, FACT, fact, ["sale_id"])]
        return replace_days(self.store, FACT, fact, days, rebalance=False)

    def _dimension(self, run_ts: datetime) -> tuple[Dimension, bool]:
        """The measured store dimension, and whether it waits aside for the checks.

        It is rebuilt from the master list if that is due; with the gate not in place but aside.
        """
        due = self.refresh_dimension or not self.store.exists(DIM)
        aside = due and self.gate
        if due:
            overwrite_table(self.store, STAGED_DIM if aside else DIM, conform_stores(stage_stores(self.stores), run_ts))
            self._measured = None
        if self._measured is None:
            self._measured = measured(self.store.read(STAGED_DIM if aside else DIM), "store_id")
        return self._measured, aside

    def _stage(self, keyed: DataFrame, in_fact: Column, wanted: Column) -> tuple[DataFrame, dict]:
        """Write the batch once, laid out by day; the checks read these files and the publishing does too.

        Failing rows of the row and value checks, and the totals of the wanted rows, are counted as the rows are written.
        """
        scopes = {"stg_sale": None, "trn_tbl_sale": None, "fact_sale": in_fact}
        inside = {c: F.when(wanted, F.col(c)) for c in ("gross_amount", "net_amount")}
        metrics = dq.tallies(self.suite, scopes) | {
            "row_count": F.count_if(wanted), "gross_total": F.sum(inside["gross_amount"]).cast(TOTAL),
            "net_total": F.sum(inside["net_amount"]).cast(TOTAL)}
        seen = Observation()
        rows = keyed.observe(seen, *[metric.alias(name) for name, metric in metrics.items()])
        overwrite_table(self.store, STAGE, rows, ["sale_date"], rebalance=False)
        return self.store.read(STAGE), seen.get

    def _models(self, action: str, keyed: DataFrame, wanted, dim: DataFrame, days, totals, kept) -> dict[str, dq.Model]:
        """The models of the suite over the staged batch.

        Stage, transform and fact are the same rows seen after more steps, so one frame with both
        keys serves all three, and the suite scans it once.
        """
        built = local_frame(self.store.spark, _STATUS_KEYS, [(r.sale_date, action) for r in totals])
        elsewhere = ~F.coalesce(in_days(F.col("sale_date"), days), F.lit(False))
        status = self.store.read("dim_partition_status").where(elsewhere).select(*built.columns).unionByName(built)
        return {
            "stg_store": dq.Model(stage_stores(self.stores)),
            "dim_store": dq.Model(dim),
            "stg_sale": dq.Model(keyed),
            "trn_tbl_sale": dq.Model(keyed),
            "fact_sale": dq.Model(keyed, known_store() & wanted, self._others(keyed, dim, days, kept)),
            "dim_partition_status": dq.Model(status),
            "dm_daily_sales": dq.Model(status),
        }

    def table_models(self) -> dict[str, dq.Model]:
        """The models of the suite over everything loaded and published."""
        landed = self.landed_rows()
        built = landed.join(ledger.current_days(self.store).select("sale_date", "formula"), "sale_date", "left")
        return {
            "stg_store": dq.Model(stage_stores(self.stores)),
            "dim_store": dq.Model(self.store.read(DIM)),
            "stg_sale": dq.Model(landed),
            "trn_tbl_sale": dq.Model(transform_sales(built, net_amount_by(F.col("formula")))),
            "fact_sale": dq.Model(self.store.read(FACT)),
            "dim_partition_status": dq.Model(ledger.partition_status(self.store)),
            "dm_daily_sales": dq.Model(daily_sales(self.store.read(FACT))),
        }

    def _others(self, keyed: DataFrame, dim: DataFrame, days, kept: dict[str, DataFrame]) -> dict[tuple[str, ...], DataFrame]:
        """Values of the other days that bear on the batch's checks, by column.

        Ids and keys that the batch has too, and store keys that the new dimension has lost; only days that the
        indexes name, or of which they know nothing, are read for them.
        """
        builds = self._builds(set(self.store.days(FACT)) - set(days))
        if not builds:
            return {}
        others = {}
        if day_index.KEYS in kept:
            near = self._days_to_read(day_index.KEYS, builds, lambda index: day_index.days_sharing_keys(index, kept[day_index.KEYS]))
            if near:
                fact = self.store.read(FACT).where(in_days(F.col("sale_date"), near))
                for column in ("sale_id", "sale_key"):
                    others[column,] = fact.select(column).join(keyed.select(column).distinct().hint("merge"), column, "left_semi")
        if self.store.exists(DIM):
            lost = self.store.read(DIM).select("store_key").join(dim.select("store_key").hint("merge"), "store_key", "left_anti").distinct()
            if not lost.isEmpty():
                near = self._days_to_read(day_index.STORES, builds, lambda index: day_index.days_with_stores(index, lost))
                if near:
                    fact = self.store.read(FACT).where(in_days(F.col("sale_date"), near))
                    others["store_key",] = fact.select("store_key").join(lost, "store_key", "left_semi")
        return others

    def _builds(self, days: Iterable[date | None]) -> dict[date | None, int | None]:
        """The newest build of each of the given days; None where the ledger has none."""
        newest = {r.sale_date: r.seq for r in ledger.current_days(self.store).select("sale_date", "seq").collect()}
        return {day: newest.get(day) for day in days}

    def _days_to_read(self, name: str, builds: dict, hits: Callable[[DataFrame], list]) -> list[date | None]:
        """The days that an index names, and those it does not know."""
        known = day_index.known_days(self.store, name, builds) if self.store.exists(name) else []
        return [*(set(builds) - set(known)), *(hits(day_index.read(self.store, name, known)) if known else [])]

    def index_days(self) -> list[date | None]:
        """Index the days that were built without the gate or by key, so that later loads need not read them."""
        builds, filled = {d: n for d, n in self._builds(self.store.days(FACT)).items() if n is not None}, set()
        for name, told in self.indexes.items():
            known = day_index.known_days(self.store, name, builds) if self.store.exists(name) else []
            if missing := set(builds) - set(known):
                rows = told(self.store.read(FACT).where(in_days(F.col("sale_date"), missing)))
                day_index.fill(self.store, name, rows, {day: builds[day] for day in missing})
                filled |= missing
        return sorted(filled, key=lambda d: (d is None, d))

    def _keep_failures(self, report: RunReport, models: dict[str, dq.Model]) -> None:
        red = [c for c in self.suite if c.name in report.failed_checks]
        dq.store_failures(self.store, red, models)
        for check in self.suite:
            table = dq.FAILURE_PREFIX + check.name
            if check not in red and self.store.spark.catalog.tableExists(self.store.ident(table)):
                clear_table(self.store, table)

    def _published(self, days: Iterable[date | None]) -> dict:
        """What the partitions of the given days really hold."""
        rows = self.store.read(FACT).where(in_days(F.col("sale_date"), days)).groupBy("sale_date").agg(
            F.count("*").alias("n"), *[F.sum(f"{c}_amount").cast(TOTAL).alias(c) for c in ("net", "gross", "tax")])
        return {r.sale_date: r for r in rows.collect()}

    def _log_days(self, report: RunReport, formula: str, days, totals, run_ts: datetime) -> None:
        """One ledger row per day. A day without rows is logged with zeros, which takes it off the status."""
        published = self._published(days)
        built = {r.sale_date: r for r in totals}
        rows = []
        for day in days:
            total, fact = built.get(day), published.get(day)
            rows.append((report.seq, report.action, day, total.row_count if total else 0,
                         *_sums(fact), total.gross_total if total else None, total.net_total if total else None,
                         formula, run_ts))
        ledger.append(self.store, "day_ledger", DAY_LEDGER, rows)

    def _log_moved(self, seq: int, days: set) -> None:
        """Days that only lost rows to an upsert keep their status and get their new fact counts."""
        if not days:
            return
        published = self._published(days)
        rows = []
        for last in ledger.current_days(self.store).where(in_days(F.col("sale_date"), days)).collect():
            fact = published.get(last.sale_date)
            rows.append((seq, last.action, last.sale_date, last.row_count, *_sums(fact), last.gross_total,
                         last.net_total, last.formula, last.built_at))
        ledger.append(self.store, "day_ledger", DAY_LEDGER, rows)

    def _ensure_views(self) -> None:
        """The mart, and stage and transform as views over what was landed."""
        views = {"dm_daily_sales": DAILY_SALES_SQL, "stg_store": _STAGE_STORES}
        if table := getattr(self.landing, "table", None):
            views |= {"stg_sale": _STAGE_SALES.replace("{landed}", self.store.ident(table)), "trn_tbl_sale": _TRANSFORMED}
        names = {name: self.store.ident(name) for name in (FACT, DIM, "run_ledger", "day_ledger", "stg_sale")}
        for name, query in views.items():
            if not self.store.spark.catalog.tableExists(self.store.ident(name)):
                self.store.create_view(name, query.format(**names))

    # -- bookkeeping -------------------------------------------------------------------------

    def _report(self, action: str) -> RunReport:
        seq, formula = ledger.position(self.store)
        return RunReport(seq + 1, action, formula)

    def _close(self, report: RunReport, counted: bool = False) -> RunReport:
        """Log the run; ``counted`` audits the relations as they are now."""
        run_id = f"run-{report.seq}-{uuid.uuid4().hex[:8]}"
        finished = _now()
        if counted:
            wanted = [DIM, FACT, "dim_partition_status", *([] if report.failed else ["dm_daily_sales"])]
            audit.record(self.store, wanted, run_id, finished)
        converged = report.formula == CORRECT and ledger.contaminated_days(self.store).isEmpty()
        dated = [d for d in report.days if d is not None]
        ledger.append(self.store, "run_ledger", RUN_LEDGER, [(
            report.seq, run_id, report.action, report.formula, min(dated, default=None),
            max(dated, default=None), report.touched, report.passed, report.failed, report.published,
            report.files, report.message, report.outcome, finished, report.failed_checks, converged)])
        return report


def _sums(fact: Row | None) -> tuple:
    """Rows, net, gross and tax of a day of the fact, in the order of the ledger."""
    return (fact.n, fact.net, fact.gross, fact.tax) if fact else (0, None, None, None)


def _rebuilt(days: int) -> str:
    return f"rebuilt {days} days"


def _now() -> datetime:
    return datetime.now(timezone.utc)

"""Row-count audit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymend.plans import ledger
from daymend.schema import AUDIT, AUDIT_LIMIT
from daymend.sources.tables import TableStore

TABLE = "tbl_metadata_audit"


def record(store: TableStore, relations: Sequence[str], invocation_id: str, loaded_at: datetime) -> None:
    """One audit row for each of the given relations of the store, counted in one job."""
    known = [name for name in relations if store.exists(name)]
    if known:
        counts = store.row_counts(known).collect()
        ledger.append(store, TABLE, AUDIT, [(r["name"], r["n"], invocation_id, loaded_at) for r in counts])


def latest(store: TableStore, limit: int = AUDIT_LIMIT) -> DataFrame:
    """The newest audit rows first; rows of one build by model name."""
    return store.read_or_empty(TABLE, AUDIT).orderBy(F.desc("loaded_at"), "model_name").limit(limit)

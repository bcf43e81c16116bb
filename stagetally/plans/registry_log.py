"""Writing the snapshot registry.

Every change, of any number of snapshots, appends one file to the log.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.functions.text import append_note
from stagetally.operators import registry as log
from stagetally.schemas import REGISTRY
from stagetally.session import literal_table
from stagetally.sources.log import append, superseding
from stagetally.sources.staging import withdraw
from stagetally.sources.warehouse import Warehouse, as_timestamp


def _rows(warehouse: Warehouse, events: Iterable[tuple], as_of: datetime) -> DataFrame:
    rows = [
        (trigger, status, notes, as_timestamp(snapshot), as_timestamp(as_of))
        for trigger, status, notes, snapshot in events
    ]
    return literal_table(warehouse.spark, rows, REGISTRY)


def register_events(warehouse: Warehouse, events: Iterable[tuple], as_of: datetime) -> None:
    """Append (trigger, status, notes, snapshot) rows to the log."""
    append(warehouse, _rows(warehouse, events, as_of), one_file=True)


def register_event(
    warehouse: Warehouse, snapshot_id, trigger: str, status: str, notes: str | None, as_of: datetime
) -> None:
    register_events(warehouse, [(trigger, status, notes, snapshot_id)], as_of)


def load_note(message: str, load: str | None) -> str:
    """A note that names the load, so that its files can be found."""
    return f"{message} ({load})" if load else message


def withdraw_unfinished(warehouse: Warehouse, names: Iterable[str], snapshot_ids: Iterable, running: set[str]) -> list[str]:
    """Take back what loads have moved into the snapshots that began but are not logged as completed.

    Loads in ``running`` are left alone.  Returns the loads taken back.
    """
    ids = {as_timestamp(s) for s in snapshot_ids}
    found = log.unfinished_loads(warehouse.read_or_empty("snapshot_registry").filter(F.col("snapshot_id").isin(list(ids))))
    loads = sorted({r["load"] for r in found.select("load").collect()} - running)
    for load in loads:
        withdraw(warehouse, load, names, ids)
    return loads


def register_ingest_start(
    warehouse: Warehouse, snapshot_id, as_of: datetime, trigger: str = "manual", load: str | None = None
) -> None:
    register_event(warehouse, snapshot_id, trigger, log.STARTED, load_note("snapshot load began", load), as_of)


def register_ingest_completion(
    warehouse: Warehouse,
    snapshot_id,
    data_counts: dict[str, int],
    reference_counts: dict[str, int],
    as_of: datetime,
    limit: int | None = None,
    load: str | None = None,
) -> None:
    rows = {**data_counts, **reference_counts}
    notes = "loaded " + ", ".join(f"{name}={n}" for name, n in rows.items())
    if limit:
        notes += f"; at most {limit} objects of a table"
    register_event(warehouse, snapshot_id, log.INGEST_COMPLETION, log.COMPLETED, load_note(notes, load), as_of)


def register_ingest_failure(warehouse: Warehouse, snapshot_id, message: str, as_of: datetime) -> None:
    register_event(
        warehouse, snapshot_id, log.INGEST_FAILURE, log.FAILED, f"load stopped: {message}", as_of
    )


def register_rescore_request(
    warehouse: Warehouse, snapshot_count: int, as_of: datetime, message_id: str | None = None
) -> None:
    """Log that scoring of all snapshots was asked for; the request time stands for a snapshot.

    A message that is logged already is not logged again.
    """
    notes = f"all {snapshot_count} completed snapshots are to be scored anew"
    if message_id:
        notes += f" (message {message_id})"
        asked = warehouse.read_or_empty("snapshot_registry").filter(F.col("triggered_by") == log.RESCORE_REQUEST)
        if not asked.filter(F.col("notes").endswith(f"(message {message_id})")).isEmpty():
            return
    at = as_timestamp(as_of).replace(microsecond=0)
    register_event(warehouse, at, log.RESCORE_REQUEST, log.STARTED, notes, as_of)


def _replace_events(
    warehouse: Warehouse, snapshot_ids: Iterable, removed: list[str], events: list[tuple], as_of: datetime
) -> None:
    ids = [as_timestamp(s) for s in snapshot_ids]
    rows = superseding(warehouse, ids, removed).unionByName(_rows(warehouse, events, as_of), allowMissingColumns=True)
    append(warehouse, rows, one_file=True)


def register_scoring_start(
    warehouse: Warehouse, snapshot_ids: Iterable, as_of: datetime, batch_name: str | None = None
) -> None:
    """Drop earlier start and completion rows of the snapshots, then log a start, with the batch of a stream that asked for it."""
    ids = list(snapshot_ids)
    events = [(log.SCORING_START, log.STARTED, load_note("scoring began", batch_name), s) for s in ids]
    _replace_events(warehouse, ids, [log.SCORING_START, log.SCORING_COMPLETION], events, as_of)


def scoring_note(processed: int, notes: str | None = None) -> str:
    return f"scored, {processed} records announced" + (f"; {notes}" if notes else "")


def register_scoring_completion(
    warehouse: Warehouse, snapshot_id, processed: int, as_of: datetime, notes: str | None = None
) -> None:
    message = scoring_note(processed, notes)
    register_event(warehouse, snapshot_id, log.SCORING_COMPLETION, log.COMPLETED, message, as_of)


def register_scoring_failure(
    warehouse: Warehouse, snapshot_ids: Iterable, message: str, as_of: datetime
) -> None:
    """Drop every scoring row of the snapshots, then log a failure."""
    ids = list(snapshot_ids)
    events = [(log.SCORING_FAILURE, log.FAILED, f"scoring stopped: {message}", s) for s in ids]
    removed = [log.SCORING_START, log.SCORING_COMPLETION, log.SCORING_FAILURE]
    _replace_events(warehouse, ids, removed, events, as_of)


def with_status(rows: DataFrame, status: str, note: str | None = None) -> DataFrame:
    """Set the status of all rows and append a note if there is one."""
    rows = rows.withColumn("status", F.lit(status))
    if note:
        rows = rows.withColumn("notes", append_note(F.col("notes"), F.lit(note)))
    return rows


def update_status(warehouse: Warehouse, snapshot_id, status: str, note: str | None = None) -> None:
    """Change every log row of a snapshot."""
    append(warehouse, superseding(warehouse, [as_timestamp(snapshot_id)], status=status, note=note or None), one_file=True)

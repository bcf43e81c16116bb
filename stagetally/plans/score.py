"""Scoring jobs: any number of snapshots in one plan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.operators import registry as log
from stagetally.operators.history import owner_rows
from stagetally.operators.profiles import required_data_per_snapshot
from stagetally.operators.scoring import heavy_companies, prepared_deals, score_history, score_units, stage_mapping
from stagetally.plans import registry_log
from stagetally.plans.report import OWNER_ROWS_TABLE, attributed_units
from stagetally.schemas import STAGE_MAPPING_ROWS
from stagetally.session import literal_table
from stagetally.sources.staging import Load
from stagetally.sources.warehouse import Warehouse, as_timestamp

UNITS_TABLE, HISTORY_TABLE = "pipeline_units_snapshot", "pipeline_score_history"

_STAMPS = "snapshot_id timestamp, record_timestamp timestamp"
_RESULTS = "snapshot_id timestamp, status string, unit_records bigint, history_records bigint, error string"


def _stamped(df: DataFrame, stamps: DataFrame) -> DataFrame:
    """Give each snapshot its own load time."""
    return df.drop("record_timestamp").join(stamps, "snapshot_id", "inner")


def score_snapshots(
    warehouse: Warehouse,
    snapshot_ids: Iterable,
    as_of: datetime | None = None,
    processed: Mapping[datetime, int] | None = None,
    batch_name: str | None = None,
    gate: bool = False,
) -> DataFrame:
    """Score the given snapshots, store units and history, log the outcome.

    Both tables are replaced per snapshot, so a rerun gives the same rows, and
    both are complete before either changes; so are the owner rows the report
    is made from.  History is computed from the units as written.  Load times grow by one
    microsecond per snapshot in the given order, because the report compares
    snapshots by load time.  ``processed`` holds the record counts that
    completion messages announced, kept in the log.  Snapshots that the log
    says were scored by the batch ``batch_name`` already are left out.

    With ``gate``, snapshots that lack companies, deals, owners or stages are
    not scored, logged as failed before anything is written, and returned as
    errors.  Returns one result row per snapshot.
    """
    spark = warehouse.spark
    ids = list(dict.fromkeys(as_timestamp(s) for s in snapshot_ids))
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    announced = {as_timestamp(s): n for s, n in (processed or {}).items()}
    if batch_name:
        done = log.scored_in_batch(warehouse.read_or_empty("snapshot_registry"), batch_name)
        done_ids = {as_timestamp(r[0]) for r in done.select(F.col("snapshot_id").cast("string")).collect()}
        ids = [s for s in ids if s not in done_ids]
    refused: list[tuple] = []
    if gate and ids:
        lacking = lacking_data(warehouse, ids)
        for reason, found in _by_reason(lacking).items():
            registry_log.register_scoring_failure(warehouse, found, reason, as_of)
        refused = [(s, "error", None, None, lacking[s]) for s in ids if s in lacking]
        ids = [s for s in ids if s not in lacking]
    if not ids:
        return literal_table(spark, refused, _RESULTS)
    registry_log.register_scoring_start(warehouse, ids, as_of, batch_name)
    try:
        warehouse.require("companies", "deals", "deal_stage_reference")
        mapping = stage_mapping(spark, as_of)
        warehouse.replace_table(mapping, "stage_mapping")
        stamps = literal_table(
            spark, [(s, as_of + timedelta(microseconds=i)) for i, s in enumerate(ids)], _STAMPS
        )
        deals, stages = warehouse.read_snapshots("deals", ids), warehouse.read("deal_stage_reference")
        units = score_units(
            warehouse.read_snapshots("companies", ids),
            deals,
            stages,
            mapping,
            F.lit(None).cast("timestamp"),
            heavy=heavy_companies(prepared_deals(deals, stages)),
        )
        with Load(warehouse) as load:
            load.stage(_stamped(units, stamps), UNITS_TABLE)
            history = score_history(load.rows(UNITS_TABLE), F.lit(None).cast("timestamp"))
            attributed = attributed_units(load.rows(UNITS_TABLE), warehouse.read_snapshots("companies", ids), deals)
            load.stage_all({HISTORY_TABLE: _stamped(history, stamps), OWNER_ROWS_TABLE: owner_rows(attributed)})
            unit_rows, history_rows = load.counts(UNITS_TABLE, ids), load.counts(HISTORY_TABLE, ids)
            load.publish(ids)
    except Exception as error:
        registry_log.register_scoring_failure(warehouse, ids, str(error), datetime.now(timezone.utc))
        raise
    notes = {
        s: f"{unit_rows[s]} units, {history_rows[s]} history rows, {len(STAGE_MAPPING_ROWS)} scoring rows"
        for s in ids
    }
    registry_log.register_events(
        warehouse,
        [
            (log.SCORING_COMPLETION, log.COMPLETED, registry_log.scoring_note(announced.get(s, 0), notes[s]), s)
            for s in ids
        ],
        as_of + timedelta(microseconds=len(ids)),
    )
    return literal_table(
        spark, [(s, "success", unit_rows[s], history_rows[s], None) for s in ids] + refused, _RESULTS
    )


def lacking_data(warehouse: Warehouse, snapshot_ids: Iterable) -> dict[datetime, str]:
    """Snapshots that cannot be scored for want of data, and what they lack; an absent table is an empty one."""
    ids = [as_timestamp(s) for s in snapshot_ids]
    some = {n: warehouse.read_or_empty(n).filter(F.col("snapshot_id").isin(ids)) for n in ("companies", "deals")}
    verdicts = required_data_per_snapshot(
        literal_table(warehouse.spark, [(s,) for s in ids], "snapshot_id timestamp"),
        some["companies"],
        some["deals"],
        warehouse.read_or_empty("owners"),
        warehouse.read_or_empty("deal_stage_reference"),
    )
    rows = verdicts.filter("NOT all_present").withColumn("id", F.col("snapshot_id").cast("string")).collect()
    named = ["snapshot_companies", "snapshot_deals", "owners_data", "deal_stages_data"]
    return {as_timestamp(r["id"]): "no rows in " + ", ".join(n for n in named if not r[n]) for r in rows}


def _by_reason(lacking: Mapping[datetime, str]) -> dict[str, list[datetime]]:
    out: dict[str, list[datetime]] = {}
    for snapshot, reason in lacking.items():
        out.setdefault(reason, []).append(snapshot)
    return out


def score_snapshot(warehouse: Warehouse, snapshot_id, as_of: datetime | None = None) -> DataFrame:
    return score_snapshots(warehouse, [snapshot_id], as_of)


def rescore_all(
    warehouse: Warehouse,
    as_of: datetime | None = None,
    message_id: str | None = None,
    batch_name: str | None = None,
) -> DataFrame:
    """Score every completed snapshot, oldest completion first; the request is logged.

    All go through one plan.  If that fails, each is scored by itself, so a
    snapshot that cannot be scored fails alone and the others are stored.
    """
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    rows = log.completed_snapshots(warehouse.read("snapshot_registry"))
    ids = [r[0] for r in rows.select(F.col("snapshot_id").cast("string")).collect()]
    registry_log.register_rescore_request(warehouse, len(ids), as_of, message_id)
    try:
        return score_snapshots(warehouse, ids, as_of, batch_name=batch_name)
    except Exception:
        if len(ids) < 2:
            raise
    results = []
    for i, snapshot in enumerate(ids):
        at = as_of + timedelta(microseconds=i)
        try:
            results += [tuple(r) for r in score_snapshots(warehouse, [snapshot], at, batch_name=batch_name).collect()]
        except Exception as error:
            results.append((as_timestamp(snapshot), "error", None, None, str(error)[:500]))
    return literal_table(warehouse.spark, results, _RESULTS)

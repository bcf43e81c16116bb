"""Moving snapshots and reference tables between warehouses."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.functions.snapshots import migrated_snapshot_id, parse_snapshot_id
from stagetally.functions.text import normalize_email, null_if_empty
from stagetally.operators import registry as log
from stagetally.operators.alignment import align_to_schema
from stagetally.operators.digest import DIGEST, digests
from stagetally.plans import registry_log
from stagetally.schemas import FACT_TABLES, TABLES
from stagetally.session import cut_lineage
from stagetally.sources.staging import Load
from stagetally.sources.warehouse import Warehouse, as_timestamp


def migrated_rows(df: DataFrame, name: str, as_of) -> DataFrame:
    """Rows of a fact table with text snapshot ids, aligned and cleaned for the target."""
    target_id = parse_snapshot_id(migrated_snapshot_id(F.col("snapshot_id").cast("string")))
    df = df.withColumn("_target", target_id)
    return align_to_schema(
        df, TABLES[name], {"snapshot_id": F.col("_target"), "record_timestamp": as_of}
    )


def migration_counts(sources: dict[str, DataFrame], target: Warehouse) -> DataFrame:
    """Source and target rows per table and target snapshot, and whether they agree."""
    parts = []
    for name, df in sources.items():
        source = df.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("source_rows"))
        stored = target.read_or_empty(name).filter("snapshot_id IS NOT NULL").groupBy("snapshot_id")
        stored = stored.agg(F.count(F.lit(1)).alias("target_rows"))
        parts.append(
            source.join(stored, "snapshot_id", "left")
            .na.fill(0, ["target_rows"])
            .withColumn("table", F.lit(name))
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("verified", F.col("source_rows") == F.col("target_rows"))
        .select("table", "snapshot_id", "source_rows", "target_rows", "verified")
    )


def migration_check(source: dict[str, DataFrame], target: Warehouse) -> DataFrame:
    """The same columns from digests of the computed rows per snapshot; the target is read once."""
    parts = []
    for name, computed in source.items():
        stored = target.read_or_empty(name)
        stored = digests(stored.join(computed.select("snapshot_id"), "snapshot_id", "left_semi").select(*TABLES[name].names), ["snapshot_id"])
        stored = stored.select("snapshot_id", *[F.col(c).alias(f"_{c}") for c in DIGEST])
        same = F.coalesce(reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in DIGEST]), F.lit(False))
        parts.append(
            computed.join(stored, "snapshot_id", "left").select(
                F.lit(name).alias("table"),
                "snapshot_id",
                F.col("rows").alias("source_rows"),
                F.coalesce("_rows", F.lit(0).cast("bigint")).alias("target_rows"),
                same.alias("verified"),
            )
        )
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def migrate_snapshots(
    sources: dict[str, DataFrame],
    target: Warehouse,
    snapshot_ids: Iterable[str] | None = None,
    as_of: datetime | None = None,
    clear_previous: bool = True,
    dry_run: bool = False,
    rejected_path: str | None = None,
) -> DataFrame:
    """Migrate all (or the given) source snapshots in one plan per table.

    ``sources`` maps fact tables to DataFrames whose ``snapshot_id`` is text in
    any known form.  Several source ids may fall on one target id; their rows
    are added up there.  Rows with an unreadable id are not loaded: they are
    written as JSON lines below ``rejected_path``, one folder per table, if it
    is given, and counted under a NULL id, which is never verified.

    Each source is computed once.  All tables are written beside the target,
    then the target snapshots are logged as started, then the files are moved
    in; a source that fails changes nothing, and a run that dies while files
    are moved is cleared by the next one.  Returns the verification per table
    and snapshot: a snapshot is verified if the target holds the very rows
    that were computed, and no others.
    """
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    wanted = list(snapshot_ids) if snapshot_ids is not None else None
    mapped = {}
    for name in FACT_TABLES:
        df = sources[name]
        if wanted is not None:
            df = df.filter(F.col("snapshot_id").cast("string").isin(wanted))
        mapped[name] = migrated_rows(df, name, F.lit(as_of))
    if dry_run:
        return migration_counts(mapped, target)
    with Load(target) as load:
        load.stage_all(mapped)
        if rejected_path:
            for name in mapped:
                rejected = load.rows(name).filter("snapshot_id IS NULL")
                rejected.write.mode("overwrite").json(f"{rejected_path}/{name}")
        source = {name: cut_lineage(load.digests(name)) for name in mapped}
        ids = sorted(set().union(*(load.snapshots(name) for name in mapped)))
        registry_log.register_events(
            target, [(log.MIGRATION, log.STARTED, registry_log.load_note("migration began", load.name), s) for s in ids], as_of
        )
        if clear_previous:
            for name in FACT_TABLES:
                target.delete_snapshots(name, log.MIGRATION)
        else:
            registry_log.withdraw_unfinished(target, FACT_TABLES, ids, {load.name})
        load.publish()
    checked = migration_check(source, target)
    per_snapshot = (
        checked.filter("snapshot_id IS NOT NULL")
        .groupBy(F.col("snapshot_id").cast("string").alias("id"))
        .agg(F.sum("source_rows").alias("n"), F.array_join(F.sort_array(F.collect_set("table")), ", ").alias("t"))
        .collect()
    )
    if clear_previous:
        target.forget_trigger(log.MIGRATION)
    registry_log.register_events(
        target,
        [
            (log.MIGRATION, log.COMPLETED, registry_log.load_note(f"migrated {r['n']} rows of {r['t']}", load.name), r["id"])
            for r in per_snapshot
        ],
        as_of,
    )
    return checked


def reference_rows(df: DataFrame, name: str, as_of) -> DataFrame:
    """A reference table aligned to its schema, e-mails and owner ids cleaned."""
    rows = align_to_schema(df, TABLES[name], {"record_timestamp": as_of}, normalize=False)
    if "email" in rows.columns:
        rows = rows.withColumn("email", normalize_email(F.col("email")))
    if "owner_id" in rows.columns:
        rows = rows.withColumn("owner_id", null_if_empty(F.col("owner_id")))
    return rows


def copy_reference(
    sources: dict[str, DataFrame], target: Warehouse, as_of: datetime | None = None
) -> list[str]:
    """Replace the target's reference tables by the cleaned source rows."""
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    for name, df in sources.items():
        target.replace_table(reference_rows(df, name, F.lit(as_of)), name)
    return list(sources)

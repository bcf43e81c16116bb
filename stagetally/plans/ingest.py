"""Landed JSON to snapshot tables, registry row and completion event."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions.events import build_completed_event, build_failed_event
from stagetally.functions.records import normalize_fields
from stagetally.functions.snapshots import format_snapshot_id
from stagetally.plans import registry_log
from stagetally.schemas import COMPANY_PROPERTIES, DEAL_ASSOCIATIONS, DEAL_PROPERTIES
from stagetally.session import cut_lineage, literal_table
from stagetally.sources import landing
from stagetally.sources.staging import Load
from stagetally.sources.warehouse import Warehouse, as_timestamp, table_counts


@dataclass(frozen=True)
class ObjectConfig:
    """How one landed object type becomes a fact table."""

    table: str
    id_field: str
    properties: Mapping[str, str]
    associations: Mapping[str, tuple[str, str]]


def object_configs(owner_property: str) -> tuple[ObjectConfig, ...]:
    """Companies and deals, with the property that names the owner of a record."""
    owner = {owner_property: "owner_id"}
    return (
        ObjectConfig("companies", "company_id", COMPANY_PROPERTIES | owner, {}),
        ObjectConfig("deals", "deal_id", DEAL_PROPERTIES | owner, DEAL_ASSOCIATIONS),
    )


def object_rows(pages: DataFrame, config: ObjectConfig, snapshot_id, as_of) -> DataFrame:
    """Normalised rows of one object type in the shape of its table."""
    linked = landing.resolve_associations(pages, config.associations)
    keep = tuple(target for target, _ in config.associations.values())
    rows = landing.project_properties(
        linked, config.table, config.id_field, config.properties, snapshot_id, as_of, keep
    )
    return normalize_fields(rows, config.table)


def limited_pages(pages: DataFrame, limit: int | None) -> DataFrame:
    """The first pages in file order; all without a limit."""
    return pages.orderBy("page_file", "position").limit(limit) if limit else pages


def ingest_snapshot(
    warehouse: Warehouse,
    paths: Mapping[str, str],
    configs: tuple[ObjectConfig, ...],
    snapshot_id=None,
    limit: int | None = None,
    dry_run: bool = True,
    as_of: datetime | None = None,
    environment: str = "dev",
    trigger: str = "manual",
    event_path: str | None = None,
    replace: bool = False,
    gate: bool = False,
) -> DataFrame:
    """Load one snapshot and return rows per table; see :func:`object_configs`.

    ``paths`` names the landed folders of each object table and of ``owners``
    and ``deal_stage_reference``.  A dry run only counts.  A limit on the
    objects of each table is noted in the registry.  Owners and stages
    are replaced; an empty list leaves the old ones.

    Companies and deals are written beside their tables and moved in together
    once all is computed.  What an earlier load of the snapshot left that never
    completed is taken back first, so a failed load can be repeated.  Rows of
    completed loads of the same snapshot stay, unless ``replace`` is set.

    With ``gate``, nothing is logged or written unless every landed folder is
    there and holds a row.
    """
    spark = warehouse.spark
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    snapshot = as_timestamp(snapshot_id) if snapshot_id else as_of.replace(microsecond=0)
    stamp, now = F.lit(snapshot), F.lit(as_of)
    facts = {}
    for config in configs:
        pages = limited_pages(landing.read_object_pages(spark, paths[config.table]), limit)
        facts[config.table] = object_rows(pages, config, stamp, now)
    if dry_run:
        return table_counts(facts)
    if gate:
        references = (landing.read_owners(spark, paths["owners"]), landing.flatten_deal_stages(spark, paths["deal_stage_reference"], now))
        empty = [n for n, rows in (facts | dict(zip(("owners", "deal_stage_reference"), references))).items() if rows.isEmpty()]
        if empty:
            raise ValueError(f"nothing landed for {', '.join(empty)}")
    with Load(warehouse) as load:
        registry_log.register_ingest_start(warehouse, snapshot, as_of, trigger, load.name)
        try:
            load.stage_all(facts)
            references = {
                "owners": landing.read_owners(spark, paths["owners"]),
                "deal_stage_reference": landing.flatten_deal_stages(
                    spark, paths["deal_stage_reference"], now
                ),
            }
            for name, rows in references.items():
                warehouse.replace_table(rows, name)
            registry_log.withdraw_unfinished(warehouse, facts, [snapshot], {load.name})
            load.publish([snapshot] if replace else ())
        except Exception as error:
            registry_log.register_ingest_failure(warehouse, snapshot, str(error), as_of)
            if event_path:
                event = build_failed_event(format_snapshot_id(stamp), F.lit(str(error)), now, environment)
                spark.range(1).select(event.alias("value")).write.mode("append").text(event_path)
            raise
    stored = {n: warehouse.read_table_for_snapshot(n, snapshot) for n in facts}
    counts = cut_lineage(table_counts(stored | {n: warehouse.read_or_empty(n) for n in references}))
    by_table = {r["table"]: r["rows"] for r in counts.collect()}
    registry_log.register_ingest_completion(
        warehouse, snapshot, {n: by_table[n] for n in facts}, {n: by_table[n] for n in references}, as_of, limit, load.name
    )
    if event_path:
        event = completed_event(spark, snapshot, by_table, list(facts), list(references), as_of, environment)
        event.write.mode("append").text(event_path)
    return counts


def completed_event(
    spark, snapshot, counts: dict[str, int], facts: list[str], references: list[str], as_of, environment
) -> DataFrame:
    """One-row DataFrame with the completion message of a snapshot."""
    schema = T.StructType(
        [
            T.StructField("snapshot_id", T.TimestampType()),
            T.StructField("as_of", T.TimestampType()),
        ]
    )

    def as_map(names):
        return F.create_map(*[F.lit(v).cast(t) for n in names for v, t in ((n, "string"), (counts[n], "bigint"))])

    row = literal_table(spark, [(snapshot, as_of)], schema)
    return row.select(
        build_completed_event(
            format_snapshot_id(F.col("snapshot_id")), as_map(facts), as_map(references), F.col("as_of"), environment
        ).alias("value")
    )

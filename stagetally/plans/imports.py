"""Dated export files to snapshot tables and registry rows."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.functions.snapshots import parse_snapshot_id
from stagetally.operators import registry as log
from stagetally.operators.exports import (
    drop_empty_rows,
    export_summary,
    map_export_company,
    map_export_deal,
    with_file_pairs,
    with_owner_ids,
)
from stagetally.plans import registry_log
from stagetally.schemas import TABLES
from stagetally.session import literal_table
from stagetally.sources.exports import (
    MALFORMED,
    ExportGroup,
    list_exports,
    pair_export_files,
    read_export_groups,
)
from stagetally.sources.warehouse import Warehouse, as_timestamp

_MAPPERS = {"company": map_export_company, "deal": map_export_deal}


def mapped_exports(
    groups: list[ExportGroup], kind: str, pairs: DataFrame, as_of, owner_names: DataFrame | None = None
) -> DataFrame:
    """Rows of one kind in its table schema, for dates with a complete file pair."""
    mapped = []
    for group in groups:
        if group.kind == kind:
            whole = group.frame.filter(F.col(MALFORMED).isNull())
            rows = with_file_pairs(drop_empty_rows(whole, group.columns), pairs)
            snapshot = parse_snapshot_id(F.col("snapshot_id"))
            mapped.append(_MAPPERS[kind](rows, snapshot, as_of, group.columns, finish=False))
    if not mapped:
        table = "companies" if kind == "company" else "deals"
        return literal_table(pairs.sparkSession, [], TABLES[table])
    return with_owner_ids(reduce(DataFrame.unionByName, mapped), owner_names)


def malformed_records(groups: list[ExportGroup]) -> DataFrame | None:
    """Records with a wrong number of fields: export, kind, first field and text; None without exports."""
    found = [
        g.frame.filter(F.col(MALFORMED).isNotNull()).select(
            "export_file", F.lit(g.kind).alias("kind"), F.col(f"`{g.columns[0]}`").alias("first_field"), MALFORMED
        )
        for g in groups
        if g.columns
    ]
    return reduce(DataFrame.unionByName, found) if found else None


def import_exports(
    warehouse: Warehouse,
    path: str,
    owner_names: DataFrame | None = None,
    dry_run: bool = False,
    as_of: datetime | None = None,
    pairs: DataFrame | None = None,
    multi_line: bool = True,
    malformed_path: str | None = None,
) -> DataFrame:
    """Import every complete pair of export files; returns the summary per snapshot.

    Records with a wrong number of fields are not loaded; they are written as
    JSON lines to ``malformed_path`` if it is given.

    ``pairs`` replaces the pairing by modification time, for files whose times
    were lost in a copy.
    """
    spark = warehouse.spark
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    groups = read_export_groups(spark, path, multi_line)
    if pairs is None:
        pairs = pair_export_files(list_exports(spark, path))
    tables = {
        "companies": mapped_exports(groups, "company", pairs, F.lit(as_of), owner_names),
        "deals": mapped_exports(groups, "deal", pairs, F.lit(as_of), owner_names),
    }
    if dry_run:
        return export_summary(tables["companies"], tables["deals"])
    if malformed_path and (malformed := malformed_records(groups)) is not None:
        malformed.write.mode("overwrite").json(malformed_path)
    ids = [r[0] for r in pairs.select("snapshot_id").collect()]
    if not ids:
        return export_summary(tables["companies"], tables["deals"])
    for name, rows in tables.items():
        warehouse.replace_snapshots(rows, name, ids)
    summary = export_summary(
        warehouse.read_snapshots("companies", ids), warehouse.read_snapshots("deals", ids)
    )
    counts = summary.filter("snapshot_id IS NOT NULL").select(
        F.col("snapshot_id").cast("string").alias("id"), "companies", "deals"
    )
    registry_log.register_events(
        warehouse,
        [
            (
                log.EXPORT_IMPORT,
                log.COMPLETED,
                f"exports loaded, {r['companies']} companies and {r['deals']} deals",
                r["id"],
            )
            for r in counts.collect()
        ],
        as_of,
    )
    return summary

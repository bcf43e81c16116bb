"""Mapping export rows to table schemas, and owner names to ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions import text
from stagetally.operators.containment import contained_in
from stagetally.schemas import (
    COMPANIES,
    COMPANY_EXPORT_COLUMNS,
    DEAL_EXPORT_COLUMNS,
    DEALS,
    LOWERCASE_FIELDS,
)

_CLEANERS = {
    "lifecycle_stage": text.normalize_lifecycle_stage,
    "lead_status": text.normalize_lead_status,
    "proff_link": text.normalize_url_full,
    "amount": text.parse_amount,
}


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def drop_empty_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows that are NULL throughout or whose first column is NULL."""
    columns = columns or df.columns
    return df.filter(_quoted(columns[0]).isNotNull())


def similar_column(wanted: str, columns: Iterable[str]) -> str | None:
    """First column whose name equals or contains the wanted one, or the reverse.

    Case, spaces and underscores do not count.
    """

    def plain(name: str) -> str:
        return name.lower().replace(" ", "").replace("_", "")

    target = plain(wanted)
    return next((c for c in columns if target in plain(c) or plain(c) in target), None)


def resolve_columns(
    columns: list[str], aliases: Mapping[str, str], allow_similar: bool
) -> dict[str, str | None]:
    """Source column per target; the last alias of a target decides, even for NULL."""
    chosen: dict[str, str | None] = {}
    for alias, target in aliases.items():
        if alias in columns:
            chosen[target] = alias
        else:
            chosen[target] = similar_column(alias, columns) if allow_similar else None
    return chosen


def _cleaned(field: str, source: str | None, df: DataFrame, table: str) -> Column:
    if source is None:
        return F.lit(None)
    c = _quoted(source)
    numeric = isinstance(df.schema[source].dataType, T.NumericType)
    if field in ("company_id", "deal_id", "associated_company_id"):
        return text.clean_id(c, numeric)
    if field == "amount" and numeric:
        return c
    c = c.cast("string")
    if field in _CLEANERS:
        return _CLEANERS[field](c)
    if field in LOWERCASE_FIELDS[table]:
        return text.normalize_enum_null(c)
    if field == "owner_id":
        return c
    return text.null_if_blank(c)


def _map_export(
    df: DataFrame,
    columns: list[str],
    aliases: Mapping[str, str],
    table: str,
    schema: T.StructType,
    allow_similar: bool,
    snapshot_id: Column,
    as_of: Column,
    owner_names: DataFrame | None,
    finish: bool,
) -> DataFrame:
    chosen = resolve_columns(columns, aliases, allow_similar)
    system = {"snapshot_id": snapshot_id, "record_timestamp": as_of}
    out = df.select(
        *[
            system.get(f.name, _cleaned(f.name, chosen.get(f.name), df, table))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )
    return with_owner_ids(out, owner_names) if finish else out


def with_owner_ids(rows: DataFrame, owner_names: DataFrame | None = None) -> DataFrame:
    """Mapped rows with owner names resolved, if names are given, and blank owners as NULL."""
    if owner_names is not None:
        rows = resolve_owner_names(rows, "owner_id", owner_names)
    return rows.withColumn("owner_id", text.null_if_blank(F.col("owner_id")))


def map_export_company(
    df: DataFrame,
    snapshot_id: Column,
    as_of: Column,
    columns: list[str] | None = None,
    owner_names: DataFrame | None = None,
    finish: bool = True,
) -> DataFrame:
    """Company export rows (of one header) in the companies schema.

    Without ``finish`` owners stay as written, for :func:`with_owner_ids` after a union.
    """
    return _map_export(
        df, columns or df.columns, COMPANY_EXPORT_COLUMNS, "companies", COMPANIES,
        False, snapshot_id, as_of, owner_names, finish,
    )


def map_export_deal(
    df: DataFrame,
    snapshot_id: Column,
    as_of: Column,
    columns: list[str] | None = None,
    owner_names: DataFrame | None = None,
    finish: bool = True,
) -> DataFrame:
    """Deal export rows (of one header) in the deals schema.

    Columns are resolved from the header once, never per row.
    """
    return _map_export(
        df, columns or df.columns, DEAL_EXPORT_COLUMNS, "deals", DEALS,
        True, snapshot_id, as_of, owner_names, finish,
    )


def resolve_owner_names(df: DataFrame, column: str, owner_names: DataFrame) -> DataFrame:
    """Owner names to ids: exact, else first partial match, else unchanged.

    ``owner_names`` has ``name`` (lower case), ``owner_id`` and ``rank`` (lookup
    order).  "Partial" means one name contains the other; a blank name is
    contained in every lookup name, so the first one wins.  Only distinct names
    without an exact match take part, and they are found by their rarest grams
    (:func:`contained_in`), so there is no pairwise comparison.
    """
    lookup = (
        owner_names.filter("name IS NOT NULL")
        .groupBy(F.col("name").alias("_name"))
        .agg(F.min(F.struct("rank", "owner_id")).alias("_hit"))
    )
    keyed = df.withColumn("_key", text.strip(F.lower(F.col(column).cast("string"))))
    names = keyed.select("_key").filter("_key IS NOT NULL").distinct()
    exact = names.join(lookup, names["_key"] == lookup["_name"]).select("_key", "_hit")
    open_names = names.join(exact, "_key", "left_anti")
    known = lookup.select("_name")
    pairs = contained_in(open_names.select(F.col("_key").alias("small")), known.select(F.col("_name").alias("big"))).select(
        F.col("small").alias("_key"), F.col("big").alias("_name")
    )
    pairs = pairs.unionByName(
        contained_in(known.select(F.col("_name").alias("small")), open_names.select(F.col("_key").alias("big"))).select(
            F.col("big").alias("_key"), F.col("small").alias("_name")
        )
    )
    partial = pairs.join(lookup, "_name").select("_key", "_hit")
    best = exact.unionByName(partial).groupBy("_key").agg(F.min("_hit").alias("_hit"))
    return (
        keyed.join(best, "_key", "left")
        .withColumn(column, F.coalesce("_hit.owner_id", F.col(column).cast("string")))
        .select(*df.columns)
    )


def with_file_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Export rows of dates that have a complete file pair, with its snapshot id."""
    return rows.join(pairs.select("export_date", "snapshot_id"), "export_date", "inner")


def export_summary(companies: DataFrame, deals: DataFrame) -> DataFrame:
    """Companies, deals and total per snapshot, and one row for all (NULL snapshot)."""
    rows = companies.select("snapshot_id", F.lit(1).alias("c"), F.lit(0).alias("d")).unionByName(
        deals.select("snapshot_id", F.lit(0).alias("c"), F.lit(1).alias("d"))
    )
    return (
        rows.rollup("snapshot_id")
        .agg(F.sum("c").alias("companies"), F.sum("d").alias("deals"))
        .withColumn("total", F.col("companies") + F.col("deals"))
    )

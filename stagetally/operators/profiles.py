"""Profiles of tables and snapshots: counts, distinct values, case problems."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetally.functions.snapshots import snapshot_id_format
from stagetally.operators.distinct import distinct_aggregate
from stagetally.operators.sampling import sample_values
from stagetally.session import literal_table

# Fields whose mixed-case values are listed with their counts.
_LISTED_FIELDS = {
    "companies": ["lifecycle_stage", "lead_status", "company_type"],
    "deals": ["deal_stage", "deal_type"],
    "owners": ["email"],
}


def _mixed(field: str) -> Column:
    """1 for a value that is not lower case."""
    return F.when(F.col(field) != F.lower(field), 1).otherwise(0)


def _profile(
    df: DataFrame, stage: str, stages: str, distinct: Mapping[str, str], checked: list[str]
) -> DataFrame:
    """Rows, distinct counts, the sorted list of lowered stages, mixed-case rows per field."""
    sums = {"total": F.lit(1), **{f"{f}_issues": _mixed(f) for f in checked}}
    rows = distinct_aggregate(
        df.withColumn("_stage", F.lower(stage)), [], distinct, {stages: "_stage"}, sums
    )
    return rows.na.fill(0, list(sums)).select("total", *distinct, stages, *[n for n in sums if n != "total"])


def normalization_violations(companies: DataFrame, deals: DataFrame, owners: DataFrame) -> DataFrame:
    """Every mixed-case value with its row count and expected form.

    One scan per table: the fields are unpivoted, filtered and counted
    together.  Pass the fact tables already limited to a snapshot.
    """
    parts = []
    for name, df in {"companies": companies, "deals": deals, "owners": owners}.items():
        values = df.select(*_LISTED_FIELDS[name]).unpivot([], _LISTED_FIELDS[name], "field", "value")
        parts.append(values.filter(F.col("value") != F.lower("value")).withColumn("table", F.lit(name)))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table", "field", F.col("value").alias("mixed_case_value"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("expected_value", F.lower("mixed_case_value"))
    )


def profile_companies(companies: DataFrame) -> DataFrame:
    return _profile(
        companies,
        "lifecycle_stage",
        "lifecycle_stages",
        {"unique_lifecycle_stages": "_stage", "unique_owners": "owner_id"},
        ["lifecycle_stage", "lead_status"],
    )


def profile_deals(deals: DataFrame) -> DataFrame:
    return _profile(
        deals,
        "deal_stage",
        "deal_stages",
        {"unique_deal_stages": "_stage", "unique_associated_companies": "associated_company_id"},
        ["deal_stage", "deal_type"],
    )


def profile_stage_mapping(mapping: DataFrame) -> DataFrame:
    return _profile(
        mapping,
        "combined_stage",
        "combined_stages",
        {},
        ["combined_stage", "lifecycle_stage", "lead_status", "deal_stage"],
    )


def mapping_case_issues(mapping: DataFrame) -> DataFrame:
    """One row per mapping value that is not lower case."""
    fields = ["lifecycle_stage", "lead_status", "deal_stage", "combined_stage"]
    return (
        mapping.select(F.col("combined_stage").alias("mapping"), *fields)
        .unpivot("mapping", fields, "field", "value")
        .filter(F.col("value") != F.lower("value"))
        .withColumn("expected", F.lower("value"))
    )


def profile_owners(owners: DataFrame) -> DataFrame:
    return owners.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.lower("email")).alias("unique_emails"),
        F.coalesce(F.sum(_mixed("email")), F.lit(0).cast("bigint")).alias("email_issues"),
    )


def source_summary(
    companies: DataFrame, deals: DataFrame, mapping: DataFrame, n: int | None = None
) -> DataFrame:
    """Rows and distinct stages per scoring input.

    All stages are listed.  With ``n``, deal and mapping stages end after the
    first ``n`` in sort order, and ``left_out`` counts the others.
    """
    inputs = {
        "companies": (companies, "lifecycle_stage"),
        "deals": (deals, "deal_stage"),
        "stage_mapping": (mapping, "combined_stage"),
    }
    spark = companies.sparkSession
    names = literal_table(spark, [(name,) for name in inputs], "source_table string")
    seen = (
        reduce(
            DataFrame.unionByName,
            [
                df.select(F.lit(name).alias("source_table"), F.lower(field).alias("stage"))
                for name, (df, field) in inputs.items()
            ],
        )
        .groupBy("source_table", "stage")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = seen.groupBy("source_table").agg(F.sum("n").alias("record_count"))
    stages = seen.filter("stage IS NOT NULL")
    in_full = (F.col("source_table") == "companies") if n else F.lit(True)
    listed = stages.filter(in_full).groupBy("source_table").agg(F.sort_array(F.collect_list("stage")).alias("sample_values"))
    if n:
        cut = sample_values(stages.filter(~in_full), ["source_table"], "stage", n, count="n")
        listed = listed.unionByName(cut)
    found = stages.groupBy("source_table").agg(F.count(F.lit(1)).alias("found"))
    return (
        names.join(counts, "source_table", "left")
        .join(listed, "source_table", "left")
        .join(found, "source_table", "left")
        .select(
            "source_table",
            F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count"),
            F.array_join("sample_values", ",").alias("stages"),
            F.coalesce(F.col("found") - F.size("sample_values"), F.lit(0)).cast("bigint").alias("left_out"),
        )
    )


def snapshot_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_distinct("snapshot_id").alias("total_snapshots"),
        F.count(F.lit(1)).alias("total_records"),
        F.min("snapshot_id").alias("earliest_snapshot"),
        F.max("snapshot_id").alias("latest_snapshot"),
    )


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """Non-NULL rows and percentage per field, from one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f).alias(f) for f in fields])
    return counts.unpivot("_rows", fields, "field", "non_null").select(
        "field",
        "non_null",
        F.when(F.col("_rows") > 0, F.col("non_null") * 100.0 / F.col("_rows")).alias("percent"),
    )


def snapshot_format_profile(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` snapshot ids with most rows and how each is written."""
    top = (
        df.groupBy("snapshot_id")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.col("record_count").desc(), "snapshot_id")
        .limit(n)
    )
    return top.select("*", snapshot_id_format(F.col("snapshot_id")).alias("f")).select(
        "snapshot_id", "record_count", "f.*"
    )


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def required_data_exists(
    companies: DataFrame, deals: DataFrame, owners: DataFrame, stages: DataFrame
) -> DataFrame:
    """The four inputs scoring needs, with the verdict that none is empty."""
    checks = {
        "snapshot_companies": companies,
        "snapshot_deals": deals,
        "owners_data": owners,
        "deal_stages_data": stages,
    }
    counts = table_row_counts(checks)
    wide = counts.agg(
        *[F.max(F.when(F.col("table") == n, F.col("rows"))).alias(n) for n in checks],
        F.bool_and(F.col("rows") > 0).alias("all_present"),
    )
    return wide


def required_data_per_snapshot(
    snapshots: DataFrame, companies: DataFrame, deals: DataFrame, owners: DataFrame, stages: DataFrame
) -> DataFrame:
    """The same verdict for each of ``snapshots(snapshot_id)``, in one pass over each input."""

    def sized(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias(name))

    facts = {"snapshot_companies": companies, "snapshot_deals": deals}
    wide = snapshots.select("snapshot_id").distinct()
    for name, df in facts.items():
        wide = wide.join(sized(df, name), "snapshot_id", "left").na.fill(0, [name])
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    wide = wide.withColumns({"owners_data": count(owners), "deal_stages_data": count(stages)})
    parts = [*facts, "owners_data", "deal_stages_data"]
    return wide.withColumn("all_present", F.least(*[F.col(c) for c in parts]) > 0)

"""Reading the snapshot registry: an append-only log, newest row wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagetally.functions.text import append_note

# --- fixed values: triggers and states ----------------------------------------------------
INGEST_COMPLETION = "ingest_completion"
INGEST_FAILURE = "ingest_failure"
SCORING_START = "scoring_start"
SCORING_COMPLETION = "scoring_completion"
SCORING_FAILURE = "scoring_failure"
EXPORT_IMPORT = "excel_import"
MIGRATION = "production_migration_step3"
AUDIT = "integrity_verification_step5"
RESCORE_REQUEST = "rescore_step4"
STARTED, COMPLETED, FAILED = "started", "completed", "failed"


#: Control columns of the log: number of the change, triggers whose earlier rows of the
#: snapshot it removes, and the status and note it gives to the snapshot's earlier rows.
CONTROL = {"_entry": "bigint", "_removes": "array<string>", "_status": "string", "_note": "string"}


def current_rows(log: DataFrame, keep_entry: bool = False) -> DataFrame:
    """The registry rows in force: a log folded by its control rows.

    A row goes if a later change removes its trigger from its snapshot; every
    later change of the snapshot's status sets its status, and adds its note.
    Rows of one change don't affect each other.  One shuffle by snapshot.
    """
    plain = [c for c in log.columns if c not in CONTROL]
    entry = F.coalesce("_entry", F.lit(0).cast("bigint"))
    control = F.col("_removes").isNotNull() | F.col("_status").isNotNull()
    change = F.struct(entry.alias("at"), F.col("_status").alias("status"), F.col("_note").alias("note"))
    snapshot = Window.partitionBy("snapshot_id")
    rows = log.withColumn("_at", entry).withColumns(
        {
            "_is_control": control,
            "_gone": F.collect_list(F.when(F.col("_removes").isNotNull(), F.struct("_at", "_removes"))).over(snapshot),
            "_changes": F.array_sort(F.collect_list(F.when(F.col("_status").isNotNull(), change)).over(snapshot)),
        }
    )
    removed = F.exists("_gone", lambda g: (g["_at"] > F.col("_at")) & F.array_contains(g["_removes"], F.col("triggered_by")))
    rows = rows.filter(~F.col("_is_control")).filter(~F.coalesce(removed, F.lit(False)))
    later = F.filter("_changes", lambda c: c["at"] > F.col("_at"))
    noted = F.aggregate(
        later, F.col("notes"), lambda done, c: F.when(c["note"].isNull(), done).otherwise(append_note(done, c["note"]))
    )
    status = F.when(F.size(later) > 0, F.element_at(later, -1)["status"]).otherwise(F.col("status"))
    rows = rows.withColumns({"status": status, "notes": noted})
    return rows.select(*plain, *([F.col("_at").alias("_entry")] if keep_entry else []))


def _newest_first(registry: DataFrame) -> DataFrame:
    """Newest first; rows of the same instant are ordered by snapshot and trigger."""
    return registry.orderBy(
        F.col("record_timestamp").desc(), F.col("snapshot_id").desc(), "triggered_by"
    )


def latest_snapshot(registry: DataFrame, status: str | None = None) -> DataFrame:
    if status is not None:
        registry = registry.filter(F.col("status") == status)
    return _newest_first(registry).limit(1)


def latest_ingested_snapshot(registry: DataFrame) -> DataFrame:
    return latest_snapshot(registry.filter(F.col("triggered_by") == INGEST_COMPLETION), COMPLETED)


def recent_snapshots(registry: DataFrame, n: int = 10, status_like: str | None = None) -> DataFrame:
    if status_like is not None:
        registry = registry.filter(F.col("status").like(status_like))
    return _newest_first(registry).limit(n)


def completed_snapshots(registry: DataFrame) -> DataFrame:
    """Distinct completed snapshots with their first completion time, oldest first."""
    return (
        registry.filter(F.col("status") == COMPLETED)
        .groupBy("snapshot_id")
        .agg(F.min("record_timestamp").alias("first_completed"))
        .orderBy("first_completed", "snapshot_id")
    )


def distinct_snapshots(df: DataFrame) -> DataFrame:
    return df.select("snapshot_id").distinct().orderBy("snapshot_id")


def scoring_state(registry: DataFrame) -> DataFrame:
    """done / failed / pending per snapshot; a completion outweighs a failure."""

    def last(trigger):
        return F.max(F.when(F.col("triggered_by") == trigger, F.col("record_timestamp")))

    return (
        registry.groupBy("snapshot_id")
        .agg(last(SCORING_COMPLETION).alias("completed_at"), last(SCORING_FAILURE).alias("failed_at"))
        .withColumn(
            "state",
            F.when(F.col("completed_at").isNotNull(), "done")
            .when(F.col("failed_at").isNotNull(), "failed")
            .otherwise("pending"),
        )
    )


def scored_in_batch(registry: DataFrame, batch_name: str) -> DataFrame:
    """Snapshots whose last scoring was begun by a named batch of a stream, and completed."""
    begun = (F.col("triggered_by") == SCORING_START) & F.endswith("notes", F.lit(f"({batch_name})"))
    return (
        registry.groupBy("snapshot_id")
        .agg(F.max(begun).alias("_begun"), F.max(F.col("triggered_by") == SCORING_COMPLETION).alias("_done"))
        .filter("_begun AND _done")
        .select("snapshot_id")
    )


def unfinished_loads(registry: DataFrame) -> DataFrame:
    """``(snapshot_id, load)`` of loads that were logged as started, and not as completed."""
    named = registry.withColumn("load", F.nullif(F.regexp_extract("notes", r"\((load-[0-9a-f]{32})\)", 1), F.lit("")))
    return (
        named.filter(F.col("load").isNotNull())
        .groupBy("snapshot_id", "load")
        .agg(F.max(F.col("status") == COMPLETED).alias("done"))
        .filter("NOT done")
        .select("snapshot_id", "load")
    )


def latest_snapshot_rows(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the newest completed snapshot, picked by a scalar subquery."""
    newest = registry.filter(F.col("status").like("%completed%")).agg(
        F.max_by("snapshot_id", F.struct("record_timestamp", "snapshot_id")).alias("snapshot_id")
    )
    return fact.filter(F.col("snapshot_id") == newest.scalar())


def scores_by_owner(history: DataFrame) -> DataFrame:
    """Score history rows, best first."""
    return history.select("owner_id", "combined_stage", "num_companies", "total_score").orderBy(
        F.col("total_score").desc(), "owner_id", "combined_stage"
    )


def _per_snapshot(fact: DataFrame, id_field: str, name: str) -> DataFrame:
    return fact.groupBy("snapshot_id").agg(
        F.count(id_field).alias(f"{name}_ids"), F.count(F.lit(1)).alias(f"{name}_rows")
    )


def snapshot_details(
    registry: DataFrame, companies: DataFrame, deals: DataFrame, multiply: bool = True
) -> DataFrame:
    """Registry rows with company and deal counts of their snapshot.

    ``multiply=True`` gives the counts of the plain three-way join, in which
    every company row meets every deal row of the snapshot and repeated
    registry rows repeat the product.  Both are worked out from per-snapshot
    counts, so the product itself is never built.  ``multiply=False`` gives the
    counts one would expect.
    """
    keys = ["snapshot_id", "triggered_by", "status", "record_timestamp"]
    rows = (
        registry.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_repeats"))
        .join(_per_snapshot(companies, "company_id", "_c"), "snapshot_id", "left")
        .join(_per_snapshot(deals, "deal_id", "_d"), "snapshot_id", "left")
        .na.fill(0, ["_c_ids", "_c_rows", "_d_ids", "_d_rows"])
    )
    company, deal = F.col("_c_ids"), F.col("_d_ids")
    if multiply:
        one = F.lit(1).cast("bigint")
        company = company * F.greatest("_d_rows", one) * F.col("_repeats")
        deal = deal * F.greatest("_c_rows", one) * F.col("_repeats")
    return rows.select(
        *keys,
        company.alias("company_count"),
        deal.alias("deal_count"),
        (company + deal).alias("total_count"),
    )


def rescore_summary(results: DataFrame) -> DataFrame:
    """Overall status and counts over per-snapshot results (``status`` column)."""
    ok = F.col("status") == "success"
    return results.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.coalesce(F.sum(F.when(ok, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("succeeded"),
        F.coalesce(F.sum(F.when(ok, 0).otherwise(1)), F.lit(0)).cast("bigint").alias("failed"),
    ).select(
        F.when(F.col("failed") == 0, "success")
        .when(F.col("succeeded") > 0, "partial_success")
        .otherwise("error")
        .alias("status"),
        "discovered",
        "succeeded",
        "failed",
    )

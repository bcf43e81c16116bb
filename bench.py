"""Wall times of the headline jobs; prints one JSON line.

Set-up (deriving the CRM tables and storing them in a warehouse) is not timed.
Each query runs once to warm up, then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from stagetally.checks.base import AS_OF, SNAPSHOT, Bed  # noqa: E402
from stagetally.functions.events import parse_event  # noqa: E402
from stagetally.operators import history, integrity, profiles, registry  # noqa: E402
from stagetally.operators.exports import resolve_owner_names  # noqa: E402
from stagetally.operators.scoring import score_history, score_units  # noqa: E402
from stagetally.plans import audit, score  # noqa: E402
from stagetally.plans.report import owner_history_report  # noqa: E402
from stagetally.sources.warehouse import as_timestamp  # noqa: E402

RUNS = 3


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )


def drain(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def jobs(bed: Bed) -> dict:
    from stagetally.checks.scalars import event_payloads
    from stagetally.checks.shaping import _searched_names
    from pyspark.sql import functions as F

    wh = bed.warehouse("companies", "deals", "owners", "deal_stage_reference", "snapshot_registry")
    years = [f"{y}-01-01T00:00:00Z" for y in range(1995, 2002)]
    score.score_snapshots(wh, years, as_timestamp(AS_OF))
    read = wh.read
    messages = bed.scratch("messages")
    event_payloads(bed).select("value").write.text(messages)
    lookup = bed.table("nation").select(
        F.lower("n_name").alias("name"),
        F.col("n_nationkey").cast("string").alias("owner_id"),
        F.col("n_nationkey").alias("rank"),
    )

    def units():
        return score_units(
            read("companies"), read("deals"), read("deal_stage_reference"), read("stage_mapping"),
            F.col("snapshot_id"),
        )

    def audited():
        return {t: wh.read(t) for t in wh.tables()}

    return {
        "score_units": lambda: drain(units()),
        "score_one_snapshot_job": lambda: score.score_snapshot(wh, SNAPSHOT, as_timestamp(AS_OF)),
        "score_all_snapshots_job": lambda: score.score_snapshots(wh, years, as_timestamp(AS_OF)),
        "score_history": lambda: drain(score_history(read("pipeline_units_snapshot"), F.col("snapshot_id"))),
        "owner_history_report": lambda: drain(owner_history_report(wh)),
        "integrity_audit": lambda: audit.integrity_audit(wh, bed.scratch("report"), as_timestamp(AS_OF)),
        "orphan_references": lambda: drain(integrity.orphan_references(audited())),
        "snapshot_distribution": lambda: drain(integrity.snapshot_distribution(read("companies"), read("deals"))),
        "duplicate_records": lambda: drain(
            integrity.duplicate_summary(bed.table("lineitem"), ["l_orderkey", "l_linenumber"])
        ),
        "normalization_violations": lambda: drain(
            profiles.normalization_violations(read("companies"), read("deals"), read("owners"))
        ),
        "registry_snapshot_details": lambda: drain(
            registry.snapshot_details(read("snapshot_registry"), read("companies"), read("deals"))
        ),
        "snapshot_scan": lambda: drain(wh.read_table_for_snapshot("companies", SNAPSHOT)),
        "parse_events": lambda: drain(
            bed.spark.read.text(messages).select(parse_event(F.col("value")).alias("e"))
        ),
        "owner_name_to_id": lambda: drain(resolve_owner_names(_searched_names(bed), "owner", lookup)),
        "owner_rank": lambda: drain(
            history.owner_rank(
                read("pipeline_units_snapshot")
                .groupBy("snapshot_id", "owner_id")
                .agg(F.sum("adjusted_score").alias("total_score"))
            )
        ),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, run in jobs(Bed(spark, folder)).items():
        run()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

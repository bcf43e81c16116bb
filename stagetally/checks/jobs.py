"""Registry writes, streams and composite jobs (survey sections 2.9 to 2.12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.checks.aggregates import BLANK_SQL, CASE_SQL, CONSISTENCY_SQL, DESCRIPTION_SQL, REQUIRED_SQL, format_sql
from stagetally.checks.base import AS_OF, SNAPSHOT, Bed, check, ts
from stagetally.checks.scalars import PAYLOAD_TYPE_SQL, event_payloads
from stagetally.checks.scans import (
    landed_companies,
    landed_deals,
    landed_owners,
    landed_stages,
    set_modified,
    written_exports,
)
from stagetally.checks.shaping import _ORPHANS
from stagetally.functions import events
from stagetally.operators import registry as log
from stagetally.plans import audit, imports, ingest, migrate, registry_log, score
from stagetally.schemas import PARTITIONED
from stagetally.sources.warehouse import Warehouse, as_timestamp
from stagetally.streaming import scoring as streams

_NOW = as_timestamp(AS_OF)


# -- registry ---------------------------------------------------------------------------------------


def _log_counts(wh: Warehouse) -> DataFrame:
    return (
        wh.read("snapshot_registry")
        .groupBy("snapshot_id", "triggered_by", "status")
        .agg(F.count(F.lit(1)).alias("entries"))
    )


_LOG_COUNTS = f"SELECT {ts('snapshot_id')}, triggered_by, status, count(*) AS entries FROM ({{rows}}) r GROUP BY ALL"
_LOG = "SELECT snapshot_id, triggered_by, status FROM year_registry"


@check("G01", _LOG_COUNTS.format(rows=f"""{_LOG} UNION ALL SELECT TIMESTAMP '2000-01-01', t, s
FROM (VALUES ('manual', 'started'), ('ingest_completion', 'completed'), ('ingest_failure', 'failed'), ('scoring_completion', 'completed')) v(t, s)"""))
def register_event(bed: Bed) -> DataFrame:
    wh = Warehouse(bed.spark, bed.scratch("warehouse"))
    wh.append_table(bed.year_registry, "snapshot_registry")
    registry_log.register_ingest_start(wh, SNAPSHOT, _NOW)
    registry_log.register_ingest_completion(wh, SNAPSHOT, {"companies": 2}, {"owners": 1}, _NOW)
    registry_log.register_ingest_failure(wh, SNAPSHOT, "lost", _NOW)
    registry_log.register_scoring_completion(wh, SNAPSHOT, 5, _NOW, "done")
    return _log_counts(wh)


@check("G02", _LOG_COUNTS.format(rows=f"""{_LOG} WHERE NOT (snapshot_id = TIMESTAMP '2000-01-01' AND triggered_by IN ('scoring_start', 'scoring_completion'))
UNION ALL SELECT TIMESTAMP '2000-01-01', 'scoring_start', 'started'"""))
def register_scoring_start(bed: Bed) -> DataFrame:
    wh = bed.warehouse("snapshot_registry")
    registry_log.register_scoring_start(wh, [SNAPSHOT], _NOW)
    return _log_counts(wh)


@check("G04", _LOG_COUNTS.format(rows=f"""{_LOG} WHERE NOT (snapshot_id = TIMESTAMP '2000-01-01' AND triggered_by IN
('scoring_start', 'scoring_completion', 'scoring_failure')) UNION ALL SELECT TIMESTAMP '2000-01-01', 'scoring_failure', 'failed'"""))
def register_scoring_failure(bed: Bed) -> DataFrame:
    wh = bed.warehouse("snapshot_registry")
    registry_log.register_scoring_failure(wh, [SNAPSHOT], "lost", _NOW)
    return _log_counts(wh)


@check("G05", f"""SELECT {ts("snapshot_id")}, {ts("record_timestamp")}, triggered_by,
CASE WHEN year(snapshot_id) = 2000 THEN 'checked' ELSE status END AS status,
CASE WHEN year(snapshot_id) = 2000 THEN concat(notes, ' | by hand') ELSE notes END AS notes FROM year_registry""")
def update_status(bed: Bed) -> DataFrame:
    wh = bed.warehouse("snapshot_registry")
    registry_log.update_status(wh, SNAPSHOT, "checked", "by hand")
    return wh.read("snapshot_registry")


@check("G06", """SELECT strftime(snapshot_id, '%Y-%m-%d %H:%M:%S.%f') AS snapshot_id,
strftime(max(record_timestamp) FILTER (WHERE triggered_by = 'scoring_completion'), '%Y-%m-%d %H:%M:%S.%f') AS completed_at,
strftime(max(record_timestamp) FILTER (WHERE triggered_by = 'scoring_failure'), '%Y-%m-%d %H:%M:%S.%f') AS failed_at,
CASE WHEN count(*) FILTER (WHERE triggered_by = 'scoring_completion') > 0 THEN 'done'
     WHEN count(*) FILTER (WHERE triggered_by = 'scoring_failure') > 0 THEN 'failed' ELSE 'pending' END AS state
FROM (SELECT date_trunc('hour', record_timestamp) AS snapshot_id, record_timestamp, triggered_by FROM registry) r GROUP BY r.snapshot_id""")
def scoring_state(bed: Bed) -> DataFrame:
    hourly = bed.registry.withColumn("snapshot_id", F.date_trunc("hour", "record_timestamp"))
    return log.scoring_state(hourly)


@check("G07", """SELECT CASE WHEN bad = 0 THEN 'success' WHEN ok > 0 THEN 'partial_success' ELSE 'error' END AS status,
n AS discovered, ok AS succeeded, bad AS failed
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE e = 0) AS ok, count(*) FILTER (WHERE e > 0) AS bad
      FROM (SELECT date_trunc('hour', ts) AS s, count(*) FILTER (WHERE event_type = 'error') AS e FROM events GROUP BY 1) h) t""")
def rescore_summary(bed: Bed) -> DataFrame:
    hours = bed.table("events").groupBy(F.date_trunc("hour", "ts").alias("snapshot_id"))
    results = hours.agg(
        F.when(F.max(F.col("event_type") == "error"), "error").otherwise("success").alias("status")
    )
    return log.rescore_summary(results)


# -- scoring ------------------------------------------------------------------------------------------


_SCORES = "SELECT strftime(snapshot_id, '%Y') AS year, owner_id, combined_stage, num_companies, total_score FROM history"
_INPUTS = ("companies", "deals", "deal_stage_reference", "snapshot_registry")


def _scores(wh: Warehouse) -> DataFrame:
    return wh.read("pipeline_score_history").select(
        F.date_format("snapshot_id", "yyyy").alias("year"),
        "owner_id", "combined_stage", "num_companies", "total_score",
    )


@check("K01", f"{_SCORES} WHERE year(snapshot_id) IN (1999, 2000)")
def score_snapshots(bed: Bed) -> DataFrame:
    """Two snapshots scored together, one of them a second time."""
    wh = bed.warehouse(*_INPUTS)
    score.score_snapshots(wh, ["1999-01-01T00:00:00Z", SNAPSHOT], _NOW)
    score.score_snapshot(wh, SNAPSHOT, _NOW)
    return _scores(wh)


@check("K02", f"{_SCORES} WHERE snapshot_id IN (SELECT snapshot_id FROM year_registry WHERE status = 'completed')")
def rescore_all(bed: Bed) -> DataFrame:
    wh = bed.warehouse(*_INPUTS)
    score.rescore_all(wh, _NOW)
    return _scores(wh)


# -- ingest, import, migration ---------------------------------------------------------------------------


@check("K03", """
SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, concat('Deal ', o_orderkey) AS deal_name, lower(o_orderpriority) AS deal_stage,
  CASE WHEN o_orderkey % 17 > 0 THEN o_totalprice END AS amount,
  CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS associated_company_id,
  '2000-01-01 00:00:00.000000' AS snapshot_id, (SELECT count(*) FROM customer) AS companies, (SELECT count(*) FROM supplier) AS owners,
  (SELECT count(*) FROM part) AS deal_stage_reference
FROM orders""")
def ingest_snapshot(bed: Bed) -> DataFrame:
    """Landed JSON to tables; the counts are those the job reports."""
    wh = Warehouse(bed.spark, bed.scratch("warehouse"))
    paths = {
        "companies": landed_companies(bed),
        "deals": landed_deals(bed),
        "owners": landed_owners(bed),
        "deal_stage_reference": landed_stages(bed),
    }
    counts = ingest.ingest_snapshot(wh, paths, ingest.object_configs("owner_id"), SNAPSHOT, dry_run=False, as_of=_NOW)
    rows = wh.read_table_for_snapshot("deals", SNAPSHOT)
    fields = ["deal_id", "deal_name", "deal_stage", "amount", "associated_company_id", "snapshot_id"]
    reported = {
        t: counts.filter(F.col("table") == t).select("rows").scalar()
        for t in ("companies", "owners", "deal_stage_reference")
    }
    return rows.select(*fields, *[c.alias(t) for t, c in reported.items()])


@check("K04", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'deal' AS kind, lower(o_orderpriority) AS stage, o_totalprice AS amount,
  CAST(o_custkey % 25 AS VARCHAR) AS owner_id, CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey AS VARCHAR) END AS company_id,
  CASE o_orderkey % 3 WHEN 0 THEN '2025-03-12 05:00:00.000000' ELSE '2025-06-08 06:00:00.000000' END AS snapshot_id
FROM orders WHERE o_orderkey % 3 <> 1
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'company',
  CASE WHEN c_custkey % 7 = 0 THEN 'salesqualifiedlead' ELSE lower(c_mktsegment) END, NULL, CAST(c_nationkey AS VARCHAR), NULL,
  CASE c_custkey % 2 WHEN 0 THEN '2025-03-12 05:00:00.000000' ELSE '2025-06-08 06:00:00.000000' END
FROM customer WHERE c_custkey % 50 > 1""")
def import_exports(bed: Bed) -> DataFrame:
    """Dated exports, paired by their modification times, to tables; the date without a company export is left out."""
    wh = Warehouse(bed.spark, bed.scratch("warehouse"))
    names = bed.table("nation").select(
        F.lower("n_name").alias("name"),
        F.col("n_nationkey").cast("string").alias("owner_id"),
        F.col("n_nationkey").alias("rank"),
    )
    path = written_exports(bed)
    # The earlier time of a date's two files is the snapshot id.
    set_modified(bed, path, "company-2025-03-12", "2025-03-12T05:00:00Z")
    set_modified(bed, path, "deals-2025-03-12", "2025-03-12T07:30:00Z")
    set_modified(bed, path, "deals-2025-06-01", "2025-06-01T06:00:00Z")
    set_modified(bed, path, "company-2025-06-08", "2025-06-09T00:00:00Z")
    set_modified(bed, path, "deals-2025-06-08", "2025-06-08T06:00:00Z")
    imports.import_exports(wh, path, names, as_of=_NOW)
    deals = wh.read("deals").select(
        F.col("deal_id").alias("id"), F.lit("deal").alias("kind"), F.col("deal_stage").alias("stage"),
        "amount", "owner_id", F.col("associated_company_id").alias("company_id"), "snapshot_id",
    )
    companies = wh.read("companies").select(
        F.col("company_id").alias("id"), F.lit("company").alias("kind"), F.col("lifecycle_stage").alias("stage"),
        F.lit(None).cast("double").alias("amount"), "owner_id", F.lit(None).cast("string").alias("company_id"), "snapshot_id",
    )
    return deals.unionByName(companies)


def _old_layout(df: DataFrame) -> DataFrame:
    """Text snapshot ids: a bare date in even years, a time without zone in odd ones."""
    day = F.date_format("snapshot_id", "yyyy-MM-dd")
    even = F.year("snapshot_id") % 2 == 0
    return df.withColumn("snapshot_id", F.when(even, day).otherwise(F.concat(day, F.lit("T10:30:00"))))


@check("K05", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", strftime(snapshot_id, '%Y-%m-%d 06:00:00.000000') AS snapshot_id, count(*) AS source_rows,
    count(*) AS target_rows, TRUE AS verified FROM {t} GROUP BY snapshot_id""" for t in ("companies", "deals")))
def migrate_snapshots(bed: Bed) -> DataFrame:
    """All snapshots migrated twice; the second run replaces the first."""
    wh = Warehouse(bed.spark, bed.scratch("warehouse"))
    sources = {"companies": _old_layout(bed.companies), "deals": _old_layout(bed.deals)}
    migrate.migrate_snapshots(sources, wh, as_of=_NOW)
    return migrate.migrate_snapshots(sources, wh, as_of=_NOW)


@check("K05", f"""SELECT deal_id, lower(trim(deal_stage)) AS deal_stage, lower(trim(deal_type)) AS deal_type, amount,
nullif(owner_id, '') AS owner_id, strftime(snapshot_id, '%Y-%m-%d 06:00:00.000000') AS snapshot_id FROM deals""")
def migrated_deals(bed: Bed) -> DataFrame:
    """The rows a migration writes."""
    rows = migrate.migrated_rows(_old_layout(bed.deals), "deals", F.lit(_NOW))
    return rows.select("deal_id", "deal_stage", "deal_type", "amount", "owner_id", "snapshot_id")


@check("K06", """SELECT owner_id, lower(trim(email)) AS email, first_name, last_name, CAST(NULL AS VARCHAR) AS user_id, active,
'2024-01-01 00:00:00.000000' AS record_timestamp FROM reps""")
def copy_reference(bed: Bed) -> DataFrame:
    """Owners copied over older ones, from a source that lacks a column."""
    wh = bed.warehouse("owners")
    migrate.copy_reference({"owners": bed.reps.drop("user_id")}, wh, _NOW)
    return wh.read("owners")


# -- audit ----------------------------------------------------------------------------------------------


def _duplicates_sql(table: str, source: str, keys: list[str]) -> str:
    names = ", ".join(keys)
    return f"""SELECT '{table}' AS "table", '({names})' AS field, 'duplicate_records' AS issue_type, 'critical' AS severity,
    CAST(sum(n - 1) AS BIGINT) AS "count", concat(count(*), ' duplicate groups') AS sample_values
    FROM (SELECT count(*) AS n FROM {source} GROUP BY {names} HAVING count(*) > 1) d HAVING count(*) > 0"""


AUDIT_SQL = " UNION ALL ".join(
    f"SELECT \"table\", field, issue_type, severity, \"count\", sample_values, {DESCRIPTION_SQL} FROM ({part}) p{i}"
    for i, part in enumerate([
        BLANK_SQL,
        f"""SELECT "table", field, 'orphaned_reference' AS issue_type, 'critical' AS severity, count(*) AS "count",
        array_to_string(list_slice(list_sort(list(DISTINCT value)), 1, 5), '|') AS sample_values
        FROM ({_ORPHANS}) o GROUP BY "table", field""",
        REQUIRED_SQL,
        format_sql("owners"),
        CASE_SQL,
        CONSISTENCY_SQL,
        _duplicates_sql("companies", "companies", ["company_id", "snapshot_id"]),
        _duplicates_sql("deals", "deals", ["deal_id", "snapshot_id"]),
        _duplicates_sql("owners", "owners", ["owner_id"]),
        _duplicates_sql("snapshot_registry", "year_registry", ["snapshot_id", "triggered_by", "record_timestamp"]),
        """SELECT t AS "table", 'snapshot_id' AS field, 'anomalous_distribution' AS issue_type, 'warning' AS severity, n AS "count",
        strftime(s, '%Y-%m-%d %H:%M:%S') AS sample_values
        FROM (SELECT *, avg(n) OVER (PARTITION BY t) AS mean FROM (
              SELECT 'companies' AS t, snapshot_id AS s, count(DISTINCT company_id) AS n FROM companies GROUP BY 2
              UNION ALL SELECT 'deals', snapshot_id, count(DISTINCT deal_id) FROM deals GROUP BY 2) a) b
        WHERE n / mean < 0.5 OR n / mean > 2.0""",
    ])
)


@check("K07", AUDIT_SQL)
def integrity_audit(bed: Bed) -> DataFrame:
    """All eight checks over a stored warehouse."""
    wh = bed.warehouse(*bed.audited)
    report = audit.integrity_audit(wh, bed.scratch("report"), _NOW)
    return report.issues


@check("K07", AUDIT_SQL)
def integrity_audit_by_parts(bed: Bed) -> DataFrame:
    """The same after a first audit of other data: only the snapshots that changed since are read."""
    earlier = F.year("snapshot_id") <= 1999
    frames = dict(bed.audited)
    wh = Warehouse(bed.spark, bed.scratch("warehouse"))

    def given():
        # Scores are added up from the units that are stored by then, which are not joined again for them.
        for name, df in frames.items():
            yield name, bed.scored(wh.read("pipeline_units_snapshot")) if name == "pipeline_score_history" else df

    for name, df in given():
        wh.append_table(df.filter(earlier) if name in PARTITIONED else df, name)
    audit.integrity_audit(wh, None, _NOW)
    wh.append_table(frames["companies"].filter(F.year("snapshot_id") == 1999), "companies")
    for name, df in given():
        if name in PARTITIONED:
            wh.replace_snapshots(df, name, [f"{y}-01-01T00:00:00Z" for y in (1999, 2000, 2001)])
    wh.forget_trigger(log.AUDIT)
    return audit.integrity_audit(wh, None, _NOW).issues


# -- streams ----------------------------------------------------------------------------------------------


def _message_files(bed: Bed, rows: DataFrame) -> str:
    path = bed.scratch("messages")
    rows.select("value").write.text(path)
    return path


_VALID_COMPLETED = "event_type = 'purchase' AND event_id % 5 < 4"


@check("T01", f"""{_SCORES} WHERE year(snapshot_id) IN
(SELECT 1995 + event_id % 7 FROM events WHERE {_VALID_COMPLETED})""")
def score_on_event(bed: Bed) -> DataFrame:
    """Scores written by the stream."""
    wh = bed.warehouse(*_INPUTS)
    messages = streams.read_messages(bed.spark, _message_files(bed, event_payloads(bed)))
    stream = streams.score_on_event(messages, wh, bed.scratch("score-on-event"), available_now=True)
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()
    return _scores(wh)


@check("T02", f"""SELECT CASE WHEN event_id % 5 = 4 THEN 'invalid' WHEN event_type = 'purchase' THEN 'score'
WHEN event_type = 'signup' THEN 'rescore_all' ELSE 'ignore' END AS route,
CASE WHEN event_id % 5 = 4 THEN 'unknown' WHEN event_type = 'signup' THEN 'crm.rescore.all' ELSE {PAYLOAD_TYPE_SQL} END AS event_type,
CASE WHEN event_id % 5 < 4 THEN concat(1995 + event_id % 7, '-01-01T00:00:00Z') END AS snapshot_id, count(*) AS messages
FROM events GROUP BY ALL""")
def route_events(bed: Bed) -> DataFrame:
    routed = streams.route_events(event_payloads(bed, rescore=True).select("value"))
    return routed.groupBy("route", "event_type", "snapshot_id").agg(F.count(F.lit(1)).alias("messages"))


@check("T03", """SELECT concat('{"type":"crm.', event_type, '","version":"1.0","timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
'","source":"crm-ingest-dev","environment":"dev","data":{"event_id":', event_id, '}}') AS value FROM events""")
def publish_events(bed: Bed) -> DataFrame:
    """Envelopes published by a stream to a text sink and read back."""
    rows = bed.table("events").select(
        events.build_event(
            F.concat(F.lit("crm."), F.col("event_type")),
            F.struct(F.col("event_id")),
            F.col("ts").cast("timestamp"),
            "dev",
        ).alias("value")
    )
    target = bed.scratch("published")
    messages = streams.read_messages(bed.spark, _message_files(bed, rows))
    stream = streams.publish_events(messages, target, bed.scratch("publish-events"))
    stream.awaitTermination()
    return bed.spark.read.text(target)

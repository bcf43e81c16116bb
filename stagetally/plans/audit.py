"""The integrity audit: all checks, the summaries and the stored report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame

from stagetally.operators import integrity
from stagetally.operators import registry as log
from stagetally.operators.audit_parts import merged_counts, merged_issues
from stagetally.plans import registry_log
from stagetally.plans.audit_store import audit_parts
from stagetally.schemas import COUNTED_TABLES
from stagetally.session import cut_lineage
from stagetally.sources.warehouse import Warehouse, as_timestamp, table_counts, write_report


@dataclass(frozen=True)
class AuditReport:
    issues: DataFrame
    counts: DataFrame
    rollup: DataFrame
    score: DataFrame
    recommendations: DataFrame


def audit_issues(tables: Mapping[str, DataFrame], expected: Iterable[str] = ()) -> DataFrame:
    """The issues of all eight checks over the given tables; an expected one that is absent is an issue itself."""
    checks = [
        integrity.counter_issues(tables),
        integrity.value_issues(tables),
        integrity.snapshot_consistency(tables),
        integrity.duplicate_records(tables),
    ]
    if "companies" in tables and "deals" in tables:
        distribution = integrity.snapshot_distribution(tables["companies"], tables["deals"])
        checks.append(integrity.distribution_anomalies(distribution))
    missing = [t for t in expected if t not in tables]
    if missing:
        checks.append(integrity.missing_tables(next(iter(tables.values())).sparkSession, missing))
    return reduce(DataFrame.unionByName, checks)


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts({t: tables[t] for t in COUNTED_TABLES if t in tables})


def audit_report(
    tables: Mapping[str, DataFrame], issues: DataFrame | None = None, counts: DataFrame | None = None
) -> AuditReport:
    issues = audit_issues(tables) if issues is None else issues
    counts = audit_counts(tables) if counts is None else counts
    return AuditReport(
        issues,
        counts,
        integrity.issue_rollup(issues),
        integrity.integrity_score(issues, counts),
        integrity.recommendations(issues),
    )


def integrity_audit(
    warehouse: Warehouse, report_path: str | None = None, as_of: datetime | None = None, keep_parts: bool = True
) -> AuditReport:
    """Audit a warehouse, store the report and log the audit.

    Results per table and snapshot are kept beside the warehouse, and only
    snapshots whose files changed since are read again; ``keep_parts=False``
    reads everything.  Issue and count rows are checkpointed: they are few, and
    all summaries use them.
    """
    as_of = as_timestamp(as_of) if as_of else datetime.now(timezone.utc)
    names = warehouse.tables()
    if keep_parts and names:
        parts = audit_parts(warehouse, names)
        issues = merged_issues(parts, names)
        missing = [t for t in COUNTED_TABLES if t not in names]
        if missing:
            issues = issues.unionByName(integrity.missing_tables(warehouse.spark, missing))
        counts = merged_counts(parts, [t for t in COUNTED_TABLES if t in names])
        report = audit_report({}, cut_lineage(issues), cut_lineage(counts))
    else:
        tables = {t: warehouse.read(t) for t in names}
        issues = cut_lineage(audit_issues(tables, COUNTED_TABLES))
        report = audit_report(tables, issues, cut_lineage(audit_counts(tables)))
    if report_path:
        for part in ("issues", "counts", "rollup", "score", "recommendations"):
            write_report(getattr(report, part), f"{report_path}/{part}")
    score = report.score.first()["integrity_score"]
    found = report.issues.count()
    registry_log.register_event(
        warehouse,
        as_of.replace(microsecond=0),
        log.AUDIT,
        log.COMPLETED,
        f"audited, {found} issues, score {score}",
        as_of,
    )
    return report

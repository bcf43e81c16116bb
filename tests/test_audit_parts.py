"""Audits that read changed snapshots only, against audits of everything."""

import random

import pytest
from pyspark.sql import functions as F

from stagetally.operators import audit_parts
from stagetally.plans import audit, audit_store
from stagetally.schemas import COUNTED_TABLES
from stagetally.sources.warehouse import Warehouse
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, stages, table

S3, S4 = "2025-06-15T06:00:00Z", "2025-06-22T06:00:00Z"


def companies(spark, rng, *snapshots, n=25):
    pick = lambda *v: rng.choice(v)
    rows = [
        company(pick(*map(str, range(20)), None), pick("Lead", "lead", None, ""), s, company_name=pick("A", "", None),
                owner_id=pick("", "o1", "zz", None), company_type=pick("X", "x"), proff_link=pick("HTTP://a", None))
        for s in snapshots for _ in range(n)
    ]
    return table(spark, "companies", rows)


def deals(spark, rng, *snapshots, n=30):
    pick = lambda *v: rng.choice(v)
    rows = [deal(pick("a", "b", "c", None), pick("1", "99", "", None), pick("Won", "won"), s, deal_name=pick("D", ""), owner_id=pick("o1", "o2"))
            for s in snapshots for _ in range(n)]
    return table(spark, "deals", rows)


def owners(spark):
    rows = [("o1", "Bad"), ("o1", "a@b.no"), ("o3", ""), (None, "x@y.no")]
    return table(spark, "owners", [{"owner_id": i, "email": e, "record_timestamp": S1} for i, e in rows])


@pytest.fixture
def full(spark, warehouse):
    rng = random.Random(2)
    warehouse.append_table(companies(spark, rng, S1, S2), "companies")
    warehouse.append_table(deals(spark, rng, S1, S3), "deals")
    warehouse.append_table(owners(spark), "owners")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    warehouse.append_table(table(spark, "snapshot_registry", [logged(S1, "manual", "started", S1), logged(S1, "manual", "started", S1), logged(S4, "x", None, S1)]), "snapshot_registry")
    warehouse.append_table(table(spark, "pipeline_units_snapshot", [
        {"company_id": c, "deal_id": d, "owner_id": "o9", "snapshot_id": S1} for c, d in (("1", "a"), ("77", "q"), (None, ""))]), "pipeline_units_snapshot")
    return warehouse


def plain(warehouse):
    tables = {t: warehouse.read(t) for t in warehouse.tables()}
    return shown(audit.audit_issues(tables, COUNTED_TABLES)), shown(audit.audit_counts(tables))


def shown(df):
    return sorted(map(str, df.collect()))


def check(warehouse):
    want = plain(warehouse)
    report = audit.integrity_audit(warehouse, None, AS_OF)
    assert (shown(report.issues), shown(report.counts)) == want
    assert report.rollup.count() > 1 and report.score.count() == 1 and report.recommendations.count() >= 1


def reads(monkeypatch):
    seen = []
    whole, some = Warehouse.read, Warehouse.read_snapshots
    monkeypatch.setattr(audit_store, "parts_of", lambda t, df: seen.append(t) or audit_parts.parts_of(t, df))
    monkeypatch.setattr(Warehouse, "read_snapshots", lambda self, n, ids: seen.append((n, sorted(i.day for i in ids))) or some(self, n, ids))
    return seen, whole


def test_parts_merge_to_the_full_audit(spark, full, monkeypatch):
    check(full)
    seen, _ = reads(monkeypatch)
    check(full)
    assert [s for s in seen if isinstance(s, tuple)] == [] and set(seen) == {"owners", "deal_stage_reference", "snapshot_registry"}
    rng = random.Random(9)
    full.append_table(companies(spark, rng, S4), "companies")
    full.replace_snapshots(deals(spark, rng, S3, n=200), "deals", [S3])
    seen.clear()
    check(full)
    assert [s for s in seen if isinstance(s, tuple)] == [("companies", [22]), ("deals", [15])]


def test_snapshots_that_are_gone_leave_no_issue(spark, full):
    check(full)
    full._drop_snapshots("companies", [S1])
    check(full)
    fs, folder = full._fs(f"{audit_store._path(full)}/table=companies")
    assert [s.day for s, _ in full._folders(folder.toString())] == [8]


def test_rows_without_a_snapshot_are_always_read(spark, full):
    odd = companies(spark, random.Random(4), S1).withColumn("snapshot_id", F.lit(None).cast("timestamp"))
    full.append_table(odd, "companies")
    check(full)
    full.append_table(odd, "companies")
    check(full)


def test_other_rules_are_other_parts(spark, full, monkeypatch):
    check(full)
    before = audit_parts.rules_version()
    monkeypatch.setattr(audit_parts, "UNIQUE_KEYS", {"deals": ["deal_id", "snapshot_id"]})
    assert audit_parts.rules_version() != before


def test_few_tables_and_none(spark, warehouse):
    warehouse.append_table(owners(spark), "owners")
    check(warehouse)
    empty = Warehouse(spark, warehouse.root + "-none")
    assert audit.integrity_audit(warehouse, None, AS_OF, keep_parts=False).issues.count() > 0
    assert empty.tables() == []


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_keep_few_values_and_meet_once(spark, full):
    """Only references and keys are kept whole, the registry's log is folded once, and references meet keys in one aggregate."""
    rows = [company(f"n{i}", "lead", S4, owner_id=f"z{i:02}", proff_link=f"HTTP://{i:02}") for i in range(40)]
    full.append_table(table(spark, "companies", rows), "companies")
    full.append_table(table(spark, "deals", [deal(f"d{i}", f"gone{i:02}", "won", S4) for i in range(40)]), "deals")
    check(full)
    own = audit_store._stored(full).filter(F.col("snapshot_id") == F.lit(S4).cast("timestamp"))
    links = own.filter("field = 'proff_link'").select("value", "n").collect()
    assert {tuple(r) for r in links} == {(None, 40), *[(f"HTTP://{i:02}", 0) for i in range(5)]} and len(links) == 6
    assert own.filter("field = 'owner_id' AND value LIKE 'z%'").count() == 40
    registry = audit_parts.parts_of("snapshot_registry", full.read("snapshot_registry"))
    assert plan_of(registry).count("Window [") == 1
    merged = plan_of(audit_parts.merged_issues(audit_store._stored(full), full.tables()))
    assert "LeftAnti" not in merged and merged.count("RepartitionByExpression") == 1

from stagetally.operators import integrity
from stagetally.plans import audit
from stagetally.schemas import ISSUES
from stagetally.session import literal_table
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, table


def issues(df):
    return {(r["table"], r["field"], r["issue_type"]): (r["count"], r["sample_values"]) for r in df.collect()}


def bed(spark):
    return {
        "companies": table(spark, "companies", [
            company("1", "Lead", owner_id=""), company("2", "lead", company_name=""), company("2", "lead", owner_id="zz")]),
        "deals": table(spark, "deals", [deal("a", "9", "Won"), deal("b", "8", "Won"), deal("c", "1", "open", deal_type="X")]),
        "owners": table(spark, "owners", [{"owner_id": "o1", "email": "Bad"}, {"owner_id": "o2", "email": "a@b.no"}]),
        "snapshot_registry": table(spark, "snapshot_registry", [logged(S2, "manual", "started", S2)]),
    }


def test_all_checks_together_equal_each_alone(spark):
    tables = bed(spark)
    together = issues(audit.audit_issues(tables))
    alone = {}
    for check in (integrity.blank_reference_count, integrity.orphan_references, integrity.missing_required_count,
                  integrity.invalid_format_count, integrity.case_violation_count, integrity.snapshot_consistency,
                  integrity.duplicate_records):
        alone |= issues(check(tables))
    assert together == alone
    assert together["companies", "owner_id", "blank_reference_field"] == (1, ["''"])
    assert together["companies", "owner_id", "orphaned_reference"] == (1, ["zz"])
    assert together["deals", "associated_company_id", "orphaned_reference"] == (2, ["8", "9"])
    assert together["companies", "company_name", "missing_required_field"] == (1, ["NULL", "''"])
    assert together["owners", "email", "invalid_format"] == (1, ["Bad"])
    assert together["deals", "deal_stage", "case_normalization"] == (2, ["Won"])
    assert together["companies", "(company_id, snapshot_id)", "duplicate_records"] == (1, ["1 duplicate groups"])
    assert together["deals", "snapshot_id", "unregistered_snapshot"][0] == 1
    assert together["deals", "snapshot_id", "missing_snapshot_data"][0] == 1


def test_absent_tables_are_skipped(spark):
    assert issues(audit.audit_issues({"owners": table(spark, "owners", [{"owner_id": "1", "email": "a@b.no"}])})) == {}


def test_empty_registry_is_one_critical_issue(spark):
    tables = bed(spark) | {"snapshot_registry": table(spark, "snapshot_registry", [])}
    assert issues(integrity.snapshot_consistency(tables)) == {("snapshot_registry", "snapshot_id", "missing_snapshots"): (0, [])}


def test_anomalies_need_two_snapshots(spark):
    one = literal_table(spark, [(None, 1, 1)], "snapshot_id timestamp, companies bigint, deals bigint")
    assert integrity.distribution_anomalies(one).count() == 0
    many = table(spark, "companies", [company(str(i), "lead", S1) for i in range(9)] + [company("1", "lead", S2)])
    deals = table(spark, "deals", [deal("a", "1", "x", S1), deal("a", "1", "x", S2)])
    found = integrity.distribution_anomalies(integrity.snapshot_distribution(many, deals)).collect()
    assert [(r["table"], r["count"]) for r in found] == [("companies", 1)]


def some(spark, *rows):
    return literal_table(spark, [("t", "f", kind, n, severity, "", []) for kind, severity, n in rows], ISSUES)


def test_score_and_advice(spark):
    counts = literal_table(spark, [("a", 60), ("b", 40)], "table string, rows bigint")
    found = some(spark, ("duplicate_records", "critical", 2), ("case_normalization", "warning", 3), ("x", "info", 10))
    assert integrity.integrity_score(found, counts).first()["integrity_score"] == 90.0 - 0.0
    bad = some(spark, ("duplicate_records", "critical", 99))
    assert integrity.integrity_score(bad, counts).first()["integrity_score"] == 0.0
    empty = literal_table(spark, [], "table string, rows bigint")
    assert integrity.integrity_score(found, empty).first()["integrity_score"] == 0.0
    assert integrity.recommendations(found).count() == 2
    assert integrity.recommendations(some(spark)).collect()[0]["recommendation"] == integrity.NO_ADVICE


def test_rollup(spark):
    found = some(spark, ("a", "critical", 1), ("b", "critical", 1))
    rows = {(r["dimension"], r["value"]): r["issues"] for r in integrity.issue_rollup(found).collect()}
    assert rows == {("total", "all"): 2, ("severity", "critical"): 2, ("table", "t"): 2,
                    ("issue_type", "a"): 1, ("issue_type", "b"): 1}


def test_audit_is_stored_and_logged(spark, warehouse, tmp_path):
    for name, df in bed(spark).items():
        warehouse.append_table(df, name)
    path = str(tmp_path / "report")
    report = audit.integrity_audit(warehouse, path, AS_OF)
    assert spark.read.json(f"{path}/issues").count() == report.issues.count()
    row = warehouse.read("snapshot_registry").filter("triggered_by = 'integrity_verification_step5'").first()
    assert row["status"] == "completed" and "score" in row["notes"]


def test_an_expected_table_that_is_absent_is_an_issue(spark, warehouse):
    tables = bed(spark)
    deals = tables.pop("deals")
    found = issues(audit.audit_issues(tables, [*tables, "deals"]))
    assert found[("deals", "*", "missing_table")] == (1, ["deals"])
    assert ("deals", "*", "missing_table") not in issues(audit.audit_issues(tables | {"deals": deals}, ["deals"]))
    for name, df in tables.items():
        warehouse.append_table(df, name)
    report = audit.integrity_audit(warehouse, None, AS_OF)
    assert report.issues.filter("issue_type = 'missing_table' AND table = 'deals'").count() == 1


def test_key_counts_keep_the_number_of_partitions(spark):
    """No partial count fills memory before the shuffle, and its partitions are not merged by their compressed size."""
    df = spark.range(30).selectExpr("CAST(id % 7 AS STRING) AS company_id", "timestamp_seconds(id % 1) AS snapshot_id")
    found = integrity.key_counts(df, ["company_id", "snapshot_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert sorted((r["company_id"], r["n"]) for r in found.collect()) == [(str(i), 5 if i < 2 else 4) for i in range(7)]

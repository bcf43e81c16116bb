import pytest
from pyspark.sql import functions as F

from stagetally.operators import history, registry
from stagetally.operators.scoring import score_history, score_units, stage_mapping
from stagetally.plans import score
from stagetally.plans.report import owner_history
from stagetally.schemas import STAGE_MAPPING_ROWS
from stagetally.sources.warehouse import as_timestamp
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, stages, table


def units(spark, companies, deals=(), dedupe=False):
    return score_units(
        table(spark, "companies", companies),
        table(spark, "deals", list(deals)),
        stages(spark),
        stage_mapping(spark, AS_OF),
        F.lit(AS_OF),
        dedupe,
    )


def rows(df):
    keys = ["company_id", "deal_id", "combined_stage", "stage_level", "adjusted_score", "stage_source"]
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=str)


def test_mapping_lists_one_stage_twice():
    names = [r[3] for r in STAGE_MAPPING_ROWS]
    assert len(names) == 16 and names.count("salesqualifiedlead") == 2


def test_doubled_stage_doubles_units(spark):
    found = units(spark, [company("1", "SalesQualifiedLead")])
    assert rows(found) == [("1", None, "salesqualifiedlead", 4, 6.0, "company")] * 2
    total = score_history(found, F.lit(AS_OF)).collect()[0]
    assert (total["num_companies"], total["total_score"]) == (1, 12.0)


def test_dedupe_mapping_keeps_one(spark):
    assert len(rows(units(spark, [company("1", "SalesQualifiedLead")], dedupe=True))) == 1


def test_only_open_deals_count(spark):
    found = units(spark, [company("1", "opportunity")], [deal("a", "1", "QualifiedToBuy"), deal("b", "1", "ClosedLost")])
    assert rows(found) == [("1", "a", "opportunity/qualifiedtobuy", 6, 10.0, "deal")]


def test_only_closed_deals_is_missing(spark):
    found = units(spark, [company("1", "opportunity")], [deal("b", "1", "closedlost")])
    assert rows(found) == [("1", None, "opportunity/missing", 5, 7.0, "company")]


def test_lead_with_three_deals_gives_three_units(spark):
    deals = [deal(d, "1", "qualifiedtobuy") for d in "abc"]
    found = rows(units(spark, [company("1", "lead", lead_status="Attempted to contact")], deals))
    assert found == [("1", d, "lead/attempted_to_contact", 2, 1.5, "deal") for d in "abc"]


def test_unmatched_stages_score_zero(spark):
    companies = [
        company("1", "lead"), company("2", "Lead", lead_status=""), company("3", "closed-won"),
        company("4", "customer"), company("5", None),
    ]
    assert [(r[0], r[2], r[3], r[4]) for r in rows(units(spark, companies))] == [
        ("1", "lead/unknown", 0, 0.0), ("2", "lead/unknown", 0, 0.0), ("3", "closed-won", 0, 0.0),
        ("4", "unmapped", 0, 0.0), ("5", "unmapped", 0, 0.0),
    ]


def test_unknown_deal_stage_is_open_and_lost_companies_drop(spark):
    deals = [deal("a", "1", "brandnew"), deal("b", "nobody", "qualifiedtobuy"), deal("c", None, "qualifiedtobuy")]
    assert rows(units(spark, [company("1", "opportunity")], deals)) == [
        ("1", "a", "opportunity/brandnew", 0, 0.0, "deal")
    ]


def test_snapshots_do_not_mix(spark):
    companies = [company("1", "opportunity", S1), company("1", "opportunity", S2)]
    found = units(spark, companies, [deal("a", "1", "qualifiedtobuy", S2)])
    assert [r[1] for r in rows(found)] == [None, "a"] or [r[1] for r in rows(found)] == ["a", None]


def test_hot_company_keeps_every_deal(spark):
    """A third of all deals on one company, against a brute-force count."""
    companies = [company(str(i), "opportunity") for i in range(20)]
    deals = [deal(f"h{i}", "0", "qualifiedtobuy") for i in range(150)]
    deals += [deal(f"d{i}", str(1 + i % 15), "presentationscheduled") for i in range(300)]
    found = units(spark, companies, deals)
    by_company = {r[0]: r[1] for r in found.groupBy("company_id").count().collect()}
    assert by_company["0"] == 150 and sum(by_company.values()) == 150 + 300 + 4


def report(spark, unit_rows, companies=(), deals=(), owners=()):
    return owner_history(
        table(spark, "pipeline_units_snapshot", unit_rows), table(spark, "companies", list(companies)),
        table(spark, "deals", list(deals)), table(spark, "owners", list(owners)),
    )


def unit(company_id, owner, score, snapshot, loaded=None, level=4, deal_id=None):
    return {"company_id": company_id, "deal_id": deal_id, "owner_id": owner, "stage_level": level,
            "adjusted_score": score, "snapshot_id": snapshot, "record_timestamp": loaded or snapshot}


def test_change_over_time(spark):
    found = report(spark, [unit("1", "o", 0.0, S1), unit("1", "o", 4.0, S2), unit("2", "p", 1.0, S2)])
    by_key = {(r["owner_id"], r["snapshot_id"].day): r for r in found.collect()}
    first, second, once = by_key["o", 1], by_key["o", 8], by_key["p", 8]
    assert first["previous_total_score"] is None and first["score_change_percent"] is None
    assert second["score_change_from_previous"] == 4.0 and second["score_change_percent"] is None
    assert once["previous_record_timestamp"] is None and once["company_change_from_previous"] is None
    assert (second["owner_rank_in_snapshot"], once["owner_rank_in_snapshot"]) == (1, 2)


def test_inactive_levels_leave_and_lists_stay_null(spark):
    rows_ = [unit("1", "o", 1.0, S1), unit("2", "o", 1.0, S1, level=-1), unit("3", "o", 1.0, S1, level=9),
             unit("4", "o", 1.0, S1, level=None)]
    found = report(spark, rows_, [company("1", "lead", company_type=None)]).collect()
    assert len(found) == 1
    assert found[0]["total_companies"] == 1 and found[0]["company_types"] is None and found[0]["sql_count"] == 1


def test_several_load_times_multiply_rows(spark):
    rows_ = [unit("1", "o", 1.0, S1), unit("1", "p", 2.0, S1), unit("1", "o", 1.0, S1, loaded=S2), unit("9", None, 3.0, S1)]
    found = report(spark, rows_)
    owners = history.owner_aggregates(
        table(spark, "pipeline_units_snapshot", rows_)
        .withColumns({c: F.lit(None).cast("string") for c in (
            "owner_email", "owner_name", "company_type", "deal_type", "development_category", "hiring_developers")})
        .withColumn("deal_amount", F.lit(None).cast("double"))
    )
    joined = history.with_snapshot_totals(owners, history.snapshot_totals(owners))
    keys = ["owner_id", "record_timestamp", "active_owners", "total_companies_all_owners", "total_score_all_owners"]
    left = sorted(map(str, found.select(*keys).collect()))
    assert len(left) == 8 and left == sorted(map(str, joined.select(*keys).collect()))


def test_report_is_sorted(spark):
    found = history.report_order(report(spark, [unit("1", "o", 1.0, S1), unit("2", "p", 5.0, S1), unit("1", "o", 1.0, S2)]))
    assert [(r["owner_id"], r["snapshot_id"].day) for r in found.collect()] == [("o", 8), ("p", 1), ("o", 1)]


def filled(warehouse):
    spark = warehouse.spark
    companies = [company("1", "opportunity", s) for s in (S1, S2)] + [company("2", "SalesQualifiedLead", S2)]
    warehouse.append_table(table(spark, "companies", companies), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "qualifiedtobuy", S2)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    log = [logged(S2, "ingest_completion", "completed", "2025-06-09T00:00:00Z"),
           logged(S1, "ingest_completion", "completed", "2025-06-10T00:00:00Z"),
           logged("2025-05-01T00:00:00Z", "manual", "started", "2025-05-01T00:00:00Z")]
    warehouse.append_table(table(spark, "snapshot_registry", log), "snapshot_registry")


def test_rescoring_changes_nothing_and_sums_agree(warehouse):
    filled(warehouse)
    first = {str(r) for r in score.score_snapshots(warehouse, [S1, S2], AS_OF).collect()}
    before = sorted(map(str, warehouse.read("pipeline_units_snapshot").collect()))
    assert {str(r) for r in score.score_snapshots(warehouse, [S1, S2], AS_OF).collect()} == first
    assert sorted(map(str, warehouse.read("pipeline_units_snapshot").collect())) == before
    unit_sum = warehouse.read("pipeline_units_snapshot").agg(F.sum("adjusted_score")).first()[0]
    history_sum = warehouse.read("pipeline_score_history").agg(F.sum("total_score")).first()[0]
    assert unit_sum == history_sum == 7.0 + 10.0 + 12.0


def test_rescore_all_follows_completion_order(warehouse):
    filled(warehouse)
    result = score.rescore_all(warehouse, AS_OF)
    assert registry.rescore_summary(result).collect()[0].asDict() == {
        "status": "success", "discovered": 2, "succeeded": 2, "failed": 0}
    loaded = warehouse.read("pipeline_units_snapshot").groupBy("snapshot_id").agg(F.max("record_timestamp").alias("at"))
    order = [r["snapshot_id"].day for r in loaded.orderBy("at").collect()]
    assert order == [8, 1]
    states = {r["snapshot_id"].month: r["state"] for r in registry.scoring_state(warehouse.read("snapshot_registry")).collect()}
    assert states[6] == "done" and states[5] == "pending"
    asked = warehouse.read("snapshot_registry").filter("triggered_by = 'rescore_step4'")
    assert asked.count() == 1


def test_empty_result_clears_a_scored_snapshot(warehouse):
    filled(warehouse)
    score.score_snapshots(warehouse, [S1, S2], AS_OF)
    warehouse.replace_snapshot(warehouse.read("companies").filter("false"), "companies", S2)
    counts = {r["snapshot_id"].day: r["unit_records"] for r in score.score_snapshots(warehouse, [S1, S2], AS_OF).collect()}
    assert counts == {1: 1, 8: 0}
    assert warehouse.read_table_for_snapshot("pipeline_units_snapshot", S2).count() == 0


def test_failure_is_logged(warehouse):
    filled(warehouse)
    warehouse.read = lambda name, read=warehouse.read: (_ for _ in ()).throw(RuntimeError("boom")) if name == "deal_stage_reference" else read(name)
    try:
        score.score_snapshots(warehouse, [S1], AS_OF)
        raise AssertionError("should have failed")
    except RuntimeError:
        pass
    log = warehouse.read("snapshot_registry").filter(F.col("snapshot_id") == as_timestamp(S1))
    found = {(r["triggered_by"], r["status"], r["notes"]) for r in log.collect()}
    assert found == {("ingest_completion", "completed", None), ("scoring_failure", "failed", "scoring stopped: boom")}


def test_one_broken_snapshot_leaves_the_others_scored(warehouse, monkeypatch):
    filled(warehouse)
    broken, stamped = as_timestamp(S1), score._stamped

    def failing(df, stamps):
        if any(as_timestamp(r["id"]) == broken for r in stamps.select(F.col("snapshot_id").cast("string").alias("id")).collect()):
            raise RuntimeError("broken snapshot")
        return stamped(df, stamps)

    monkeypatch.setattr(score, "_stamped", failing)
    result = score.rescore_all(warehouse, AS_OF)
    assert registry.rescore_summary(result).collect()[0].asDict() == {
        "status": "partial_success", "discovered": 2, "succeeded": 1, "failed": 1}
    stored = {r["snapshot_id"].day for r in warehouse.read("pipeline_score_history").collect()}
    assert stored == {8}


def test_absent_inputs_are_an_error(warehouse):
    filled(warehouse)
    fs, path = warehouse._fs(warehouse.path("deals"))
    fs.delete(path, True)
    with pytest.raises(FileNotFoundError):
        score.score_snapshots(warehouse, [S1], AS_OF)

import json

import pytest
from pyspark.sql import functions as F

from stagetally.operators.exports import drop_empty_rows
from stagetally.plans import imports, ingest, migrate
from stagetally.session import literal_table
from stagetally.sources import exports
from stagetally.streaming import scoring as streams
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, stages, table


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def landed(tmp_path):
    companies = {"results": [
        {"id": str(i), "properties": {"name": f"C{i}", "lifecyclestage": " Lead ", "proff_link": "HTTP://A.B/C"}} for i in (1, 2, 3)]}
    deals = {"results": [
        {"id": "a", "properties": {"dealname": "A", "amount": "12.5"}, "associations": {"companies": {"results": [{"id": "1"}, {"id": "2"}]}}},
        {"id": "b", "properties": {"dealname": "B", "amount": "n/a"}, "associations": {"companies": {"results": []}}},
        {"id": "c", "properties": {"dealname": "C"}}]}
    owners = {"results": [{"id": 7, "email": " A@B.no ", "userId": 9, "createdAt": S1}]}
    groups = {"results": [{"id": "p", "label": "P", "stages": [
        {"id": "won", "label": "Won", "displayOrder": 2, "metadata": {"isClosed": "TRUE", "probability": "1.0"}},
        {"id": "new", "label": "New"}]}]}
    paths = {}
    for name, page in (("companies", companies), ("deals", deals), ("owners", owners), ("deal_stage_reference", groups)):
        write(tmp_path / name / "page.json", json.dumps(page))
        paths[name] = str(tmp_path / name)
    return paths


def test_ingest(warehouse, tmp_path):
    paths = landed(tmp_path)
    dry = {r["table"]: r["rows"] for r in ingest.ingest_snapshot(warehouse, paths, ingest.object_configs("owner_id"), S1, limit=2).collect()}
    assert dry == {"companies": 2, "deals": 2} and warehouse.tables() == []
    events = str(tmp_path / "events")
    ingest.ingest_snapshot(warehouse, paths, ingest.object_configs("owner_id"), S1, limit=None, dry_run=False, as_of=AS_OF, event_path=events)
    found = warehouse.read("companies").select("company_id", "lifecycle_stage", "proff_link").orderBy("company_id").first()
    assert tuple(found) == ("1", "lead", "http://a.b/C")
    rows = [tuple(r) for r in warehouse.read("deals").select("deal_id", "amount", "associated_company_id").orderBy("deal_id").collect()]
    assert rows == [("a", 12.5, "1"), ("b", None, None), ("c", None, None)]
    owner = warehouse.read("owners").first()
    assert (owner["owner_id"], owner["email"], owner["user_id"], owner["active"]) == ("7", "a@b.no", "9", False)
    closed = [tuple(r) for r in warehouse.read("deal_stage_reference").select("stage_id", "is_closed", "display_order").orderBy("stage_id").collect()]
    assert closed == [("new", False, 0), ("won", True, 2)]
    log = sorted((r["triggered_by"], r["status"]) for r in warehouse.read("snapshot_registry").collect())
    assert log == [("ingest_completion", "completed"), ("manual", "started")]
    routed = streams.route_events(warehouse.spark.read.text(events)).collect()
    assert [(r["route"], r["snapshot_id"]) for r in routed] == [("score", S1)]


def test_ingest_failure_is_logged(warehouse, tmp_path):
    paths = landed(tmp_path) | {"owners": str(tmp_path / "absent")}
    with pytest.raises(Exception):
        ingest.ingest_snapshot(warehouse, paths, ingest.object_configs("owner_id"), S1, limit=None, dry_run=False, as_of=AS_OF, event_path=str(tmp_path / "e"))
    assert "ingest_failure" in [r["triggered_by"] for r in warehouse.read("snapshot_registry").collect()]
    assert streams.route_events(warehouse.spark.read.text(str(tmp_path / "e"))).first()["event_type"] == "crm.snapshot.failed"


def export_folder(tmp_path):
    root = tmp_path / "exports"
    write(root / "x-company-2025-06-01.csv", '"Record ID","Company name","Company owner","Lifecycle Stage"',
          '1,"A, Ltd",anna berg,Lead', ",lost,,")
    write(root / "x-deals-2025-06-01.csv", '"Record ID","Deal Name","Deal Stage","Close Date","Deal owner","Amount","Deal Type"',
          '10,D,Won,2025-01-01,bo,"kr 1,5",New')
    write(root / "x-deals-2025-06-08.csv",
          '"Record ID","Deal Name","Deal Stage","Close Date","Deal owner","Amount","Deal Type","Associated Company IDs (Primary)"',
          "11,E,Won,2025-01-01,bo,7,New,1")
    write(root / "other" / "part-0.csv", "Deal Name,Amount", "x,1")
    return str(root)


def test_export_reading_keeps_columns_apart(spark, tmp_path):
    root = export_folder(tmp_path)
    rows = {r["Record ID"]: r for r in exports.read_exports(spark, root, "deal").collect()}
    assert rows["10"]["Amount"] == "kr 1,5" and rows["10"]["Associated Company IDs (Primary)"] is None
    assert rows["11"]["Associated Company IDs (Primary)"] == "1" and rows["11"]["export_date"] == "2025-06-08"
    assert len([g for g in exports.read_export_groups(spark, root) if g.kind == "deal"]) == 3
    companies = exports.read_exports(spark, root, "company")
    assert drop_empty_rows(companies, ["Record ID"]).count() == 1
    assert sorted(r["file_name"] for r in exports.list_exports(spark, root).collect())[0] == "other"


def test_import_exports(warehouse, tmp_path):
    spark = warehouse.spark
    names = literal_table(spark, [("anna", "7", 0), ("bo", "8", 1)], "name string, owner_id string, rank bigint")
    root = export_folder(tmp_path)
    summary = imports.import_exports(warehouse, root, names, as_of=AS_OF)
    assert {(r["snapshot_id"] is None, r["companies"], r["deals"]) for r in summary.collect()} == {(True, 1, 1), (False, 1, 1)}
    assert warehouse.read("companies").first()["owner_id"] == "7"
    row = warehouse.read("deals").first()
    assert (row["deal_id"], row["deal_stage"], row["amount"], row["owner_id"]) == ("10", "won", 15.0, "8")
    assert warehouse.read("snapshot_registry").first()["notes"].endswith("1 companies and 1 deals")


def test_pairs_need_both_files(spark):
    files = literal_table(spark, [
        ("a-company-2025-06-01.csv", AS_OF), ("a-deal-2025-06-01.csv", AS_OF.replace(year=2024)),
        ("a-deal-2025-06-08.csv", AS_OF), ("company.csv", AS_OF)], "file_name string, modified_at timestamp")
    found = exports.pair_export_files(files).collect()
    assert [(r["export_date"], r["snapshot_id"]) for r in found] == [("2025-06-01", "2024-07-01T00:00:00Z")]


def test_stream_scores_once_per_snapshot(warehouse, tmp_path):
    spark = warehouse.spark
    warehouse.append_table(table(spark, "companies", [company("1", "lead", S1), company("1", "lead", S2)]), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "x", S1)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    warehouse.append_table(table(spark, "snapshot_registry", [logged(S2, "ingest_completion", "completed", S2)]), "snapshot_registry")
    message = json.dumps({"type": "crm.snapshot.completed", "data": {"snapshot_id": S1, "data_tables": {"companies": 2, "deals": 1}}})
    other = json.dumps({"type": "crm.test.request", "data": {"snapshot_id": S2}})
    write(tmp_path / "in" / "1.txt", message, message, other, "noise")

    def run():
        source = streams.read_messages(spark, str(tmp_path / "in"))
        streams.score_on_event(source, warehouse, str(tmp_path / "ck"), available_now=True).awaitTermination()
        return sorted(r["snapshot_id"].day for r in warehouse.read("pipeline_score_history").collect())

    assert run() == [1]
    done = warehouse.read("snapshot_registry").filter(F.col("triggered_by") == "scoring_completion").first()
    assert done["notes"] == "scored, 3 records announced; 1 units, 1 history rows, 16 scoring rows"
    write(tmp_path / "in" / "2.txt", json.dumps({"type": "crm.rescore.all"}), message)
    assert run() == [1, 8]
    log = warehouse.read("snapshot_registry").filter(F.col("triggered_by") == "scoring_completion")
    assert log.count() == 2


def test_exports_of_one_kind_alone_import_nothing(warehouse, tmp_path):
    folder = tmp_path / "alone"
    folder.mkdir()
    write(folder / "deals 2025-01-01.csv", "Record ID,Deal Name", "1,x")
    summary = imports.import_exports(warehouse, str(folder), as_of=AS_OF)
    assert summary.filter("snapshot_id IS NOT NULL").count() == 0 and not warehouse.exists("deals")


def test_a_completed_message_with_an_unreadable_id_is_invalid(spark):
    good, bad = "2025-06-08T06:00:00Z", "garbage"
    rows = [json.dumps({"type": "crm.snapshot.completed", "data": {"snapshot_id": i}}) for i in (good, bad, "", "2025-06-08")]
    routed = streams.route_events(spark.createDataFrame([(r,) for r in rows], "value string")).collect()
    assert [r["route"] for r in routed] == ["score", "invalid", "invalid", "score"]


def test_streams_need_a_checkpoint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError):
        streams.publish_events(streams.read_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"))


def test_unreadable_ids_are_rejected_before_a_migration_writes(warehouse, tmp_path):
    spark = warehouse.spark
    rows = [company("1", "lead", S1), company("2", "lead", S1), company("3", "lead", S2)]
    old = table(spark, "companies", rows).withColumn(
        "snapshot_id", F.when(F.col("company_id") == "3", "no date").otherwise("2025-06-01")
    )
    deals = table(spark, "deals", [deal("a", "1", "x", S1)]).withColumn("snapshot_id", F.lit("2025-06-01"))
    path = str(tmp_path / "rejected")
    checked = migrate.migrate_snapshots({"companies": old, "deals": deals}, warehouse, as_of=AS_OF, rejected_path=path)
    found = {(r["table"], r["snapshot_id"] is None): (r["source_rows"], r["target_rows"], r["verified"]) for r in checked.collect()}
    assert found == {("companies", False): (2, 2, True), ("companies", True): (1, 0, False), ("deals", False): (1, 1, True)}
    assert [r["company_id"] for r in spark.read.json(f"{path}/companies").collect()] == ["3"]
    assert warehouse.read("snapshot_registry").count() == 1
    migrate.migrate_snapshots({"companies": old, "deals": deals}, warehouse, as_of=AS_OF)
    assert warehouse.read("companies").count() == 2


def test_quoted_line_breaks_and_wrong_field_counts(spark, tmp_path):
    folder = tmp_path / "quoted"
    folder.mkdir()
    write(folder / "deals 2025-01-01.csv", 'Record ID,"Deal', 'Name",Amount', '1,"line one', 'line two",5', "2,short", "3,x,7,8,9", "4,y,6")
    groups = exports.read_export_groups(spark, str(folder))
    assert [(g.kind, g.columns) for g in groups] == [("deal", ["Record ID", "Deal\nName", "Amount"])]
    rows = {r["Record ID"]: r for r in groups[0].frame.collect()}
    assert rows["1"]["Deal\nName"] == "line one\nline two" and rows["1"]["malformed"] is None
    bad = imports.malformed_records(groups).collect()
    assert sorted(r["malformed"].strip() for r in bad) == ["2,short", "3,x,7,8,9"] and {r["kind"] for r in bad} == {"deal"}

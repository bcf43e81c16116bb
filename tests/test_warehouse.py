import pytest
from pyspark.sql import functions as F

from stagetally.operators import alignment, registry
from stagetally.plans import migrate, registry_log
from stagetally.schemas import DEALS, TABLES
from stagetally.session import literal_table
from stagetally.sources.warehouse import Warehouse, as_timestamp, table_counts
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, table


def owners(spark, *ids, email="e"):
    return table(spark, "owners", [{"owner_id": i, "email": email, "first_name": "F", "record_timestamp": S1} for i in ids])


def test_replace_with_nothing_keeps_the_table(warehouse):
    warehouse.append_table(owners(warehouse.spark, "1", "2"), "owners")
    assert warehouse.replace_table(owners(warehouse.spark), "owners") is False
    assert warehouse.read("owners").count() == 2
    assert warehouse.replace_table(owners(warehouse.spark, "3"), "owners") is True
    assert [r["owner_id"] for r in warehouse.read("owners").collect()] == ["3"]


def test_table_can_be_replaced_by_its_own_rows(warehouse):
    warehouse.append_table(owners(warehouse.spark, "1", "2"), "owners")
    warehouse.replace_table(warehouse.read("owners").filter("owner_id = '2'"), "owners")
    assert warehouse.read("owners").count() == 1


def test_upsert(warehouse):
    spark = warehouse.spark
    warehouse.append_table(owners(spark, "1", "2", None), "owners")
    source = literal_table(spark, [(2, "new"), (3, "new")], "owner_id bigint, email string")
    warehouse.upsert_table(source, "owners", "owner_id")
    once = sorted((str(r["owner_id"]), r["email"], r["first_name"]) for r in warehouse.read("owners").collect())
    assert once == [("1", "e", "F"), ("2", "new", "F"), ("3", "new", None), ("None", "e", "F")]
    warehouse.upsert_table(source, "owners", "owner_id")
    again = sorted((str(r["owner_id"]), r["email"], r["first_name"]) for r in warehouse.read("owners").collect())
    assert again == once
    with pytest.raises(ValueError):
        warehouse.upsert_table(source.unionByName(source), "owners", "owner_id")


def test_snapshot_replacement_touches_only_its_snapshot(warehouse):
    spark = warehouse.spark
    warehouse.append_table(table(spark, "companies", [company("1", "lead", S1), company("2", "lead", S2)]), "companies")
    assert warehouse.replace_snapshot(table(spark, "companies", [company("9", "lead", S2)] * 2), "companies", S2) == 2
    assert sorted(r["company_id"] for r in warehouse.read("companies").collect()) == ["1", "9", "9"]
    assert warehouse.replace_snapshot(table(spark, "companies", []), "companies", S2) == 0
    assert [r["company_id"] for r in warehouse.read("companies").collect()] == ["1"]


def test_snapshot_scan_prunes_partitions(warehouse):
    spark = warehouse.spark
    warehouse.append_table(table(spark, "companies", [company("1", "lead", S1), company("2", "lead", S2)]), "companies")
    plan = warehouse.read_table_for_snapshot("companies", S2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_id" in plan


def test_delete_by_source(warehouse):
    spark = warehouse.spark
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "x", S1), deal("b", "1", "x", S2)]), "deals")
    log = [logged(S1, "excel_import", "completed", S1), logged(S2, registry.MIGRATION, "completed", S2),
           logged(S2, "manual", "started", S2)]
    warehouse.append_table(table(spark, "snapshot_registry", log), "snapshot_registry")
    warehouse.delete_snapshots_by_source("deals", registry.MIGRATION)
    assert [r["deal_id"] for r in warehouse.read("deals").collect()] == ["a"]
    assert sorted(r["triggered_by"] for r in warehouse.read("snapshot_registry").collect()) == ["excel_import", "manual"]


def test_mirror_and_names(spark, tmp_path):
    source = Warehouse(spark, str(tmp_path / "a"))
    source.append_table(owners(spark, "1"), "owners")
    source.append_table(table(spark, "companies", [company("1", "lead")]), "companies")
    target = Warehouse(spark, str(tmp_path / "b"), prefix="x_", column_names={"companies": {"owner_id": "their_owner"}})
    source.mirror_dataset(target)
    assert "their_owner" in spark.read.parquet(target.path("companies")).columns
    assert target.read("companies").select("owner_id").first()[0] == "o1"
    verdicts = {r["table"]: r["verdict"] for r in source.verify_mirror(target).collect()}
    assert verdicts == {"owners": "valid", "companies": "schema mismatch"}
    target.append_table(owners(spark, "2"), "owners")
    assert {r["table"]: r["verdict"] for r in source.verify_mirror(target).collect()}["owners"] == "row count mismatch"


def test_registry_writes(warehouse):
    spark = warehouse.spark
    registry_log.register_scoring_start(warehouse, [S1, S2], AS_OF)
    registry_log.register_scoring_completion(warehouse, S1, 7, AS_OF, "ok")
    registry_log.register_scoring_start(warehouse, [S1], AS_OF)
    found = sorted((r["snapshot_id"].day, r["triggered_by"]) for r in warehouse.read("snapshot_registry").collect())
    assert found == [(1, "scoring_start"), (8, "scoring_start")]
    registry_log.update_status(warehouse, S2, "failed", "why")
    row = warehouse.read_table_for_snapshot("snapshot_registry", S2).collect()[0]
    assert (row["status"], row["notes"]) == ("failed", "scoring began | why")
    registry_log.register_rescore_request(warehouse, 2, AS_OF, "m1")
    asked = warehouse.read("snapshot_registry").filter("triggered_by = 'rescore_step4'").first()
    assert (asked["status"], asked["notes"]) == ("started", "all 2 completed snapshots are to be scored anew (message m1)")
    empty = registry_log.with_status(table(spark, "snapshot_registry", [logged(S1, "t", "s", S1)]), "x", "n")
    assert empty.first()["notes"] == " | n"


def test_details_match_the_plain_join(warehouse):
    spark = warehouse.spark
    log = table(spark, "snapshot_registry", [
        logged(S1, "a", "completed", S1), logged(S1, "a", "completed", S1), logged(S2, "b", "started", S2),
        logged("2025-07-01T00:00:00Z", "c", "failed", S2)])
    companies = table(spark, "companies", [company("1", "lead"), company(None, "lead"), company("2", "lead"), company("3", "x", S2)])
    deals = table(spark, "deals", [deal("a", "1", "x"), deal("b", "1", "x")])
    for name, df in (("r", log), ("c", companies), ("d", deals)):
        df.createOrReplaceTempView(name)
    plain = spark.sql("""SELECT r.triggered_by, count(c.company_id), count(d.deal_id) FROM r
        LEFT JOIN c ON r.snapshot_id = c.snapshot_id LEFT JOIN d ON r.snapshot_id = d.snapshot_id
        GROUP BY r.snapshot_id, r.triggered_by, r.status, r.record_timestamp""")
    found = registry.snapshot_details(log, companies, deals).select("triggered_by", "company_count", "deal_count")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_migration(spark, warehouse):
    old = literal_table(
        spark,
        [(1, " Lead ", "", "2025-06-08"), (2, None, "7", "2025-06-08T09:00:00")],
        "company_id bigint, lifecycle_stage string, owner_id string, snapshot_id string",
    )
    deals = literal_table(spark, [(5, "n/a", "2025-06-08")], "deal_id bigint, amount string, snapshot_id string")
    for _ in range(2):
        checked = migrate.migrate_snapshots({"companies": old, "deals": deals}, warehouse, as_of=AS_OF)
    assert sorted((r["table"], r["source_rows"], r["verified"]) for r in checked.collect()) == [
        ("companies", 2, True), ("deals", 1, True)]
    rows = sorted(tuple(r) for r in warehouse.read("companies").select("company_id", "lifecycle_stage", "owner_id").collect())
    assert rows == [("1", "lead", None), ("2", None, "7")]
    assert warehouse.read("deals").first()["amount"] is None
    assert warehouse.read("snapshot_registry").filter(F.col("snapshot_id") == as_timestamp("2025-06-08T06:00:00Z")).count() == 1


def test_schema_diff(spark):
    source = literal_table(spark, [], "deal_id bigint, gone string").schema
    found = {r["field"]: (r["difference"], r["compatible"]) for r in alignment.schema_diff(spark, source, DEALS).collect()}
    assert found["deal_id"] == ("type mismatch", False) and found["gone"] == ("missing", False)
    assert found["amount"] == ("extra", True)


def test_required_tables(spark, warehouse):
    warehouse.append_table(owners(spark, "1"), "owners")
    found = alignment.required_tables_present(spark, warehouse.tables(), ["owners", "deals"])
    assert sorted(map(tuple, found.collect())) == [("deals", False), ("owners", True)]


def test_counts_and_schemas_agree(spark, warehouse):
    warehouse.append_table(table(spark, "companies", [company("1", "lead", S1), company("1", "lead", S2)]), "companies")
    counts = table_counts({"companies": warehouse.read("companies")}, S1).collect()
    assert [tuple(r) for r in counts] == [("companies", 1)]
    for name in TABLES:
        assert warehouse.read_or_empty(name).schema.names == TABLES[name].names
    with pytest.raises(FileNotFoundError):
        warehouse.read("deals")


def test_a_failed_replacement_keeps_the_old_table(warehouse):
    from pyspark.sql import functions as F

    spark = warehouse.spark
    warehouse.append_table(owners(spark, "1", "2"), "owners")
    broken = warehouse.read("owners").withColumn(
        "email", F.when(F.col("owner_id") == "2", F.raise_error(F.lit("midway"))).otherwise(F.col("email"))
    )
    with pytest.raises(Exception, match="midway"):
        warehouse.replace_table(broken, "owners")
    assert sorted(r["owner_id"] for r in warehouse.read("owners").collect()) == ["1", "2"]
    assert warehouse.replace_table(warehouse.read("owners").filter("false"), "owners") is False
    assert warehouse.replace_table(warehouse.read("owners").filter("owner_id = '2'"), "owners") is True
    assert [r["owner_id"] for r in warehouse.read("owners").collect()] == ["2"]
    fs, root = warehouse._fs(warehouse.root)
    assert [s.getPath().getName() for s in fs.listStatus(root)] == ["owners"]

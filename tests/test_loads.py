"""Loads that fail halfway and are repeated, and what verification sees."""

import pytest
from pyspark.sql import functions as F

from stagetally.operators import registry
from stagetally.operators.digest import digests, row_hash
from stagetally.plans import ingest, migrate, registry_log, score
from stagetally.session import literal_table
from stagetally.sources.staging import Load
from stagetally.sources.warehouse import Warehouse, as_timestamp
from tests.fixtures import AS_OF, S1, S2, company, deal, stages, table


def sources(spark, broken=False):
    old = literal_table(
        spark,
        [(1, "lead", "2025-06-08"), (2, None, "2025-06-08T09:00:00"), (3, "x", "2025-06-01"), (4, "y", "never")],
        "company_id bigint, lifecycle_stage string, snapshot_id string",
    )
    deals = literal_table(spark, [(5, "1", "2025-06-08"), (6, "2", "2025-06-01")], "deal_id bigint, amount string, snapshot_id string")
    if broken:
        deals = deals.withColumn("amount", F.when(F.col("deal_id") == 6, F.raise_error(F.lit("midway"))).otherwise(F.col("amount")))
    return {"companies": old, "deals": deals}


def stored(warehouse, name, key):
    return sorted(r[0] for r in warehouse.read_or_empty(name).select(key).collect())


def dying_publish(monkeypatch, times=1):
    """The load's files of the first table are moved in, then the process dies; later loads work."""
    whole, left = Load.publish, [times]

    def publish(self, replaced=()):
        if not left[0]:
            return whole(self, replaced)
        left[0] -= 1
        names, self.observed = self.observed, dict(list(self.observed.items())[:1])
        whole(self, replaced)
        self.observed = names
        raise OSError("lost")

    monkeypatch.setattr(Load, "publish", publish)


def folders(warehouse):
    fs, root = warehouse._fs(warehouse.root)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def test_a_source_that_raises_changes_nothing(spark, warehouse):
    warehouse.append_table(table(spark, "companies", [company("9", "lead", S1)]), "companies")
    with pytest.raises(Exception, match="midway"):
        migrate.migrate_snapshots(sources(spark, broken=True), warehouse, as_of=AS_OF)
    assert stored(warehouse, "companies", "company_id") == ["9"] and folders(warehouse) == ["companies"]
    assert not warehouse.exists("snapshot_registry")


@pytest.mark.parametrize("clear", [True, False])
def test_a_migration_that_died_between_tables_can_be_repeated(spark, warehouse, monkeypatch, clear):
    dying_publish(monkeypatch, times=2)
    for _ in range(2):
        with pytest.raises(OSError, match="lost"):
            migrate.migrate_snapshots(sources(spark), warehouse, as_of=AS_OF, clear_previous=clear)
    assert stored(warehouse, "companies", "company_id") == ["1", "2", "3"] and not warehouse.exists("deals")
    checked = migrate.migrate_snapshots(sources(spark), warehouse, as_of=AS_OF, clear_previous=clear).collect()
    assert stored(warehouse, "companies", "company_id") == ["1", "2", "3"] and stored(warehouse, "deals", "deal_id") == ["5", "6"]
    assert sorted((r["table"], r["source_rows"], r["target_rows"], r["verified"]) for r in checked if r["snapshot_id"]) == [
        ("companies", 1, 1, True), ("companies", 2, 2, True), ("deals", 1, 1, True), ("deals", 1, 1, True)]
    assert [(r["source_rows"], r["verified"]) for r in checked if not r["snapshot_id"]] == [(1, False)]
    assert folders(warehouse) == ["companies", "deals", "snapshot_registry"]
    assert registry.unfinished_loads(warehouse.read("snapshot_registry")).count() == (0 if clear else 4)


def test_a_withdrawn_load_leaves_rows_of_others(spark, warehouse, monkeypatch):
    at = "2025-06-08T06:00:00Z"
    warehouse.append_table(table(spark, "companies", [company("9", "lead", at)]), "companies")
    dying_publish(monkeypatch)
    with pytest.raises(OSError, match="lost"):
        migrate.migrate_snapshots(sources(spark), warehouse, as_of=AS_OF, clear_previous=False)
    assert stored(warehouse, "companies", "company_id") == ["1", "2", "3", "9"]
    checked = migrate.migrate_snapshots(sources(spark), warehouse, as_of=AS_OF, clear_previous=False)
    assert stored(warehouse, "companies", "company_id") == ["1", "2", "3", "9"]
    found = {(r["table"], str(r["snapshot_id"])[:10]): r["verified"] for r in checked.collect() if r["snapshot_id"]}
    assert found[("companies", "2025-06-08")] is False and found[("deals", "2025-06-08")] is True


def test_a_changed_value_with_equal_counts_is_seen(spark, warehouse, tmp_path):
    migrate.migrate_snapshots(sources(spark), warehouse, as_of=AS_OF)
    rows = warehouse.read("companies")
    taken = digests(rows, ["snapshot_id"])
    kept = {"companies": spark.createDataFrame(taken.collect(), taken.schema)}
    changed = rows.withColumn("lifecycle_stage", F.when(F.col("company_id") == "3", "z").otherwise(F.col("lifecycle_stage")))
    warehouse.replace_snapshots(changed, "companies", [S1])
    found = {str(r["snapshot_id"])[:10]: (r["source_rows"] == r["target_rows"], r["verified"]) for r in migrate.migration_check(kept, warehouse).collect()}
    assert found == {"2025-06-01": (True, False), "2025-06-08": (True, True)}


def test_mirror_contents(spark, tmp_path):
    source, target = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"))
    source.append_table(table(spark, "companies", [company("1", "lead"), company("2", None)]), "companies")
    source.mirror_dataset(target)
    fresh = Warehouse(spark, source.root)
    for side in (source, fresh):
        assert [r["verdict"] for r in side.verify_mirror(target).collect()] == ["valid"]
    target.replace_snapshots(table(spark, "companies", [company("1", None), company("2", "lead")]), "companies", [S1])
    for side in (source, fresh):
        assert [r["verdict"] for r in side.verify_mirror(target).collect()] == ["content mismatch"]


def test_digests_see_moved_nulls_and_repeats(spark):
    rows = literal_table(spark, [("a", None), ("b", "c")], "x string, y string")
    one = digests(rows).first()
    assert digests(rows.orderBy("y")).first() == one
    assert digests(literal_table(spark, [(None, "a"), ("b", "c")], "x string, y string")).first() != one
    assert digests(rows.unionByName(rows)).first() != one
    assert tuple(digests(rows.limit(0)).first()) == (0, 0, 0)


def landed(spark, tmp_path, bad=False):
    paths = {}
    company_page = '{"results":[{"id":"1","properties":{"name":"A"}},{"id":"2","properties":{"name":"B"}}]}'
    deal_page = '{"results":[{"id":"7","properties":{"dealname":"D"}}]}'
    files = {"companies": company_page, "deals": deal_page, "owners": '{"results":[]}', "deal_stage_reference": '{"results":[]}'}
    for name, text in files.items():
        folder = tmp_path / f"landed-{name}"
        folder.mkdir(exist_ok=True)
        (folder / "page.json").write_text(text)
        paths[name] = str(folder)
    if bad:
        paths["owners"] = str(tmp_path / "nowhere")
    return paths


def run_ingest(warehouse, paths, at, **more):
    return ingest.ingest_snapshot(warehouse, paths, ingest.object_configs("owner"), S1, dry_run=False, as_of=as_timestamp(at), **more)


def test_an_ingest_that_failed_can_be_repeated(spark, warehouse, tmp_path, monkeypatch):
    with pytest.raises(Exception):
        run_ingest(warehouse, landed(spark, tmp_path, bad=True), "2025-07-01T00:00:00Z")
    assert not warehouse.exists("companies")
    with monkeypatch.context() as patch:
        dying_publish(patch)
        with pytest.raises(OSError, match="lost"):
            run_ingest(warehouse, landed(spark, tmp_path), "2025-07-01T01:00:00Z")
    assert stored(warehouse, "companies", "company_id") == ["1", "2"] and not warehouse.exists("deals")
    run_ingest(warehouse, landed(spark, tmp_path), "2025-07-01T02:00:00Z")
    assert stored(warehouse, "companies", "company_id") == ["1", "2"] and stored(warehouse, "deals", "deal_id") == ["7"]
    run_ingest(warehouse, landed(spark, tmp_path), "2025-07-01T03:00:00Z")
    assert stored(warehouse, "companies", "company_id") == ["1", "1", "2", "2"]
    run_ingest(warehouse, landed(spark, tmp_path), "2025-07-01T04:00:00Z", replace=True)
    assert stored(warehouse, "companies", "company_id") == ["1", "2"] and stored(warehouse, "deals", "deal_id") == ["7"]


def test_units_and_history_change_together(spark, warehouse, monkeypatch):
    warehouse.append_table(table(spark, "companies", [company("1", "lead", S1), company("2", "lead", S2)]), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "qualifiedtobuy", S1)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    score.score_snapshots(warehouse, [S1, S2], AS_OF)
    before = [sorted(map(str, warehouse.read(n).collect())) for n in (score.UNITS_TABLE, score.HISTORY_TABLE)]
    monkeypatch.setattr(score, "score_history", lambda rows, at: rows.select(F.raise_error(F.lit("midway"))))
    with pytest.raises(Exception):
        score.score_snapshots(warehouse, [S1], as_timestamp("2025-08-01T00:00:00Z"))
    assert [sorted(map(str, warehouse.read(n).collect())) for n in (score.UNITS_TABLE, score.HISTORY_TABLE)] == before


def test_unfinished_loads(spark):
    name = "load-" + "0" * 32
    note = registry_log.load_note("began", name)
    rows = table(spark, "snapshot_registry", [
        {"snapshot_id": S1, "triggered_by": "manual", "status": "started", "notes": note, "record_timestamp": S1},
        {"snapshot_id": S2, "triggered_by": "manual", "status": "started", "notes": note, "record_timestamp": S1},
        {"snapshot_id": S2, "triggered_by": "x", "status": "completed", "notes": note, "record_timestamp": S1},
        {"snapshot_id": S2, "triggered_by": "x", "status": "started", "notes": None, "record_timestamp": S1}])
    assert [r["snapshot_id"].day for r in registry.unfinished_loads(rows).collect()] == [1]


def test_gate_refuses_snapshots_without_data_before_anything_is_written(spark, warehouse):
    warehouse.append_table(table(spark, "companies", [company("1", "lead", s) for s in (S1, S2)]), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "qualifiedtobuy", S1)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    refused = score.score_snapshots(warehouse, [S1, S2], AS_OF, gate=True).collect()
    assert {r["error"] for r in refused} == {"no rows in owners_data", "no rows in snapshot_deals, owners_data"}
    assert not warehouse.exists(score.UNITS_TABLE) and warehouse.read("snapshot_registry").filter("status = 'failed'").count() == 2
    warehouse.append_table(table(spark, "owners", [{"owner_id": "o1"}]), "owners")
    found = {r["snapshot_id"].day: (r["status"], r["error"]) for r in score.score_snapshots(warehouse, [S1, S2], AS_OF, gate=True).collect()}
    assert found == {1: ("success", None), 8: ("error", "no rows in snapshot_deals")}
    assert [r["snapshot_id"].day for r in warehouse.read(score.UNITS_TABLE).collect()] == [1]


def test_gated_ingest(spark, warehouse, tmp_path):
    with pytest.raises(ValueError, match="nothing landed for owners, deal_stage_reference"):
        run_ingest(warehouse, landed(spark, tmp_path), "2025-07-01T00:00:00Z", gate=True)
    assert warehouse.tables() == []


def test_digest_sums_are_taken_in_longs_and_exact(spark):
    rows = spark.range(300).selectExpr("CAST(id AS STRING) AS x", "IF(id % 3 = 0, NULL, id) AS y")
    found = digests(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(" not in plan
    hashes = [r[0] for r in rows.select(row_hash(rows.columns)).collect()]
    assert min(hashes) < 0 < max(hashes) and int(found.first()["hash_sum"]) == sum(hashes)

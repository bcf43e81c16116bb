"""The registry as a log: folding, files and compaction."""

import random

import pytest

from stagetally.operators import registry
from stagetally.plans import registry_log, score
from stagetally.session import literal_table
from stagetally.sources import log
from stagetally.sources.warehouse import Warehouse, as_timestamp
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, stages, table

SNAPSHOTS = [f"2025-0{m}-01T06:00:00Z" for m in range(1, 7)]
_RAW = "triggered_by string, status string, notes string, snapshot_id string, record_timestamp string, _entry bigint, _removes array<string>, _status string, _note string"


def files(warehouse):
    return [p for p, _ in log._files(warehouse)]


def shown(warehouse):
    rows = warehouse.read("snapshot_registry").collect()
    return sorted((str(r["snapshot_id"]), r["triggered_by"], r["status"], r["notes"]) for r in rows)


def test_folding_against_replaying(spark):
    rng = random.Random(8)
    rows, state = [], []
    for entry in range(1, 200):
        snapshot = rng.choice([None, "s1", "s2", "s3"])
        kind = rng.random()
        if kind < 0.2:
            gone = rng.sample("abcd", rng.randrange(1, 4))
            rows.append((None, None, None, snapshot, None, entry, gone, None, None))
            state = [r for r in state if not (r[0] == snapshot and r[1] in gone)]
            if rng.random() < 0.5:
                rows.append(("a", "new", None, snapshot, None, entry, None, None, None))
                state.append([snapshot, "a", "new", None])
        elif kind < 0.35:
            status, note = f"st{entry}", rng.choice([None, f"n{entry}"])
            rows.append((None, None, None, snapshot, None, entry, None, status, note))
            for r in state:
                if r[0] == snapshot:
                    r[2], r[3] = status, r[3] if note is None else f"{r[3] or ''} | {note}"
        else:
            trigger = rng.choice("abcd")
            rows.append((trigger, "x", "first", snapshot, None, entry, None, None, None))
            state.append([snapshot, trigger, "x", "first"])
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, _RAW)
    want = sorted(map(str, map(tuple, state)))
    found = registry.current_rows(df)
    assert found.columns == ["triggered_by", "status", "notes", "snapshot_id", "record_timestamp"]
    assert sorted(str((r["snapshot_id"], r["triggered_by"], r["status"], r["notes"])) for r in found.collect()) == want
    again = registry.current_rows(df, keep_entry=True)
    twice = registry.current_rows(again.selectExpr("*", "CAST(NULL AS array<string>) AS _removes", "CAST(NULL AS string) AS _status", "CAST(NULL AS string) AS _note"))
    assert sorted(str((r["snapshot_id"], r["triggered_by"], r["status"], r["notes"])) for r in twice.collect()) == want


def test_every_change_is_one_file(spark, warehouse):
    registry_log.register_scoring_start(warehouse, SNAPSHOTS, AS_OF)
    assert len(files(warehouse)) == 1 and not warehouse._folders(warehouse.path("snapshot_registry"))
    registry_log.register_scoring_start(warehouse, SNAPSHOTS[:4], AS_OF)
    registry_log.register_scoring_failure(warehouse, SNAPSHOTS[:2], "lost", AS_OF)
    registry_log.update_status(warehouse, SNAPSHOTS[5], "checked", "by hand")
    assert len(files(warehouse)) == 4
    found = shown(warehouse)
    assert [r[1] for r in found] == ["scoring_failure"] * 2 + ["scoring_start"] * 4
    assert found[5][2:] == ("checked", "scoring began | by hand")
    warehouse.forget_trigger("scoring_failure")
    assert [r[1] for r in shown(warehouse)] == ["scoring_start"] * 4


def test_scoring_many_snapshots_writes_two_files(spark, warehouse):
    rows = [company("1", "lead", s) for s in SNAPSHOTS]
    warehouse.append_table(table(spark, "companies", rows), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "qualifiedtobuy", s) for s in SNAPSHOTS]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    score.score_snapshots(warehouse, SNAPSHOTS, AS_OF)
    assert len(files(warehouse)) == 2  # the start of all, the end of all
    assert [r[1] for r in shown(warehouse)] == ["scoring_completion", "scoring_start"] * 6


def test_small_files_are_merged_by_tiers(spark, warehouse):
    plain = []
    for i in range(40):
        snapshot = SNAPSHOTS[i % 6]
        registry_log.register_event(warehouse, snapshot, f"t{i}", "started", None, AS_OF)
        plain.append(f"t{i}")
        if i % 10 == 9:
            registry_log.update_status(warehouse, SNAPSHOTS[0], f"round{i}")
    assert len(files(warehouse)) < 16
    found = {r["triggered_by"]: r["status"] for r in warehouse.read("snapshot_registry").collect()}
    assert sorted(found) == sorted(plain)
    assert {t: s for t, s in found.items() if int(t[1:]) % 6 == 0} == {f"t{i}": "round39" for i in range(0, 40, 6)}
    assert {s for t, s in found.items() if int(t[1:]) % 6} == {"started"}


def test_a_registry_stored_by_snapshot_becomes_a_log(spark, warehouse):
    rows = table(spark, "snapshot_registry", [logged(S1, "manual", "started", S1), logged(S2, "manual", "started", S2, "n")])
    rows.write.partitionBy("snapshot_id").parquet(warehouse.path("snapshot_registry"))
    assert [r[1:] for r in shown(warehouse)] == [("manual", "started", None), ("manual", "started", "n")]
    registry_log.update_status(warehouse, S2, "failed", "why")
    assert not warehouse._folders(warehouse.path("snapshot_registry"))
    assert [r[1:] for r in shown(warehouse)] == [("manual", "started", None), ("manual", "failed", "n | why")]


def test_mirrored_logs_and_other_names(spark, tmp_path):
    source = Warehouse(spark, str(tmp_path / "a"))
    registry_log.register_scoring_start(source, [S1, S2], AS_OF)
    registry_log.update_status(source, S1, "checked")
    target = Warehouse(spark, str(tmp_path / "b"), column_names={"snapshot_registry": {"notes": "remarks"}})
    source.mirror_dataset(target)
    assert shown(target) == shown(source)
    registry_log.update_status(target, S2, "failed", "why")
    assert shown(target)[1][2:] == ("failed", "scoring began | why")
    assert "remarks" in spark.read.parquet(target.path("snapshot_registry")).columns


def test_snapshot_filters_reach_the_files(spark, warehouse):
    registry_log.register_scoring_start(warehouse, SNAPSHOTS, AS_OF)
    one = warehouse.read_table_for_snapshot("snapshot_registry", SNAPSHOTS[2])
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(snapshot_id), EqualTo(snapshot_id" in one._jdf.queryExecution().executedPlan().toString()


def test_entries_grow(monkeypatch):
    monkeypatch.setattr(log.time, "time_ns", lambda: 5_000)
    first = log.next_entry()
    assert log.next_entry() == first + 1
    assert as_timestamp(S1) < as_timestamp(S2)


@pytest.mark.parametrize("empty", [True, False])
def test_an_empty_or_absent_registry(spark, warehouse, empty):
    if empty:
        warehouse.append_table(literal_table(spark, [], warehouse.read_or_empty("snapshot_registry").schema), "snapshot_registry")
    assert warehouse.read_or_empty("snapshot_registry").count() == 0
    registry_log.update_status(warehouse, S1, "x")
    assert warehouse.read("snapshot_registry").count() == 0

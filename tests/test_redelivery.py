"""Messages that are delivered again, and batches that are repeated."""

import json

import pytest

from stagetally.operators import registry
from stagetally.plans import registry_log
from stagetally.sources.warehouse import as_timestamp
from stagetally.streaming import scoring as streams
from tests.fixtures import AS_OF, S1, S2, company, deal, logged, stages, table


def message(snapshot, n=1, kind="crm.snapshot.completed"):
    return json.dumps({"type": kind, "data": {"snapshot_id": snapshot, "data_tables": {"companies": n}}})


@pytest.fixture
def scored(spark, warehouse, monkeypatch):
    """A warehouse to score, and the list of snapshots each scoring run took."""
    warehouse.append_table(table(spark, "companies", [company("1", "lead", s) for s in (S1, S2)]), "companies")
    warehouse.append_table(table(spark, "deals", [deal("a", "1", "x", S1)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    runs, whole = [], registry_log.register_scoring_start
    monkeypatch.setattr(registry_log, "register_scoring_start", lambda w, ids, *a: runs.append(sorted(as_timestamp(s).day for s in ids)) or whole(w, ids, *a))
    return warehouse, runs


def run(spark, warehouse, tmp_path, checkpoint="ck", **more):
    source = streams.read_messages(spark, str(tmp_path / "in"))
    streams.score_on_event(source, warehouse, str(tmp_path / checkpoint), available_now=True, **more).awaitTermination()


def put(tmp_path, name, *lines):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")


def test_a_message_in_two_micro_batches_is_scored_once(spark, scored, tmp_path):
    warehouse, runs = scored
    put(tmp_path, "1.txt", message(S1), message(S1))
    run(spark, warehouse, tmp_path)
    put(tmp_path, "2.txt", message(S1))
    run(spark, warehouse, tmp_path)
    assert runs == [[1]]
    put(tmp_path, "3.txt", message(S1), message(S2), message(S1, 2))
    run(spark, warehouse, tmp_path)
    assert runs == [[1], [1, 8]]


def test_without_a_time_redelivered_messages_are_scored_again(spark, scored, tmp_path):
    warehouse, runs = scored
    for name in ("1.txt", "2.txt"):
        put(tmp_path, name, message(S1))
        run(spark, warehouse, tmp_path, redelivered_within=None)
    assert runs == [[1], [1]]


def test_a_batch_that_was_cut_off_does_not_score_again(spark, scored):
    warehouse, runs = scored
    batch = spark.createDataFrame([(message(S1),), (message(S2),)], "value string")
    first = batch.limit(1)
    streams.handle_batch(first, warehouse, batch_name="stream x, batch 3")
    streams.handle_batch(batch, warehouse, batch_name="stream x, batch 3")
    streams.handle_batch(batch, warehouse, batch_name="stream x, batch 3")
    assert runs == [[1], [8]]
    streams.handle_batch(first, warehouse, batch_name="stream x, batch 30")
    assert runs == [[1], [8], [1]]


def test_a_repeated_request_for_all_is_logged_and_scored_once(spark, scored):
    warehouse, runs = scored
    warehouse.append_table(table(spark, "snapshot_registry", [logged(s, "ingest_completion", "completed", s) for s in (S1, S2)]), "snapshot_registry")
    batch = spark.createDataFrame([(message(None, kind="crm.rescore.all"),)], "value string")
    for _ in range(2):
        streams.handle_batch(batch, warehouse, batch_name="stream y, batch 0")
    assert runs == [[1, 8]]
    assert warehouse.read("snapshot_registry").filter("triggered_by = 'rescore_step4'").count() == 1


def test_a_failed_batch_is_scored_when_it_is_repeated(spark, scored):
    warehouse, _ = scored
    registry_log.register_scoring_start(warehouse, [S1], AS_OF, "stream z, batch 1")
    registry_log.register_scoring_failure(warehouse, [S1], "lost", AS_OF)
    registry_log.register_scoring_start(warehouse, [S2], AS_OF, "stream z, batch 1")
    registry_log.register_scoring_completion(warehouse, S2, 0, AS_OF)
    rows = registry.scored_in_batch(warehouse.read("snapshot_registry"), "stream z, batch 1")
    assert [r["snapshot_id"].day for r in rows.collect()] == [8]


def test_only_requests_reach_the_stream_state(spark, scored, tmp_path):
    warehouse, runs = scored
    put(tmp_path, "1.txt", message(S1), message(S1), "noise", *[message(S1, n, "crm.other") for n in range(20)], message("no id"))
    source = streams.read_messages(spark, str(tmp_path / "in"))
    stream = streams.score_on_event(source, warehouse, str(tmp_path / "ck"), available_now=True)
    stream.awaitTermination()
    assert runs == [[1]]
    assert max(op["numRowsTotal"] for p in stream.recentProgress for op in p["stateOperators"]) == 1

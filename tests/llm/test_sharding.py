import itertools
import random
import zlib

import pytest

from stagetally.llm import queries, sharding

from .conftest import ODD


@pytest.mark.parametrize("seed", range(12))
def test_flow_moves_the_fewest_bytes(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(50) for _ in range(rng.randrange(1, 7))]
    capacities = sharding.even_capacities(sum(sizes), rng.randrange(1, 9))
    flow = sharding.least_moves(sizes, capacities)
    assert [sum(f) for f in flow] == sizes
    assert [sum(f[j] for f in flow) for j in range(len(capacities))] == capacities
    stays = sum(flow[i][i] for i in range(min(len(sizes), len(capacities))))
    assert stays == sum(min(a, b) for a, b in zip(sizes, capacities))


def test_flow_with_costs_against_all_assignments():
    cost = [[4, 1, 3], [2, 0, 5], [3, 2, 2]]
    flow = sharding.least_moves([1, 1, 1], [1, 1, 1], lambda i, j: cost[i][j])
    least = min(sum(cost[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(3)))
    assert sum(cost[i][j] * flow[i][j] for i in range(3) for j in range(3)) == least


def test_too_little_room_is_refused():
    with pytest.raises(ValueError):
        sharding.least_moves([5], [4])


def test_query(spark, docs, folder):
    rng = random.Random(4)
    rows = ODD + [(100 + i, "é" * rng.randrange(400)) for i in range(900)] + [(77, "same")] * 300
    got = queries.op7_resharding(spark, folder(documents=docs(rows))).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(shards) <= set(range(16))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))


def test_shards_come_out_even_and_most_bytes_stay(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(1, 100), min(i % 7, 3)) for i in range(3000)]
    total = sum(s for _, s, _ in rows)
    df = spark.createDataFrame(rows, "doc_id long, size long, old long")
    got = sharding.resharded(df, "old", "size", lambda t: sharding.even_capacities(t, 6), block_rows=100).collect()
    held = [sum(r["size"] for r in got if r["shard"] == j) for j in range(6)]
    assert max(held) - min(held) < 400
    old = [sum(s for _, s, o in rows if o == j) for j in range(6)]
    least = total - sum(min(a, total / 6) for a in old)
    assert sum(r["size"] for r in got if r["shard"] != r["old"]) <= least + 600


def test_only_affected_shards_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, 0, 0), (2, 10, 1, 2), (3, 5, 2, 2), (4, 5, 3, 3)], "doc_id long, size long, old long, shard int")
    assert sharding.rewrite(df, "old", str(tmp_path / "out")) == [1, 2]
    assert {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2, 3}


def test_empty_table(spark, docs, folder):
    assert queries.op7_resharding(spark, folder(documents=docs([]))).count() == 0


def test_emptied_shards_leave_no_files(spark, tmp_path):
    out = str(tmp_path / "out")
    ids = [(i, i % 4) for i in range(40)]
    spark.createDataFrame(ids, "id long, shard int").write.partitionBy("shard").parquet(out)
    moved = spark.createDataFrame([(i, s, s if s < 2 else i % 2) for i, s in ids], "id long, old int, shard int")
    assert sharding.rewrite(moved, "old", out) == [0, 1, 2, 3]
    got = sorted((r["id"], r["shard"]) for r in spark.read.parquet(out).select("id", "shard").collect())
    assert got == sorted((i, s if s < 2 else i % 2) for i, s in ids)

import numpy as np
import pytest

from stagetally.llm import neighbours, queries

NAN, INF = float("nan"), float("inf")


def slow(vectors, k, is_query):
    """Exact search by sorting all products."""
    usable = [(i, np.array(v, float)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    found = {}
    for q in {i for i, _ in usable if is_query(i)}:
        own = min((v for i, v in usable if i == q), key=list)
        scored = [((v * own).sum(), i) for i, v in usable if i != q and len(v) == len(own)]
        found[q] = sorted(scored, key=lambda x: (-x[0], x[1]))[:k]
    return found


@pytest.mark.parametrize("blocks", [(4096, 256), (16, 4), (7, 1)])
def test_search_against_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    vectors += [(200 + i, vectors[0][1]) for i in range(40)]
    vectors += [(300, None), (301, [0.0] * 6), (302, [NAN] * 6), (303, [INF] + [0.0] * 5), (304, [None] + [1.0] * 5), (305, [])]
    vectors += [(320, [1.0, 2.0]), (321, [3.0, 4.0]), (None, [1.0] * 6), (20, vectors[20][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, id int, d int")
    got = {}
    for r in neighbours.nearest(df, "vec_id", "embedding", lambda c: c % 20 == 0, 5, blocks[1], blocks[0], fan_in=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = slow(vectors, 5, lambda i: i % 20 == 0)
    assert set(got) == {q for q, w in want.items() if w}
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert [v for _, v, _ in rows] == [i for _, i in want[q]]
        assert np.allclose([s for _, _, s in rows], [s for s, _ in want[q]], rtol=1e-13)


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(30, 1500)), rng.normal(size=(40, 1500)) * 1e3
    (ac, asc, an, ae), (bc, bsc, bn, be) = neighbours.quantised(a), neighbours.quantised(b)
    near = neighbours.tile_products(ac, bc) * asc[:, None] * bsc[None, :]
    bound = ae[:, None] * (bn + be)[None, :] + an[:, None] * be[None, :]
    assert (np.abs(a @ b.T - near) <= bound * (1 + 1e-9)).all()


def test_empty_table(spark, folder):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert queries.op2_neighbours(spark, folder(embeddings=df)).count() == 0

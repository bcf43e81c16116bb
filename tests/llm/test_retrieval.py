import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from stagetally.llm import packing, queries, retrieval

from .conftest import ODD


def slow_scores(texts, seed, k1=1.2, b=0.75):
    own, mean = [Counter(t) for t in texts], max(1.0, np.mean([len(t) for t in texts]))
    out = []
    for t, tf in zip(texts, own):
        score = 0
        for x in own[seed]:
            df = sum(x in o for o in own)
            idf = max(0.0, math.log((len(texts) - df + 0.5) / (df + 0.5)))
            if tf[x]:
                score += math.floor(idf * tf[x] * (k1 + 1) / (tf[x] + k1 * (1 - b + b * len(t) / mean)) * (1 << 16))
        out.append(score)
    return out


def slow_windows(texts, window):
    left, out, rest = [len(t) for t in texts], [], None
    while any(left):
        seed = rest if rest is not None else next(i for i, n in enumerate(left) if n)
        scores, take, rest, own, room = slow_scores(texts, seed), seed, None, [], window
        while True:
            n = min(room, left[take])
            own.append((take, len(texts[take]) - left[take], n))
            left[take] -= n
            room -= n
            if left[take]:
                rest = take
            unused = [i for i, n in enumerate(left) if n]
            if not room or not unused:
                break
            fits = [i for i in unused if left[i] <= room and scores[i] > 0] or unused
            take = max(fits, key=lambda i: (scores[i], -i))
        out.append(own)
    return out


def shard(seed, docs=60):
    rng = random.Random(seed)
    return [np.array([rng.randrange(30) + 25 * (d % 3) for _ in range(rng.randrange(1, 40))]) for d in range(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_index_and_windows_against_brute_force(seed):
    texts = shard(seed)
    index = retrieval.Index(texts)
    for i in range(0, len(texts), 7):
        got, want = index.scores(i), slow_scores(texts, i)
        assert np.abs(got - want).max() <= 40  # one unit a term: logarithms may differ in their last bit
    assert retrieval.filled(texts, 64) == slow_windows(texts, 64)


def test_neighbours_share_more_terms_than_others():
    texts = shard(4, 300)
    topic = lambda own: len({d % 3 for d, _, _ in own}) == 1
    windows = retrieval.filled(texts, 64)
    assert sum(map(topic, windows)) > 0.8 * len(windows)
    assert all(sum(n for _, _, n in w) == 64 for w in windows[:-1])


def test_short_windows_are_cut_at_powers_of_two():
    got = retrieval._powers([(0, 5, 30), (1, 0, 15)], 64)
    assert got == [[(0, 5, 30), (1, 0, 2)], [(1, 2, 8)], [(1, 10, 4)], [(1, 14, 1)]]
    assert retrieval._powers([(0, 0, 64)], 64) == [[(0, 0, 64)]]


def check(rows, found, tokens):
    encode, pieces, sequences = packing.public_encoder(), {}, {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    wanted = Counter(k for k, _ in rows)
    assert set(pieces) == set(wanted)
    for key, text in rows:
        ids = np.array([*encode(text or ""), 0], "<u4")
        own = sorted(pieces[key], key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == sum(len(encode(t or "")) + 1 for k, t in rows if k == key)
        if wanted[key] == 1:
            assert {r["doc_tokens"] for r in own} == {len(ids)}
            at = 0
            for r in own:
                assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]]
        assert ends[-1] <= tokens and ends[-1].bit_count() == 1


def test_query_gives_back_every_id(spark, docs, folder):
    rows = ODD + [(20 + i, f"word {i % 5} " * (i * 23)) for i in range(60)] + [(200 + i, "a copy of this text " * 40) for i in range(50)]
    found = queries.op12_retrieval(spark, folder(documents=docs(rows).repartition(4))).collect()
    assert set(found[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    check(rows, found, 1024)


def test_many_shards(spark, docs):
    rows = [(i, f"the {i % 7} words of this " * (i % 90)) for i in range(400)]
    found = retrieval.packed_with_neighbours(docs(rows), "doc_id", "text", tokens=256, shard_rows=16)
    check(rows, found.withColumnRenamed("key", "doc_id").collect(), 256)


def test_empty_table(spark, docs, folder):
    assert queries.op12_retrieval(spark, folder(documents=docs([]))).count() == 0

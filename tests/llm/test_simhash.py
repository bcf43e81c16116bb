import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from stagetally.llm import queries, simhash

from .conftest import ODD


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(prints, radius):
    parent = {i: i for i in range(len(prints))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@given(st.text(alphabet=" \t\n aAzÉßé.,\U0001f600", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_as_defined(text):
    got = simhash.fingerprint(simhash.shingle_hashes(text, 4, 42))
    assert got & (1 << 64) - 1 == slow_fingerprint(text)


@pytest.mark.parametrize("radius,count", [(4, 3), (15, 8), (3, 4), (7, 8), (2, 3)])
def test_some_segment_is_always_within_its_ball(radius, count):
    rng = random.Random(radius)
    plan = simhash.segments(64, count, radius)
    for _ in range(3000):
        bits = rng.sample(range(64), radius)
        assert any(sum(at <= b < at + width for b in bits) <= ball for at, width, ball in plan)


def test_too_few_segments_are_refused():
    with pytest.raises(ValueError):
        simhash.segments(64, 2, 4)


def test_components_against_brute_force(spark):
    rng = random.Random(5)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.append(base)
        for _ in range(rng.randrange(6)):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(7)))
            prints.append(base)
    dense = rng.getrandbits(64)
    prints += [dense ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = [(i * 3, p) for i, p in enumerate(signed)] + [(None, signed[0])]
    got = simhash.near_components(spark.createDataFrame(rows, "key long, f0 long"), ["f0"], 4, 3).collect()
    assert len(got) == len(rows)
    roots = slow_components(prints, 4)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    found = {r["key"]: r["component"] for r in got if r["key"] is not None}
    assert found == {i * 3: least[r] * 3 for i, r in enumerate(roots)}
    assert [r["component"] for r in got if r["key"] is None] == [found[0]]


def test_query_on_odd_rows(spark, docs, folder):
    rows = ODD + [(9, "The quick brown fox jumps"), (8, "the QUICK brown fox jumps")]
    found = {}
    for r in queries.op1_simhash(spark, folder(documents=docs(rows))).collect():
        found.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    for key, text in rows:
        assert found[key][0][0] == format(slow_fingerprint(text), "016x")
    assert len(found[4]) == 2
    assert {found[k][0][1] for k in (1, 2, 3)} == {1}
    assert found[8][0] == found[9][0] and found[9][0][1] == 8
    assert found[None][0][1] == 4


def test_empty_table(spark, docs, folder):
    assert queries.op1_simhash(spark, folder(documents=docs([]))).count() == 0

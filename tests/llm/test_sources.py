import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stagetally.llm import queries, sources

from .conftest import ODD


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow(rows, least=30, top=50):
    own, df, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, found = lang or "", terms(text)
        own[lang, source or ""].update(found)
        df[lang].update(set(found))
        seen[lang].update(found)
    out = []
    kept = {lang: {t for t, n in d.items() if n >= least} for lang, d in df.items()}
    for lang in {g[0] for g in own}:
        terms_ = kept.get(lang, set())
        share = lambda counts: {t: 1 + 10**9 * (counts[t] + 5) // (sum(counts[x] for x in terms_) + 5 * len(terms_)) for t in terms_}
        p, q = {g: share(c) for g, c in own.items() if g[0] == lang}, share(seen[lang])
        for g in p:
            pair = sorted((-sum(abs(p[g][t] - p[h][t]) for t in terms_), h[1].encode(), h[1]) for h in p if h != g)
            over = sorted((q[t] - p[g][t], t.encode(), t) for t in terms_ if own[g][t] and p[g][t] > q[t])[:top]
            out += [(*g, "pair", x[2], -x[0], r + 1) for r, x in enumerate(pair)]
            out += [(*g, "term", x[2], -x[0], r + 1) for r, x in enumerate(over)]
    return sorted(out)


def world(seed, docs=400):
    rng = random.Random(seed)
    vocabulary = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100)] + ["Éa", "éa", "𐐀z", "￮z"]
    rows = [("only here", "zz", "s1"), (None, "zz", "s2"), ("x", None, None)]
    for _ in range(docs):
        source = rng.choice(["s0", "s0", "s0", "s1", "é", "S2", None])
        span = rng.randrange(3, 104)
        rows.append((" ".join(rng.choice(vocabulary[-span:]).title() + rng.choice(["", ",", "9"]) for _ in range(rng.randrange(40))), rng.choice(["aa", "bb", "bb"]), source))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, *r, "t", 1) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, count int")


def test_audit_against_brute_force(spark, folder):
    rows = world(3) + [(t, "aa", "s1") for _, t in ODD] + [("wab wab", "bb", "s0")] * 31
    found = queries.op13_sources(spark, folder(documents=table(spark, rows).repartition(7)))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == slow(rows)


def test_many_blocks_and_other_limits(spark):
    rows = world(4)
    found = sources.divergence(table(spark, rows), "lang", "source", "text", least_documents=2, top=3, cells=40)
    assert sorted(map(tuple, found.collect())) == slow(rows, 2, 3)


def test_counts_are_passed_on_before_they_grow(spark, monkeypatch):
    rows = world(5, 60)
    monkeypatch.setattr(sources, "_HELD", 10)
    found = sources.divergence(table(spark, rows), "lang", "source", "text", least_documents=5)
    assert sorted(map(tuple, found.collect())) == slow(rows, 5)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=3, max_size=3), st.integers(1, 9)), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_run_lengths_give_the_sum_over_all_terms(rows):
    counts, weights = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    totals, terms_ = (counts * weights[:, None]).sum(0), int(weights.sum())
    p = [[1 + 10**9 * (int(c) + 5) // (int(n) + 5 * terms_) for c, n in zip(row, totals)] for row in counts]
    want = [[sum(w * abs(r[a] - r[b]) for r, w in zip(p, weights.tolist())) for b in range(3)] for a in range(3)]
    assert sources.divergences(counts, weights, totals, terms_).tolist() == want


@given(st.integers(0, 2**50), st.integers(0, 2**52))
@settings(max_examples=200, deadline=None)
def test_shares_are_exact(count, rest):
    got = sources.shares(np.array([count]), np.array(count + rest), 1 << 20)
    assert got.tolist() == [1 + 10**9 * (count + 5) // (count + rest + (5 << 20))]


def test_equal_counts_form_runs():
    ends, values = sources.runs(np.array([0, 0, 4, 4, 0]), np.array([2, 3, 1, 1, 7]))
    assert (ends.tolist(), values.tolist()) == ([5, 7, 14], [0, 4, 0])


def test_empty_table_and_no_kept_terms(spark, folder):
    assert queries.op13_sources(spark, folder(documents=table(spark, []))).count() == 0
    rows = [("a b", "x", "s1"), (None, "x", "s2"), (None, None, None)]
    got = queries.op13_sources(spark, folder(documents=table(spark, rows))).collect()
    assert sorted(map(tuple, got)) == [("x", "s1", "pair", "s2", 0, 1), ("x", "s2", "pair", "s1", 0, 1)]

import math
import random
import re
from collections import Counter

import numpy as np

from stagetally.llm import queries, ranking

from .conftest import ODD


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow(docs, items, k=10):
    own = [(i, terms(t)) for i, t in docs]
    n, length = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = Counter(x for _, t in own for x in set(t))
    out = []
    for item, text in items:
        found = []
        for key, t in own:
            tf, m = Counter(t), 10 + (90 * len(t) * n) // length if length else 10
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
                for x in set(terms(text))
            )
            found += [(-score, key is None, key or 0, key)] if score else []
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=str)


def world(seed, docs=150, items=45):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "éa", "çb9", "x_y"]
    text = lambda n: " ".join(rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words[: 1 + rng.randrange(64)]) for _ in range(n))
    rows = [(i, text(rng.randrange(60))) for i in range(docs)]
    copies = [(1000 + i, rows[7][1]) for i in range(60)]
    return rows + copies + [rows[3], rows[3]], [(i, text(rng.randrange(1, 30))) for i in range(items)]


def got(rows):
    return sorted(((r["item_id"], r["rank"], r[2], r["score"]) for r in rows), key=str)


def test_search_against_brute_force(spark, docs, folder):
    rows, items = world(1)
    items += [(70, None), (71, ""), (72, "..."), (None, "w1 w2"), (0, items[0][1]), (73, "nowhere at all"), (74, "x " * 30_000)]
    bench = spark.createDataFrame([(i, t, "x", 3) for i, t in items], "item_id long, text string, bag string, m int")
    found = queries.op11_ranking(spark, folder(documents=docs(ODD + rows), benchmark=bench))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found.collect()) == slow(ODD + rows, items)


def test_items_in_several_groups_and_other_k(spark, docs):
    rows, items = world(2)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    for k in (1, 25):
        found = ranking.ranked(docs(rows), "doc_id", "text", bench, "item_id", "text", k=k, block_bytes=1500)
        assert got(found.collect()) == slow(rows, items, k)


def test_one_class_for_equal_bags(spark):
    bag = np.array([0, 2, 1, 5], "<i4").tobytes()
    rows = [(None, 9, bag)] + [(i, 9, bag) for i in range(40, 0, -1)] + [(7, 10_000, bag), (8, 9, b"")]
    made = ranking.classes(spark.createDataFrame(rows, "key long, n long, bag binary").repartition(5), 30, 300, 4).collect()
    assert sorted((r["m"], r["members"]) for r in made) == [(10 + 90 * 9 * 30 // 300, [1, 2, 3, 4]), (10 + 90 * 10_000 * 30 // 300, [7])]


def test_sums_beyond_doubles_are_exact(spark):
    bag = np.array([0, 1, 1, 1], "<i4").tobytes()
    grouped = spark.createDataFrame([(10, bag, [1])], "m long, bag binary, members array<long>")
    weights, held = np.array([1 << 40, 1]), [(5, np.array([0, 1]))]
    share = 10**9 // 1080
    found = ranking.best_in_tasks(grouped, weights, held, 3).collect()
    assert [tuple(r) for r in found] == [(5, (1 << 40) * share + share, 1)]


def test_empty_tables(spark, docs, folder):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert queries.op11_ranking(spark, folder(documents=docs(ODD), benchmark=none)).count() == 0
    assert queries.op11_ranking(spark, folder(documents=docs([]), benchmark=some)).count() == 0
    assert queries.op11_ranking(spark, folder(documents=docs([(1, None), (2, "")]), benchmark=some)).count() == 0

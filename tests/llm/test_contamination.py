import random

from stagetally.llm import contamination, queries

from .conftest import ODD


def shingles(text):
    words = contamination.words_of(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def slow(docs, items):
    found = set()
    for (d, text), (i, item) in ((a, b) for a in docs for b in items):
        own, wanted, few = shingles(text), shingles(item), contamination.words_of(item)
        if i is not None and few and not wanted:
            words = contamination.words_of(text)
            if any(words[k : k + len(few)] == few for k in range(len(words))):
                found.add((d, i, 1.0))
        if i is not None and wanted and len(own & wanted) / len(wanted) >= 0.8:
            found.add((d, i, len(own & wanted) / len(wanted)))
    return found


def world(seed):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(5, 90)))) for i in range(40)]
    docs = []
    for d in range(120):
        text = words(rng.randrange(1, 1500))
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)[1].split()
            cut = rng.choice([0, 0, len(item) // 12, len(item) // 3])
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," for w in item[cut:]]
        docs.append((100 + d, " ".join(text)))
    return docs, items


def test_search_against_brute_force(spark, docs, folder):
    rows, items = world(8)
    items += [(60, None), (None, "a b c d e f"), (61, "too short here"), (62, items[0][1]), (0, items[0][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, containment string")
    got = queries.op6_contamination(spark, folder(documents=docs(ODD + rows), benchmark=bench)).collect()
    want = slow([r for r in ODD if r[1]] + rows, items)
    assert want and len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == want


def test_blocks_of_items_give_the_same(spark, docs):
    rows, items = world(9)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows)
    got = contamination.with_hits(df, "text", bench, "item_id", "text", block_items=9)
    assert got.columns == [*df.columns, contamination.HITS]
    found = {(r["doc_id"], h["item_id"], h["containment"]) for r in got.collect() for h in r[contamination.HITS]}
    assert found == slow(rows, items)


def test_items_of_few_words(spark, docs, folder):
    rows, items = world(10)
    rng = random.Random(1)
    few = [(500 + i, " ".join(rng.choice(rows)[1].split()[k : k + 1 + i % 4]).upper() + "!") for i, k in enumerate(range(0, 60, 2))]
    few += [(600, "beta gamma delta"), (601, "never there"), (602, "?!"), (603, "x")]
    rows = rows + ODD + [(900, "alpha Beta, gamma delta"), (901, "beta gamma"), (902, "beta x gamma delta")]
    bench = spark.createDataFrame(items + few, "item_id long, text string")
    got = {tuple(r) for r in queries.op6_contamination(spark, folder(documents=docs(rows), benchmark=bench)).collect()}
    assert got == slow([r for r in rows if r[1]], items + few)
    assert (900, 600, 1.0) in got and not {(901, 600, 1.0), (902, 600, 1.0)} & got and any(i >= 500 for _, i, _ in got)


def test_empty_tables(spark, docs, folder):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert queries.op6_contamination(spark, folder(documents=docs(ODD), benchmark=none)).count() == 0
    assert queries.op6_contamination(spark, folder(documents=docs([]), benchmark=some)).count() == 0

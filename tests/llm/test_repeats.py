import random

from hypothesis import given
from hypothesis import strategies as st

from stagetally.llm import queries, repeats

from .conftest import ODD


def slow(rows, unit, least):
    """Places to remove, by rank, row and place; null ranks first."""
    seen, out = {}, []
    for n, (rank, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])):
        for a, b in repeats.units_of(text or "", unit):
            norm = repeats.normalised((text or "")[a:b])
            if len(norm.split()) >= least:
                if norm in seen:
                    out.append((rank, a, b, *seen[norm]))
                else:
                    seen[norm] = (rank, a)
    return sorted(out, key=str)


def world(seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(3, 15))) + rng.choice([".", "!", "?", ""]) for _ in range(60)]
    join = lambda: rng.choice(["\n", " ", "  ", "\n\n"])
    return [(i, "".join(rng.choice([p, p.upper()]) + join() for p in rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(50)]


@given(st.text(alphabet="ab .!?\n", max_size=60), st.sampled_from(["paragraph", "line", "sentence"]))
def test_units_cover_the_text(text, unit):
    spans = list(repeats.units_of(text, unit))
    assert all(a <= b for a, b in spans) and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    left = "".join(text[b:c] for (_, b), (c, _) in zip(spans, spans[1:]))
    assert not left.strip() and spans[0][0] == 0 and spans[-1][1] == len(text)


def test_query_against_brute_force(spark, docs, folder):
    rows = world(1) + [(r + 500, t) for r, t in world(1)] + ODD
    rows = sorted(rows, key=str)
    df = docs(rows).coalesce(1)
    got = queries.op5_repeats(spark, folder(documents=df)).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, "sentence", 8)


def test_texts_without_repeats_keep_their_places(spark, docs, folder):
    rows = world(2)
    path = folder(documents=docs(rows).coalesce(1))
    stored = spark.read.parquet(f"{path}/documents.parquet")
    got = {r["rank"]: r for r in repeats.deduplicated(stored, "doc_id", "text", "line", 2).collect()}
    cut = {}
    for rank, a, b, *_ in slow(rows, "line", 2):
        cut.setdefault(rank, []).append((a, b))
    for rank, text in rows:
        kept = [text[s["start"] : s["end"]] for s in got[rank]["kept"]]
        assert "".join(kept) == got[rank]["text"]
        assert got[rank]["text"] == repeats.without(text, cut.get(rank, []))[0]


def test_long_passage_within_lines_is_found(spark, docs, folder):
    rng = random.Random(3)
    words = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage = f"{words(9)} {words(6)}. {words(25)}, {words(4)}. {words(20)}"
    rows = [(1, f"{words(30)} {passage} {words(9)}."), (2, f"{words(12)}. {passage} {words(40)}."), (3, f"{words(300)}.")]
    got = queries.op5_repeats(spark, folder(documents=docs(rows))).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(2, 1)}


def test_empty_table(spark, docs, folder):
    assert queries.op5_repeats(spark, folder(documents=docs([]))).count() == 0


def test_passages_against_brute_force(spark, docs, folder):
    rows = sorted(world(1) + [(r + 500, t) for r, t in world(1)] + ODD, key=str)
    got = queries.op5_passages(spark, folder(documents=docs(rows).coalesce(1))).collect()
    seen, want = set(), {}
    for n, (rank, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0])):
        for unit, least in (("paragraph", 1), ("line", 1), ("sentence", 8)):
            for a, b in repeats.units_of(text or "", unit):
                norm = repeats.normalised((text or "")[a:b])
                if len(norm.split()) >= least:
                    if (unit, norm) in seen:
                        want.setdefault((n, rank), set()).update(range(a, b))
                    seen.add((unit, norm))
    count = lambda keys: sorted(keys, key=str)
    places = [(r["doc_id"], i) for r in got for i in range(r["start"], r["end"])]
    assert count(places) == count([(rank, i) for (_, rank), own in want.items() for i in own])


def test_short_lines_and_lines_of_short_sentences_are_found(spark, docs, folder):
    line = "the and attion of it all was anea. eriner thanea."
    rows = [(1, f"first text\n{line}\nShare this"), (2, f"other text\n{line}\nShare this\nand more")]
    got = queries.op5_passages(spark, folder(documents=docs(rows))).collect()
    text = rows[1][1]
    assert sorted(text[r["start"] : r["end"]] for r in got if r["doc_id"] == 2) == ["Share this", line] and len(got) == 2


def test_merged_places_name_their_first_copy(spark, docs, folder):
    line, sentence = "a line that both texts hold", "one two three four five six seven eight nine."
    rows = [(1, f"x\n{line}\ny"), (2, f"{sentence} z"), (3, f"{line}\nq {sentence[:-1]}\n{sentence} w")]
    got = sorted((r["doc_id"], r["start"], r["first_doc_id"], r["first_start"]) for r in queries.op5_passages(spark, folder(documents=docs(rows).coalesce(1))).collect())
    text = rows[2][1]
    assert got == [(3, 0, 1, 2), (3, text.index("\none") + 1, 2, 0)]


def test_texts_without_passages_keep_their_places(spark, docs, folder):
    rows = sorted(world(3) + [(r + 500, t) for r, t in world(3)] + ODD, key=str)
    path = folder(documents=docs(rows).coalesce(1))
    stored = spark.read.parquet(f"{path}/documents.parquet")
    cuts = {}
    for r in repeats.repeated_passages(stored, "doc_id", "text").collect():
        cuts.setdefault(r["uid"], []).append((r["start"], r["end"]))
    got = sorted(repeats.without_passages(stored, "doc_id", "text").collect(), key=lambda r: r["uid"])
    assert len(got) == len(rows) and cuts
    for r, (rank, text) in zip(got, rows):
        want, kept = repeats.without(text, cuts.get(r["uid"], []))
        assert (r["rank"], r["text"]) == (rank, want) and [(k["start"], k["end"]) for k in r["kept"]] == kept

import random
import re

import corpus_pipeline as pipeline
import numpy as np
import pytest
from stagetally.llm import langid, packing, simhash

from .conftest import ODD
from .test_contamination import shingles
from .test_simhash import slow_components


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    sound = {"aa": "bdka", "bb": "mnuo"}
    words = lambda lang, n: ["".join(rng.choice(sound[lang]) for _ in range(rng.randrange(3, 9))) for _ in range(n)]
    items = [(i, " ".join(words("aa", 30))) for i in range(5)]
    clean = [(1000 + i, " ".join(words(lang, rng.randrange(60, 400))), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    near = []
    for i in range(20):
        text = clean[i][1].split()
        for at in rng.sample(range(len(text)), max(1, len(text) // 100)):
            text[at] = "changed"
        near.append((500 + i, " ".join(text), clean[i][2]))
    leaks = [(700 + i, " ".join(words("aa", 80) + item.split() + words("aa", 50)), "aa") for i, item in items]
    private = [(800, " ".join(words("bb", 90)) + " write to me@mail.example.com now", "bb")]
    return items, clean, near, leaks, private


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    from .conftest import DOCS

    items, *parts = corpus
    rows = [r for p in parts for r in p] + [(*r, "aa") for r in ODD] + [(900, "123 456", "aa")]
    made = [(i, t, lang, "s", len(t or ""), "h", 1, "f", "z", "q") for i, t, lang in rows]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(made, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {"documents": None}
    out["documents"] = docs
    for name, stage in pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = out[name] = spark.read.parquet(f"{path}/{name}")
    out["folder"] = path
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").where("doc_id IS NOT NULL").collect())


def test_columns_stay(stages):
    for name, _ in pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_keeps_clean_documents(stages, corpus):
    kept = ids(stages["language"])
    assert set(kept) >= {i for part in corpus[1:] for i, _, _ in part}
    assert not {1, 2, 3, 900} & set(kept)
    model = langid.train(stages["documents"].where("doc_id IS NOT NULL").where(~langid.held_out(stages["documents"]["doc_id"])), "text", "lang")
    for r in stages["documents"].collect():
        lang, score, _ = langid.predicted(model, r["text"])
        assert (lang != "und" and score >= pipeline.LEAST_SCORE) == (r["doc_id"] in kept or r["doc_id"] is None)


def test_one_of_each_near_group_stays(stages, corpus):
    before = [r for r in stages["language"].collect()]
    prints = [simhash.fingerprint(simhash.shingle_hashes(r["text"], 4, 42)) & (1 << 64) - 1 for r in before]
    groups = {}
    for r, root in zip(before, slow_components(prints, 4)):
        groups.setdefault(root, []).append(r["doc_id"])
    kept = stages["near_duplicates"].collect()
    assert len(kept) == len(groups) < len(before)
    for own in groups.values():
        assert len([r for r in kept if r["doc_id"] in own]) == 1
    assert {r["doc_id"] for r in kept} >= {i for i, _, _ in corpus[1][20:] + corpus[3] + corpus[4]}


def test_benchmark_passages_go(stages, corpus):
    before, after = stages["near_duplicates"].collect(), set(ids(stages["decontamination"]))
    wanted = [shingles(t) for _, t in corpus[0]]
    for r in before:
        leaks = any(len(shingles(r["text"]) & w) / len(w) >= 0.8 for w in wanted)
        assert leaks == (r["doc_id"] is not None and r["doc_id"] not in after)


def test_personal_data_is_replaced(stages):
    before = {r["doc_id"]: r for r in stages["decontamination"].collect()}
    for r in stages["personal_data"].collect():
        assert r["n_chars"] == len(r["text"])
        if r["doc_id"] == 800:
            assert "me@mail.example.com" not in r["text"] and re.search(r"write to \w+@\w+\.\w+\.com now$", r["text"])
        else:
            assert r["text"] == before[r["doc_id"]]["text"]


def test_packing_takes_every_token(stages):
    encode = packing.public_encoder()
    want = sum(len(encode(r["text"])) + 1 for r in stages["personal_data"].collect())
    rows = stages["packing"].collect()
    assert sum(r["length"] for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= pipeline.TOKENS


def test_run_is_the_stages(spark, stages):
    got = sorted(map(str, pipeline.run(spark, stages["folder"]).drop("sequence_id", "offset").collect()))
    assert got == sorted(map(str, stages["packing"].drop("sequence_id", "offset").collect()))


def test_documents_with_other_words_stay(spark):
    """One word in 30 changed, and a copy of each in another case."""
    rng = random.Random(11)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(300)] for _ in range(20)]
    other = [[w if i % 30 != 15 else f"v{rng.randrange(10**6)}" for i, w in enumerate(t)] for t in texts]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts + other)] + [(100 + i, " ".join(t).upper()) for i, t in enumerate(texts)]
    kept = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    prints = [simhash.fingerprint(simhash.shingle_hashes(t, 4, 42)) & (1 << 64) - 1 for _, t in rows]
    assert ids(kept) == sorted({rows[r][0] for r in slow_components(prints, 4)} & set(range(40))) and len(ids(kept)) > 30

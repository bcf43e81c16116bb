import random
import zlib

import numpy as np
import pytest

from stagetally.llm import langid, queries

from .conftest import ODD

SOUNDS = {"aa": "bdka", "bb": "mnuo", "cc": "rtei", "dd": "szäö", "ee": "кмно"}


def sample(lang, rng, words=30):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(words))


@pytest.mark.parametrize("classes", [1, 2, 3, 4, 7, 12, 40])
def test_codewords_differ_and_split_properly(classes):
    code = langid.codewords(classes)
    assert len(np.unique(code, axis=0)) == classes if code.shape[1] else classes == 1
    assert (np.abs(code.sum(0)) < classes).all()


def test_held_out_accuracy(spark, docs, folder):
    rng = random.Random(1)
    rows = [(i, sample(lang, rng), lang) for i, lang in enumerate(list(SOUNDS) * 60)]
    rows += [(1000 + i, sample("aa", rng), None) for i in range(4)]
    got = {r["doc_id"]: r for r in queries.op10_language(spark, folder(documents=docs(rows))).collect()}
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    tested = [(got[i]["lang_pred"], lang) for i, _, lang in rows if got[i]["held_out"] and lang]
    assert len(tested) > 40 and all(a == b for a, b in tested)
    assert all(got[1000 + i]["lang_pred"] == "aa" for i in range(4))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_a_label_of_the_test_part_teaches_nothing(spark, docs, folder):
    rng = random.Random(2)
    hidden = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    shown = [i for i in range(400) if i not in hidden]
    rows = [(i, sample("aa", rng), "aa") for i in shown] + [(i, sample("bb", rng), "bb") for i in hidden]
    got = queries.op10_language(spark, folder(documents=docs(rows))).collect()
    assert {r["lang_pred"] for r in got} == {"aa"}


def test_mixed_text_has_a_small_lead():
    counts = []
    rng = random.Random(3)
    for lang in ("aa", "bb", "cc"):
        counts.append(sum(langid.ngram_counts(sample(lang, rng)) for _ in range(40)))
    model = langid.fitted(["aa", "bb", "cc"], np.array(counts))
    pure = langid.predicted(model, sample("aa", rng, 80))
    mixed = langid.predicted(model, sample("aa", rng, 40) + " " + sample("bb", rng, 40))
    assert pure[0] == "aa" and pure[2] > 0.99 > mixed[2] + 0.15


def test_odd_rows_and_no_teacher(spark, docs, folder):
    rows = ODD + [(50, "12 345 --"), (51, None, None)]
    got = queries.op10_language(spark, folder(documents=docs(rows))).collect()
    assert len(got) == len(rows)
    for r, text in [(r, dict((k, t) for k, t, *_ in rows)[r["doc_id"]]) for r in got]:
        none = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == none and (r["score"] == 0) == none
    nobody = [(i, "some text", None) for i in range(3)]
    assert {r["lang_pred"] for r in queries.op10_language(spark, folder(documents=docs(nobody))).collect()} == {"und"}
    assert queries.op10_language(spark, folder(documents=docs([]))).count() == 0


def test_numerals_are_no_letters(spark, docs, folder):
    rng = random.Random(4)
    rows = [(i, sample("aa", rng), "aa") for i in range(40)] + [(100, "½ ② Ⅷ", None), (101, "٣٤ ¼²", None), (102, "½ a", None), (103, "一二 字", None)]
    got = {r["doc_id"]: r for r in queries.op10_language(spark, folder(documents=docs(rows))).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103)] == ["und", "und", "aa", "aa"]
    assert got[100]["score"] == got[101]["score"] == 0


def test_ambiguity_is_flagged(spark, docs, folder):
    rng = random.Random(5)
    rows = [(i, sample(lang, rng), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(1000 + i, sample("aa", rng, 40) + " " + sample("bb", rng, 40), None) for i in range(40)]
    got = {r["doc_id"]: r for r in queries.op10_language(spark, folder(documents=docs(rows))).collect()}
    assert all(r["ambiguous"] == (r["lead"] < langid.LEAST_LEAD) and 0 <= r["lead"] <= r["score"] for r in got.values())
    assert not any(got[i]["ambiguous"] for i, *_ in rows[:180]) and any(got[i]["ambiguous"] for i in range(1000, 1040))

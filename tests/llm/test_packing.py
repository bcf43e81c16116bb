import zlib

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stagetally.llm import packing, queries

from .conftest import ODD


@pytest.fixture(scope="module")
def exact():
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_both_encoders_agree(text):
    if not hasattr(test_both_encoders_agree, "kept"):
        tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
        tokenizer.encode_special_tokens = True
        test_both_encoders_agree.kept = (packing.public_encoder(), tokenizer)
    encode, tokenizer = test_both_encoders_agree.kept
    assert list(encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


@given(
    st.lists(st.integers(1, 40), max_size=60),
    st.sampled_from([(40, 40, 1600), (40, 3, 1600), (40, 40, 1700), (64, 5, 1800)]),
    st.sampled_from(["norm", "dot"]),
)
@settings(max_examples=200, deadline=None)
def test_every_constraint_holds(lengths, capacity, rule):
    bins, offsets = packing.best_fit(np.array(lengths, np.int64), capacity, rule=rule)
    for b in set(bins.tolist()):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]]
        assert ends[-1] <= capacity[0] and len(own) <= capacity[1] and sum(n * n for _, n in own) <= capacity[2]
    assert set(bins.tolist()) == set(range(len(set(bins.tolist()))))


def test_oversized_items_are_refused():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([10]), (9, 5, 1000))


def test_packing_is_close_to_the_least():
    lengths = np.random.default_rng(2).integers(1, 2049, 4000)
    bins, _ = packing.best_fit(lengths, (2048, 2048, 2048**2))
    assert bins.max() + 1 <= -(-lengths.sum() // 2048) * 1.01 + 1


def test_query_gives_back_every_id(spark, docs, folder, exact):
    rows = ODD + [(20 + i, "word " * (i * 37)) for i in range(60)] + [(90, "<|endoftext|> x"), (91, "a\u0085b \x1c c")]
    got = queries.op4_packing(spark, folder(documents=docs(rows))).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r)
    assert set(found) == {k for k, _ in rows}
    for key, text in rows:
        if key == 4:
            assert sorted(r["length"] for r in found[4]) == [2, 2]
            continue
        ids = np.array([*exact(text), 0], "<u4")
        at = 0
        for i, r in enumerate(sorted(found[key], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["length"] == 2048 or i == 0
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_empty_table(spark, docs, folder):
    assert queries.op4_packing(spark, folder(documents=docs([]))).count() == 0

"""Containment joins against comparing all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from stagetally.operators.containment import GRAM, contained_in
from stagetally.operators.exports import resolve_owner_names
from stagetally.session import literal_table


def texts(spark, values, name):
    return literal_table(spark, [(v,) for v in sorted(set(values))], f"{name} string")


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    word = lambda most: "".join(rng.choice("abcå ") for _ in range(rng.randrange(most)))
    small, big = {word(7) for _ in range(120)} | {""}, {word(14) for _ in range(90)} | {"", "abc"}
    want = sorted((s, b) for s in small for b in big if s in b)
    for gram in (1, 3, 5):
        found = contained_in(texts(spark, small, "small"), texts(spark, big, "big"), gram)
        assert sorted(map(tuple, found.collect())) == want
    assert contained_in(texts(spark, [], "small"), texts(spark, big, "big")).count() == 0
    assert contained_in(texts(spark, small, "small"), texts(spark, [], "big")).count() == 0


def slow_ids(keys, names):
    out = []
    for key in keys:
        k = None if key is None else key.lower().strip()
        hits = [(r, i) for n, i, r in names if n is not None and k is not None and n == k]
        hits = hits or [(r, i) for n, i, r in names if n is not None and k is not None and (k in n or n in k)]
        out.append(min(hits)[1] if hits else key)
    return out


def test_owner_names_against_all_pairs(spark):
    rng = random.Random(5)
    parts = ["anna", "bo", "berg", "o", "van der", "lind", "x"]
    name = lambda: " ".join(rng.sample(parts, rng.randrange(1, 4)))
    names = [(name(), str(i), i % 17) for i in range(40)] + [("bo", "last", 99), ("", "blank", 50), (None, "none", 0)]
    keys = [name().title() for _ in range(60)] + ["", "  ", None, "unknown person", "AN", "é"]
    lookup = literal_table(spark, names, "name string, owner_id string, rank bigint")
    rows = literal_table(spark, list(enumerate(keys)), "i bigint, owner_id string")
    found = {r["i"]: r["owner_id"] for r in resolve_owner_names(rows, "owner_id", lookup).collect()}
    assert [found[i] for i in range(len(keys))] == slow_ids(keys, names)


def test_rows_made_grow_with_the_length_of_names(spark):
    """Rows of the generators for names of 200 and of 800 characters that are in each other or not."""
    rng = random.Random(6)

    def made(length):
        values = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length)) for _ in range(20)]
        big = texts(spark, values, "big")
        pieces = big.select(F.explode(F.sequence(F.lit(1), F.length("big") - GRAM + 1))).count()
        found = contained_in(texts(spark, [v[5:60] for v in values], "small"), big)
        assert found.count() == 20
        return pieces

    assert made(800) < 4.2 * made(200)

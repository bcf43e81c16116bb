"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batches

HITS = "__benchmark_hits"
_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    return _WORDS.findall((text or "").lower())


class _WordHashes(dict):
    """XXH64 of words, kept for the words of one batch."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def run_hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """One 64-bit hash for every run of ``shingle`` word hashes; none if there are fewer words."""
    n = len(words) - shingle + 1
    if n < 1:
        return words[:0]
    mixed = np.zeros(n, np.uint64)
    for i in range(shingle):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def multipliers(permutations: int) -> np.ndarray:
    """Odd factors; each orders hashes in its own way."""
    return np.random.default_rng(20).integers(1, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Index:
    """The items of one block: shingle sets, and for each size class the MinHash values of its items.

    An item of n shingles belongs to the class of the least power of two not
    below n.  Two neighbouring pieces of that many shingles make one window of
    a document, so an item lies whole in some window, and an item that is at
    least half as large as its class keeps enough similarity with the window
    for one of the values to agree: with 32 values it is missed once in about
    ten thousand times if it is whole, once in a thousand at a containment of 0.8.
    """

    def __init__(self, items: list[tuple[int, str]], shingle: int, permutations: int):
        self.shingle, self.factors = shingle, multipliers(permutations)
        self.ids, self.sets = [], []
        # Items of fewer words than a shingle: by length, hash of the whole and words.
        self.short: dict[int, dict[int, list[tuple[int, str]]]] = {}
        values: dict[int, list[tuple[np.ndarray, int]]] = {}
        hashes = _WordHashes()
        for item_id, text in items:
            words = words_of(text)
            runs = run_hashes(np.array([hashes[w] for w in words], np.uint64), shingle)
            if words and not len(runs):
                whole = int(run_hashes(np.array([hashes[w] for w in words], np.uint64), len(words))[0])
                self.short.setdefault(len(words), {}).setdefault(whole, []).append((item_id, " ".join(words)))
            if len(runs):
                size = 1 << max(0, len(runs) - 1).bit_length()
                values.setdefault(size, []).append(((runs[None, :] * self.factors[:, None]).min(1), len(self.ids)))
                self.ids.append(item_id)
                self.sets.append(frozenset(runs_of(words, shingle)))
        self.classes = {}
        for size, found in sorted(values.items()):
            signatures = np.stack([v for v, _ in found])
            items_of = np.array([i for _, i in found])
            order = np.argsort(signatures, axis=0, kind="stable")
            self.classes[size] = (np.take_along_axis(signatures, order, 0), items_of[order])

    def candidates(self, runs: np.ndarray, lengths: np.ndarray) -> set[tuple[int, int]]:
        """``(document, item)`` pairs that agree in a value; documents lie one behind the other in ``runs``."""
        found: set[tuple[int, int]] = set()
        full = lengths > 0
        docs, sizes = np.flatnonzero(full), lengths[full]
        offsets = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
        if not len(docs):
            return found
        scaled = np.empty_like(runs)
        plans = {}
        for size in self.classes:
            pieces = -(-sizes // size)
            of = np.repeat(np.arange(len(docs)), pieces)
            place = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            plans[size] = (offsets[of] + place * size, of)
        for p, factor in enumerate(self.factors):
            np.multiply(runs, factor, out=scaled)
            for size, (starts, of) in plans.items():
                low = np.minimum.reduceat(scaled, starts)
                joined = np.minimum(low[:-1], low[1:])
                low[:-1] = np.where(of[:-1] == of[1:], joined, low[:-1])
                values, items = (a[:, p] for a in self.classes[size])
                at = np.searchsorted(values, low)
                for w in np.flatnonzero(values[np.minimum(at, len(values) - 1)] == low):
                    for i in items[at[w] : np.searchsorted(values, low[w], "right")]:
                        found.add((int(docs[of[w]]), int(i)))
        return found


    def short_items(self, words: list[str], hashed: np.ndarray) -> list[int]:
        """Items of fewer words than a shingle that the words hold as a run, looked up by the runs of their length."""
        out = []
        for length, own in self.short.items():
            runs = run_hashes(hashed, length)
            for value in set(runs.tolist()) & own.keys():
                held = {" ".join(words[i : i + length]) for i in np.flatnonzero(runs == np.uint64(value)).tolist()}
                out += [item_id for item_id, text in own[value] if text in held]
        return out


def runs_of(words: list[str], shingle: int) -> Iterator[str]:
    return (" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1))


def with_hits(
    docs: DataFrame,
    text: str,
    items: DataFrame,
    item_key: str,
    item_text: str,
    threshold: float = 0.8,
    shingle: int = 5,
    permutations: int = 32,
    block_items: int = 20_000,
    block_chars: int = 32_000_000,
) -> DataFrame:
    """``docs`` with a column ``__benchmark_hits``: ``array<struct<item_id, containment>>``, sorted by item.

    A hit is an item of whose distinct word shingles at least ``threshold``
    occur in the document.  An item of fewer words than a shingle has its whole
    word sequence as its only one, and hits where that occurs as it is.  Items
    without words hit nothing, null texts and null item keys neither; repeated
    items count once.  Rows, columns and order of ``docs`` stay.

    Items go to the executors in blocks of bounded size, each with a pass of
    its own over the documents; no row of ``docs`` is shuffled.
    """
    spark = docs.sparkSession
    known = items.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).cast("string").alias("t"))
    known = known.where("i IS NOT NULL AND t IS NOT NULL").distinct()
    n, chars = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / block_items), math.ceil(chars / block_chars))
    schema = "item_id long, containment double"
    out = docs.withColumn(HITS, F.array().cast(f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>"))
    for b in range(blocks):
        block = known.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        out = _searched(out, text, spark.sparkContext.broadcast([tuple(r) for r in block]), threshold, shingle, permutations)
    return out


def _searched(docs: DataFrame, text: str, items, threshold: float, shingle: int, permutations: int) -> DataFrame:
    at, hits_at = docs.columns.index(text), docs.columns.index(HITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items.value, shingle, permutations)
        for batch in batches:
            hashes = _WordHashes()
            words = [words_of(t.as_py()) for t in batch.column(at)]
            hashed = [np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w)) for w in words]
            runs = [run_hashes(h, shingle) for h in hashed]
            lengths = np.array([len(r) for r in runs], np.int64)
            pairs: dict[int, list[int]] = {}
            if runs and index.ids:
                for doc, item in index.candidates(np.concatenate(runs), lengths):
                    pairs.setdefault(doc, []).append(item)
            hits = batch.column(hits_at).to_pylist()
            for doc, found in pairs.items():
                own = set(runs_of(words[doc], shingle))
                for item in found:
                    share = len(index.sets[item] & own) / len(index.sets[item])
                    if share >= threshold:
                        hits[doc] = hits[doc] + [{"item_id": index.ids[item], "containment": share}]
            for doc, own in enumerate(words if index.short else ()):
                hits[doc] = hits[doc] + [{"item_id": i, "containment": 1.0} for i in index.short_items(own, hashed[doc])]
            columns = list(batch.columns)
            columns[hits_at] = pa.array(
                [sorted(h, key=lambda x: (x["item_id"], x["containment"])) for h in hits], batch.schema.field(hits_at).type
            )
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return by_batches(docs, work, docs.schema)

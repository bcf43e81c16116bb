"""Language identification by error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_batches

UNKNOWN = "und"
BUCKETS = 1 << 14
#: A text whose lead is smaller is between languages.
LEAST_LEAD = 0.2


_OTHER = re.compile(r"[\W\d_]+")


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed byte pairs and triples of the letters, words parted by one space; None without letters."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not letters.replace(" ", "").isalpha():  # numerals like ½ and Ⅷ count as word characters to the pattern
        letters = " ".join("".join(c if c.isalpha() else " " for c in letters).split())
    if not letters:
        return None
    b = np.frombuffer(f" {letters} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    pairs = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
    triples = pairs[:-1] + b[2:] * np.uint32(0xC2B2AE35)
    hashed = np.concatenate([pairs * np.uint32(0x27D4EB2F) >> np.uint32(18), triples * np.uint32(0x165667B1) >> np.uint32(18)])
    return np.bincount(hashed, minlength=BUCKETS)


def codewords(classes: int, columns: int = 64, seed: int = 7) -> np.ndarray:
    """A code of +1 and -1, one row per class.

    Up to seven classes get every split of the classes in two, once each;
    more get ``columns`` random splits, of which all are proper and all rows differ.
    """
    if classes <= 7:
        splits = np.arange(1, 1 << max(0, classes - 1))
        bits = (splits[None, :] >> np.arange(classes)[:, None]) & 1
        return (bits * 2 - 1).astype(np.float64)
    rng = np.random.default_rng(seed)
    while True:
        code = rng.integers(0, 2, (classes, columns)) * 2.0 - 1
        code = code[:, np.abs(code.sum(0)) < classes]
        if len(np.unique(code, axis=0)) == classes:
            return code


class Model(NamedTuple):
    """Languages, their code, and for each of its bits a binary n-gram classifier and its weight in decoding."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def fitted(languages: list[str], counts: np.ndarray, smoothing: float = 0.5) -> Model:
    """A bit's classifier weighs each n-gram by the log of its share on one side over that on the other.

    Weights are scaled so that the mean over a text is about one for a language of its side.
    """
    code = codewords(len(languages))
    shares = counts + smoothing
    shares = shares / shares.sum(1, keepdims=True)
    weights, trust = np.zeros((BUCKETS, code.shape[1])), np.ones(code.shape[1])
    for j, bits in enumerate(code.T):
        yes, no = shares[bits > 0].mean(0), shares[bits < 0].mean(0)
        weights[:, j] = np.log(yes / no)
        trust[j] = max(1e-9, ((yes - no) * weights[:, j]).sum() / 2)
    return Model(languages, code, weights / trust, trust / max(trust.sum(), 1e-9))


def predicted(model: tuple, text: str | None, sharpness: float = 12.0) -> tuple[str, float, float]:
    """Language, its share of the decoding weight, and its lead over the next.

    A codeword's loss is the mean of ``log(1 + exp(-2 * bit * margin))`` over
    its bits, weighted by how far apart each bit's sides lie; the least loss
    wins, ties go to the language that sorts first.
    """
    languages, code, weights, trust = model
    counts = ngram_counts(text)
    if counts is None or not languages:
        return UNKNOWN, 0.0, 0.0
    margins = counts @ weights / counts.sum()
    losses = np.logaddexp(0, -2 * code * margins) @ trust
    chances = np.exp(-sharpness * (losses - losses.min()))
    chances /= chances.sum()
    best = int(np.argmin(losses))
    second = np.sort(chances)[-2] if len(chances) > 1 else 0.0
    return languages[best], float(chances[best]), float(chances[best] - second)


def train(docs: DataFrame, text: str, language: str) -> Model:
    """Count the n-grams of every row with a language; only those counts reach the driver.

    They are bounded by the number of languages times the buckets.  Rows with
    a null language or without letters teach nothing; an empty table gives a
    model that knows no language.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text_ in zip(batch.column(1).to_pylist(), batch.column(0)):
                counts = ngram_counts(text_.as_py())
                if counts is not None:
                    seen[label] = seen.get(label, 0) + counts
        for label, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "bucket", "n"],
            )

    rows = docs.where(F.col(language).isNotNull()).select(F.col(text).cast("string"), F.col(language).cast("string"))
    sums = by_batches(rows, work, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    languages = sorted(found["lang"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS))
    for i, name in enumerate(languages):
        own = found[found["lang"] == name]
        counts[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    return fitted(languages, counts)


def identified(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """``docs`` with ``__lang``, ``__score`` and ``__lead`` for every row; see :func:`predicted`.

    ``und`` with score 0 is the language of texts that are null or have no letter.
    """
    at, shared = docs.columns.index(text), docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predicted(shared.value, t.as_py()) for t in batch.column(at)]
            langs, scores, leads = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(leads, pa.float64())],
                [*batch.schema.names, "__lang", "__score", "__lead"],
            )

    added = T.StructType.fromDDL("__lang string, __score double, __lead double")
    return by_batches(docs, work, T.StructType([*docs.schema.fields, *added.fields]))


def held_out(key: Column) -> Column:
    """Whether a document is kept for the test: the CRC-32 of its number as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))

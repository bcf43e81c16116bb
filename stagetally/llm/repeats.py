"""Substring dedup: text units that occur earlier in the corpus are removed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batches, written

#: Where a unit ends: at line ends, at blank lines, or at line ends and after sentences.
ENDS = {"paragraph": r"\n[^\S\n]*(?:\n\s*)+", "line": r"\n", "sentence": r"\n|(?<=\w[.!?…])\s+"}


def units_of(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of the units in code points, white space around them left out."""
    at = 0
    for gap in re.finditer(ENDS[unit], text):
        yield at, gap.start()
        at = gap.end()
    yield at, len(text)


def normalised(unit: str) -> str:
    """Lower case, one space between words."""
    return " ".join(unit.lower().split())


def units_by_level(docs: DataFrame, rank: str, text: str, levels: dict[str, int]) -> DataFrame:
    """``(level, rank, uid, start, end, d1, d2)``: the units of every level that have its least number of words, with 128-bit digests.

    ``uid`` tells rows of one rank apart; it is the same whenever the stored
    table is read in the same way.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, at, starts, ends, digests = [], [], [], [], []
            for i, t in enumerate(t or "" for t in batch.column(2).to_pylist()):
                for level, min_words in levels.items():
                    for start, end in units_of(t, level):
                        words = t[start:end].lower().split()
                        if len(words) >= min_words:
                            of.append(level)
                            at.append(i)
                            starts.append(start)
                            ends.append(end)
                            digests.append(blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(of, pa.string()),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                ["level", "rank", "uid", "start", "end", "d1", "d2"],
            )

    rows = docs.select(
        F.col(rank).cast("long").alias("rank"), F.monotonically_increasing_id().alias("uid"), F.col(text).cast("string")
    )
    return by_batches(rows, work, "level string, rank long, uid long, start int, end int, d1 long, d2 long")


def units(docs: DataFrame, rank: str, text: str, unit: str, min_words: int) -> DataFrame:
    """``(rank, uid, start, end, d1, d2)``: every unit of at least ``min_words`` words with its 128-bit digest."""
    return units_by_level(docs, rank, text, {unit: min_words}).drop("level")


def repeated_units(docs: DataFrame, rank: str, text: str, unit: str = "sentence", min_words: int = 8) -> DataFrame:
    """``(rank, uid, start, end, first_rank, first_uid, first_start)``: the units to remove.

    Of the units with one normal form (lower case, single spaces) the first by
    rank, row and place stays; a null rank comes first.  All others are
    returned with their place and the place of the one that stays.  Null and
    empty texts have no unit.  ``docs`` should be a stored table.

    Digests are grouped with a map-side aggregate, and only those that occur
    more than once are joined back, so a unit that many documents hold is
    split over tasks by the join and never gathered.
    """
    found = written(units(docs, rank, text, unit, min_words), "units")
    first = (
        found.groupBy("d1", "d2")
        .agg(F.min(F.struct("rank", "uid", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return (
        found.join(first.drop("n"), ["d1", "d2"])
        .where(~F.struct("rank", "uid", "start").eqNullSafe(F.col("first")))
        .select(
            "rank",
            "uid",
            "start",
            "end",
            F.col("first.rank").alias("first_rank"),
            F.col("first.uid").alias("first_uid"),
            F.col("first.start").alias("first_start"),
        )
    )


def without(text: str | None, removed: list[tuple[int, int]]) -> tuple[str | None, list[tuple[int, int]]]:
    """The text without the removed places, and the places of the original that are left."""
    kept, at = [], 0
    for start, end in sorted(removed):
        if start > at:
            kept.append((at, start))
        at = max(at, end)
    if text is not None and at < len(text):
        kept.append((at, len(text)))
    return (None if text is None else "".join(text[a:b] for a, b in kept)), kept


def deduplicated(docs: DataFrame, rank: str, text: str, unit: str = "sentence", min_words: int = 8) -> DataFrame:
    """``(rank, uid, text, kept)`` for every row: its text without repeats, and the original places that are left.

    ``kept`` is an array of ``struct<start, end>`` in code points of the
    original.  A null text stays null.
    """
    return _cut(docs, rank, text, repeated_units(docs, rank, text, unit, min_words))


def without_passages(docs: DataFrame, rank: str, text: str, levels: dict[str, int] | None = None) -> DataFrame:
    """The same for the places of :func:`repeated_passages`: paragraphs, lines and sentences together."""
    return _cut(docs, rank, text, repeated_passages(docs, rank, text, levels))


def _cut(docs: DataFrame, rank: str, text: str, places: DataFrame) -> DataFrame:
    cuts = places.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    rows = docs.select(
        F.col(rank).cast("long").alias("rank"), F.monotonically_increasing_id().alias("uid"), F.col(text).cast("string").alias("text")
    ).join(cuts, "uid", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            pairs = [
                without(t, [(c["start"], c["end"]) for c in cut or ()])
                for t, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            kept = [[{"start": a, "end": b} for a, b in k] for _, k in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in pairs], pa.string()), pa.array(kept, spans)],
                ["rank", "uid", "text", "kept"],
            )

    return by_batches(
        rows.select("rank", "uid", "text", "cuts"),
        work,
        "rank long, uid long, text string, kept array<struct<start:int,end:int>>",
    )


def repeated_passages(docs: DataFrame, rank: str, text: str, levels: dict[str, int] | None = None) -> DataFrame:
    """``(rank, uid, start, end, first_rank, first_uid, first_start)``: the places to remove if paragraphs, lines and sentences are deduplicated together.

    Units are compared within their level, as in :func:`repeated_units`, and
    the places found are merged where they overlap; a merged place names the
    first copy of the longest unit that begins it.  ``levels`` gives the least
    number of words of each; by default lines and paragraphs of any length
    count, and sentences of eight words or more, which find passages that begin
    within a line.
    """
    found = written(units_by_level(docs, rank, text, levels or {"paragraph": 1, "line": 1, "sentence": 8}), "units")
    first = (
        found.groupBy("level", "d1", "d2")
        .agg(F.min(F.struct("rank", "uid", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    cuts = (
        found.join(first.drop("n"), ["level", "d1", "d2"])
        .where(~F.struct("rank", "uid", "start").eqNullSafe(F.col("first")))
        .groupBy("rank", "uid")
        .agg(F.collect_set(F.struct("start", "end", "first")).alias("cuts"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, places in enumerate(batch.column(2).to_pylist()):
                firsts: dict[int, tuple] = {}
                for c in sorted(places, key=lambda c: (c["start"], -c["end"], c["first"]["uid"], c["first"]["start"])):
                    firsts.setdefault(c["start"], (c["first"]["rank"], c["first"]["uid"], c["first"]["start"]))
                for start, end in merged((c["start"], c["end"]) for c in places):
                    at.append(i)
                    out.append((start, end, *firsts[start]))
            rows = pa.array(at, pa.int32())
            columns = zip(*out) if out else ([],) * 5
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["rank", "uid", "start", "end", "first_rank", "first_uid", "first_start"],
            )

    return by_batches(cuts, work, "rank long, uid long, start int, end int, first_rank long, first_uid long, first_start int")


def merged(places: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The places in order, those that overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(places):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out

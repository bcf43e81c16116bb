"""Packing by lexical retrieval: a window is filled with the seed's nearest unused neighbours by BM25."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batches, per_process, written
from .packing import public_encoder

#: One unit of an impact; impacts are whole numbers, so that their sums don't depend on the order of addition.
_UNIT = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _route(ids: np.ndarray) -> tuple[int, int]:
    """Two MinHash values of the distinct ids: equal ones with the share of ids in common."""
    out = []
    for draw in (1, 2):
        mixed = (ids.astype(np.uint64) + np.uint64(draw << 32)) * _MIX
        mixed = (mixed ^ mixed >> np.uint64(29)) * _MIX
        out.append(int((mixed >> np.uint64(2)).min()))
    return out[0], out[1]


def windows_and_tails(docs: DataFrame, key: str, text: str, tokens: int, end_id: int = 0, encoder=public_encoder) -> DataFrame:
    """Every document's ids: whole windows, and one shorter tail that is still to be placed.

    ``(key, start, length, ids_crc32, doc_tokens, sequence_id, ids, r1, r2)``;
    a window has a sequence of its own and no ids, a tail has ids (little-endian
    32 bits) and no sequence yet.  ``r1`` and ``r2`` route tails with ids in
    common towards each other.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(f"encoder {encoder.__module__}.{encoder.__name__}", encoder)
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for key_, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text_.as_py() or ""), end_id], "<u4")
                whole = len(ids) // tokens * tokens
                for at in range(0, whole, tokens):
                    crc = zlib.crc32(ids[at : at + tokens].tobytes())
                    rows.append((key_, at, tokens, crc, len(ids), sequence * 2, None, None, None))
                    sequence += 1
                if whole < len(ids):
                    tail = ids[whole:]
                    rows.append((key_, whole, len(tail), None, len(ids), None, tail.tobytes(), *_route(tail)))
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r)) for r in rows], _SCHEMA)

    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return by_batches(rows, work, "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ids binary, r1 long, r2 long")


_SCHEMA = pa.schema(
    [(c, pa.binary() if c == "ids" else pa.int64()) for c in ("key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids", "r1", "r2")]
)


class Index:
    """Inverted BM25 index of one shard: for every term the documents that hold it, with their impacts.

    A term in more than half of the shard's documents has weight zero and no
    postings.
    """

    def __init__(self, texts: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        lengths = np.array([len(t) for t in texts], np.int64)
        pairs = [np.unique(t, return_counts=True) for t in texts]
        self.terms = [p[0] for p in pairs]
        term = np.concatenate(self.terms) if pairs else np.zeros(0, np.int64)
        tf = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(p[0]) for p in pairs])
        order = np.argsort(term, kind="stable")
        term, tf, doc = term[order], tf[order], doc[order]
        self.vocabulary, first, df = np.unique(term, return_index=True, return_counts=True)
        idf = np.maximum(0, np.log((len(texts) - df + 0.5) / (df + 0.5)))
        damp = k1 * (1 - b + b * lengths / max(1.0, lengths.mean() if len(lengths) else 1.0))
        impact = np.repeat(idf, df) * tf * (k1 + 1) / (tf + damp[doc])
        self.first, self.df = first, np.where(idf > 0, df, 0)
        self.doc, self.impact = doc, np.floor(impact * _UNIT)

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document for the distinct terms of document ``seed``."""
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        first, df = self.first[at], self.df[at]
        ends = np.cumsum(df)
        posting = np.repeat(first - (ends - df), df) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.doc[posting], self.impact[posting], minlength=len(self.terms))


def filled(texts: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(document, start, length)`` that hold every id of every text (none longer than ``window``) once.

    The first unused document is the seed.  Of the unused documents with a
    score above 0 that fit what is left of the window, the best-scoring goes in
    (ties: the first); when none does, the best-scoring of all unused ones is
    cut to fill the window, and the rest of it is the next seed.  Only the last
    window can stay short.
    """
    index = Index(texts)
    left = np.array([len(t) for t in texts], np.int64)
    start = np.zeros(len(texts), np.int64)
    out, seed = [], 0
    todo = -1
    while True:
        if todo >= 0 and left[todo]:
            now = todo
        else:
            while seed < len(texts) and not left[seed]:
                seed += 1
            if seed == len(texts):
                return out
            now = seed
        todo = -1
        own, room, score = [], window, None
        take, n = now, int(left[now])
        while True:
            own.append((take, int(start[take]), n))
            start[take] += n
            left[take] -= n
            room -= n
            if not room:
                break
            if score is None:
                score = index.scores(now)
            unused = left > 0
            if not unused.any():
                break
            fits = unused & (left <= room) & (score > 0)
            whole = fits.any()
            take = int(np.where(fits if whole else unused, score, -1).argmax())
            n = min(room, int(left[take]))
            if n < left[take]:
                todo = take
        out.append(own)


def _powers(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """The pieces of a short window in sequences whose lengths are powers of two, longest first."""
    rest = sum(n for _, _, n in pieces)
    if rest == window:
        return [pieces]
    out, queue = [], list(pieces)
    while rest:
        room = 1 << rest.bit_length() - 1
        rest -= room
        own = []
        while room:
            doc, start, n = queue[0]
            take = min(n, room)
            own.append((doc, start, take))
            queue[:1] = [(doc, start + take, n - take)] if take < n else []
            room -= take
        out.append(own)
    return out


def placed(tails: DataFrame, tokens: int, shard_rows: int) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all ids of ``tails``.

    Tails are sorted by route and dealt into shards of ``shard_rows`` neighbours
    in that order; a group of equal routes, of any size, fills several shards.
    Each shard has its own index.  A partition holds 4 to 64 shards.
    """
    count = tails.count()
    wide = int(tails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, math.ceil(count / (64 * shard_rows)), min(wide, math.ceil(count / (4 * shard_rows))))
    order = ["r1", "r2", "key", "start", "uid"]
    dealt = (
        tails.withColumn("uid", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("key", "start", "doc_tokens", "ids")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33

        def shard(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal sequence
            texts = [np.frombuffer(ids, "<u4").astype(np.int64) for _, _, _, ids in rows]
            out = []
            for window in filled(texts, tokens):
                for own in _powers(window, tokens):
                    offset = 0
                    for doc, at, n in own:
                        key, start, whole, ids = rows[doc]
                        crc = zlib.crc32(ids[4 * at : 4 * (at + n)])
                        out.append((key, start + at, n, crc, whole, sequence * 2 + 1, offset))
                        offset += n
                    sequence += 1
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= shard_rows:
                yield shard(held[:shard_rows])
                held = held[shard_rows:]
        if held:
            yield shard(held)

    schema = "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return by_batches(dealt, work, schema)


def packed_with_neighbours(docs: DataFrame, key: str, text: str, tokens: int = 1024, shard_rows: int = 1024) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``: every id of every document in one piece.

    A document's ids end with id 0; a null text is an empty one, so every row
    gives at least that id.  Documents of a window or more give whole windows;
    what remains of each is a document of the index.  Its distinct ids are its
    terms.  A seed and its best unused neighbours fill a window; only the last
    window of a shard can stay short, and is cut at powers of two, where no
    padding is due.  Sequence numbers are unique, not gapless.

    Null and repeated keys, repeated rows and ties are kept as they are (copies
    are each other's best neighbours); an empty table gives an empty result;
    other columns are ignored.
    """
    pieces = written(windows_and_tails(docs, key, text, tokens), "windows-and-tails")
    columns = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    whole = pieces.where("ids IS NULL").select(*columns, F.lit(0).cast("long").alias("offset"))
    tails = pieces.where("ids IS NOT NULL").select("key", "start", "doc_tokens", "ids", "r1", "r2")
    return whole.unionByName(placed(tails, tokens, shard_rows))

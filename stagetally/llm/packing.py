"""Packing token pieces into sequences by vector best fit."""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batches, per_process, stored

#: Characters on which all Unicode versions agree; texts of these take the faster of two equal encoders.
_PLAIN = r"[^\t\n\r\x20-\x7e -ɏ‐-‧‰-⁞€]"


def token_encoder(json_path: str, ranks_path: str, pattern: str):
    """Text to ids of the byte-level BPE in ``json_path``.

    ``ranks_path`` holds the same vocabulary as ranks.  Both encoders give the
    same ids; the second is faster, and is used where the characters leave no
    doubt about how the pattern splits the text.
    """
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    exact.encode_special_tokens = True
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    odd = re.compile(_PLAIN).search

    def encode(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids if odd(text) else fast.encode_ordinary(text)

    return encode


def public_encoder():
    import public_tokenizers as public

    return token_encoder(
        public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN
    )


def token_pieces(docs: DataFrame, key: str, text: str, tokens: int = 2048, end_id: int = 0, encoder=public_encoder) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)``: every document's ids, cut only if longer than ``tokens``.

    A null text counts as empty, so every row gives at least the end id.  Of a
    longer document only the first piece may be short.  Null and repeated keys
    are kept as they are.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(f"encoder {encoder.__module__}.{encoder.__name__}", encoder)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key_, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text_.as_py() or ""), end_id], "<u4")
                start, piece = 0, 0
                stop = len(ids) % tokens or min(len(ids), tokens)
                while start < len(ids):
                    row = (key_, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()))
                    for column, value in zip(out, row):
                        column.append(value)
                    start, stop, piece = stop, stop + tokens, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["key", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return by_batches(rows, work, "key long, piece int, start long, length long, ids_crc32 long")


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[int, int, int],
    weights: tuple[float, float, float] = (1.0, 0.05, 0.25),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length under (tokens, documents, attention cost) capacities.

    An item takes its length in tokens, one document, and its squared length in
    attention cost.  One bin is open at a time; it takes the longest item, then
    of all items that fit every residual the one with the largest weighted dot
    product of demand and residual (``rule="dot"``), or the one that leaves the
    smallest weighted residual norm (``"norm"``), until none fits.  Two items
    that fill the tokens exactly go before one that does not.  Equal lengths
    keep their order.  An item that no empty bin can hold is an error.
    """
    full = np.array(capacity, np.float64)
    if len(lengths) and (lengths.max() > capacity[0] or int(lengths.max()) ** 2 > capacity[2] or capacity[1] < 1):
        raise ValueError("an item is larger than an empty sequence")
    order = np.argsort(lengths, kind="stable")
    at = np.searchsorted(lengths[order], np.arange(capacity[0] + 2))
    left = np.diff(at)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    w = np.array(weights) / np.where(full > 0, full, 1) ** (2 if rule == "norm" else 1)
    number, rest = -1, len(lengths)
    while rest:
        number += 1
        room, docs, cost = capacity
        while rest:
            size = np.flatnonzero(left[: room + 1])
            if room == capacity[0]:
                picks = size[-1:]
            else:
                size = size[size * size <= cost] if docs else size[:0]
                if not len(size):
                    break
                picks = _fill(size, left, room, docs, cost)
                if not len(picks):
                    demand = np.stack([size, np.ones(len(size)), size.astype(np.float64) ** 2], 1)
                    now = np.array([room, docs, cost], np.float64)
                    score = (demand * now) @ (w / full) if rule == "dot" else -(((now - demand) ** 2) @ w)
                    picks = size[len(size) - 1 - np.argmax(score[::-1])][None]
            for n in picks.tolist():
                item = order[at[n] + left[n] - 1]
                bins[item], offsets[item] = number, capacity[0] - room
                left[n] -= 1
                rest -= 1
                room, docs, cost = room - n, docs - 1, cost - n * n
    return bins, offsets


def _fill(size: np.ndarray, left: np.ndarray, room: int, docs: int, cost: int) -> np.ndarray:
    """One length, or two, that fill the room exactly within the other residuals; else none."""
    if left[room] and room * room <= cost:
        return np.array([room])
    if docs < 2:
        return size[:0]
    large = size[2 * size >= room]
    small = room - large
    fits = (left[small] > (small == large)) & (small > 0) & (large**2 + small**2 <= cost)
    found = large[fits]
    return np.array([found[-1], room - found[-1]]) if len(found) else size[:0]


def packed(
    pieces: DataFrame,
    capacity: tuple[int, int, int],
    weights: tuple[float, float, float] = (1.0, 0.05, 0.25),
    rule: str = "norm",
    group_rows: int = 4096,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every row of ``pieces(key, piece, start, length, ...)`` is kept.

    Pieces are dealt evenly into groups of about ``group_rows``, each packed in
    one task; a group wastes at most its last sequence.  ``pieces`` should be
    stored.  An empty table gives an empty result.
    """
    groups = max(1, math.ceil(pieces.count() / group_rows))
    dealt = pieces.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))

    def work(group: pa.Table) -> pa.Table:
        bins, offsets = best_fit(group["length"].to_numpy(), capacity, weights, rule)
        first = group["group"][0].as_py() << 32
        return (
            group.drop_columns(["group"])
            .append_column("sequence_id", pa.array(bins + first))
            .append_column("offset", pa.array(offsets))
        )

    schema = "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("group").applyInArrow(work, schema)


def packed_documents(docs: DataFrame, key: str, text: str, tokens: int = 2048) -> DataFrame:
    """Tokenize and pack; with these capacities only the tokens bind."""
    pieces = stored(token_pieces(docs, key, text, tokens))
    return packed(pieces, (tokens, tokens, tokens * tokens))

"""SimHash fingerprints, and near duplicates found by multi-index hashing."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batches, connected, stored

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, words: int, seed: int, distinct: bool = False) -> np.ndarray:
    """XXH64 of every run of ``words`` words of the text with A-Z lower-cased.

    Words are what ASCII white space leaves between; they are joined by one
    space.  Fewer words than asked for give one run; no word gives none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.zeros(0, "<u8")
    words = min(words, len(found))
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = functools.partial(xxhash.xxh64_intdigest, seed=seed)
    runs = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
    hashes = np.array([digest(joined[s:e]) for s, e in runs], "<u8")
    return np.unique(hashes) if distinct else hashes


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 majority bits of the hashes as a signed long; zero without hashes."""
    if not len(hashes):
        return 0
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS_OF_BYTE for i in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def mixed(hashes: np.ndarray, block: int) -> np.ndarray:
    """Other hashes of the same things for each block; those of block 0 are the hashes as they are."""
    if not block:
        return hashes
    h = hashes ^ np.uint64(0x9E3779B97F4A7C15 * block & (1 << 64) - 1)
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def fingerprints(
    docs: DataFrame, key: str, text: str, words: int = 4, seed: int = 42, distinct: bool = False, blocks: int = 1
) -> DataFrame:
    """``(key, f0, f1, ...)``: a fingerprint of ``blocks`` times 64 bits for every row.

    A null or blank text has fingerprint zero.  Other columns are ignored; the
    key may be null or repeated, every row gives one row.
    """
    names = [f"f{i}" for i in range(blocks)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[int]] = [[] for _ in names]
            for text_ in batch.column(1):
                hashes = shingle_hashes(text_.as_py(), words, seed, distinct)
                for block, out in enumerate(found):
                    out.append(fingerprint(mixed(hashes, block)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(f, pa.int64()) for f in found)], ["key", *names]
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, work, ", ".join(["key long", *(f"{n} long" for n in names)]))


def segments(bits: int, count: int, radius: int) -> list[tuple[int, int, int]]:
    """``(first bit, width, ball radius)`` of each segment.

    If two fingerprints differ in at most ``radius`` bits, they differ in at
    most the ball radius within one of the segments.  A segment whose ball
    radius would be negative is not needed.
    """
    whole, rest = divmod(radius, count)
    plan, at = [], 0
    for i in range(count):
        width = bits // count + (i < bits % count)
        ball = whole if i <= rest else whole - 1
        if ball > 1:
            raise ValueError("take more segments: balls of radius 0 and 1 are enumerated")
        if ball >= 0:
            plan.append((at, width, ball))
        at += width
    return plan


def _segment(names: list[str], at: int, width: int) -> Column:
    """The segment's bits of the fingerprint as a long; it may reach over two columns."""
    word, shift = divmod(at, 64)
    low = F.shiftrightunsigned(F.col(names[word]), shift)
    if shift + width > 64:
        low = low.bitwiseOR(F.shiftleft(F.col(names[word + 1]), 64 - shift))
    return low.bitwiseAND(F.lit((1 << width) - 1))


def _keys(names: list[str], plan: list[tuple[int, int, int]], ball: bool) -> Column:
    """Segment numbers with segment values, or with all values of their balls."""
    keys = []
    for i, (at, width, radius) in enumerate(plan):
        value = _segment(names, at, width).bitwiseOR(F.lit(i << 40))
        keys += [value, *(value.bitwiseXOR(F.lit(1 << b)) for b in range(width) if ball and radius)]
    return F.explode(F.array(*keys)).alias("k")


def _distance(names: list[str]) -> Column:
    """Differing bits between the fingerprints ``f`` and ``g`` (the same names with a ``g`` before)."""
    total = F.lit(0)
    for n in names:
        total = total + F.bit_count(F.col(n).bitwiseXOR(F.col(f"g{n}")))
    return total


def _other(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"g{n}" for n in names})


def near_components(prints: DataFrame, names: list[str], radius: int, count: int) -> DataFrame:
    """``(key, *names, component)`` for every row of ``prints(key, *names)``.

    Rows link if their fingerprints differ in at most ``radius`` bits; the
    component is the smallest key that links reach, the row's own included.
    Null keys are only the name of a component that has no other.  ``prints``
    should be stored, as it is read twice.

    Equal fingerprints are one node, so copies add nothing.  First the nodes
    that share a segment value are tested against one of them only; that joins
    dense groups with links in proportion to their size.  Then the Hamming
    balls of each node are looked up in the table of segment values, and full
    distances are verified, between different components only: a link inside
    a component cannot change the result.
    """
    plan = segments(64 * len(names), count, radius)
    nodes = stored(
        prints.groupBy(*names).agg(F.min("key").alias("first")).withColumn("n", F.monotonically_increasing_id())
    )
    table = nodes.select("n", *names, _keys(names, plan, ball=False))
    centers = table.groupBy("k").agg(F.min("n").alias("m"), F.count(F.lit(1)).alias("size")).where("size > 1")
    stars = (
        table.join(centers.select("k", "m"), "k")
        .where("n <> m")
        .select("n", *names, "m")
        .distinct()
        .join(_other(nodes.select(F.col("n").alias("m"), *names), names), "m")
        .where(_distance(names) <= radius)
        .select(F.col("n").alias("a"), F.col("m").alias("b"))
    )
    roots = connected(stars)
    labelled = stored(
        nodes.join(roots.withColumnRenamed("node", "n"), "n", "left").withColumn("root", F.coalesce("root", "n"))
    )
    probes = labelled.select("n", "root", *names, _keys(names, plan, ball=True)).alias("p")
    entries = _other(labelled.select(F.col("root").alias("other"), F.col("n").alias("m"), *names, _keys(names, plan, ball=False)), names)
    links = (
        probes.join(
            entries.alias("e"),
            (F.col("p.k") == F.col("e.k"))
            & (F.col("n") < F.col("m"))
            & (_distance(names) <= radius)
            & (F.col("p.root") != F.col("other")),
        )
        .select(F.col("p.root").alias("a"), F.col("other").alias("b"))
        .distinct()
    )
    joined = connected(links)
    top = labelled.join(
        joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left"
    ).withColumn("top", F.coalesce("top", "root"))
    # Stored, so that the join below has a plain shuffle on both sides and can split a large component.
    first = stored(top.groupBy("top").agg(F.min("first").alias("component")))
    return prints.join(top.join(first, "top").select(*names, "component"), names).select("key", *names, "component")

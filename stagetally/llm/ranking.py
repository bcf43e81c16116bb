"""Ranked lexical search in which documents with one bag of query terms are scored once."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batches, stored, written
from .terms import term_lists, term_table

_TERMS = term_table(b"0123456789")
#: A term weighs at most this much per unit of its weight.
_TOP_SHARE = 1_000_000
#: Items that are scored together against a batch of classes.
_TOGETHER = 32


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(item, item_id, terms)``: the distinct terms of each row, in order; ``item`` numbers the rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for part in term_lists(x.as_py(), _TERMS) for t in part}) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))], ["item", "item_id", "terms"]
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(key).cast("long").alias("item_id"),
        F.col(text).cast("string").alias("text"),
    )
    return by_batches(rows, work, "item long, item_id long, terms array<binary>")


def bags(docs: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """``(key, n, bag)``: all terms of each row counted, and its bag of vocabulary terms.

    A bag is the bytes of a little-endian 32-bit array: the numbers of the
    terms in ascending order, then how often each occurs.
    """
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    width = max(1, len(vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, found, ends = [], [], [0]
            for text_ in batch.column(1):
                n, own = 0, []
                for part in term_lists(text_.as_py(), _TERMS):
                    n += len(part)
                    own += [i for i in map(number, part) if i is not None]
                sizes.append(n)
                found.append(np.array(own, np.int64) + len(found) * width)
                ends.append(ends[-1] + len(own))
            cells, tf = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
            at = np.searchsorted(cells, np.arange(len(found) + 1) * width)
            ids, tf = (cells % width).astype("<i4"), tf.astype("<i4")
            made = [ids[s:e].tobytes() + tf[s:e].tobytes() for s, e in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], ["key", "n", "bag"]
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, work, "key long, n long, bag binary")


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and occurrences of every entry of a column of bags."""
    parts = [np.frombuffer(b, "<i4").reshape(2, -1) for b in column.to_pylist()]
    row = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
    both = np.concatenate(parts, 1) if parts else np.zeros((2, 0), "<i4")
    return row, both[0], both[1].astype(np.int64)


def document_counts(bagged: DataFrame, terms: int) -> np.ndarray:
    """In how many rows of ``bagged(bag)`` each term occurs; a task adds up its rows before they are shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            held += np.bincount(_cells(batch.column(0))[1], minlength=terms)
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], ["term", "df"])

    total = by_batches(bagged.select("bag"), work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(terms, np.int64)
    for row in total.collect():
        df[row["term"]] = row["df"]
    return df


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def classes(bagged: DataFrame, documents: int, length: int, k: int) -> DataFrame:
    """``(m, bag, members)``: one row for all documents with one bag and one ``m``.

    Rows are dealt by a hash of both and compared in full.  ``members`` are the
    ``k`` smallest keys in order (null last): no other member can be among the
    ``k`` best, as all of a class have one score.  Tasks leave out what is
    beyond the ``k`` smallest of their own rows before the shuffle, so a class
    that holds most documents is small there.
    """
    m = F.expr(f"cast(10 + (cast({90 * documents} as decimal(28)) * n) div {max(length, 1)} as long)")
    rows = bagged.where(F.length("bag") > 0).select("key", "bag", m.alias("m"))
    rows = rows.withColumn("digest", F.xxhash64("m", "bag"))
    by = ["digest", "m", "bag"]
    first = Window.partitionBy(*by).orderBy(F.col("key").asc_nulls_last())
    least = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    members = F.array_sort(F.collect_list(F.struct("place", "key")))
    return least.groupBy(*by).agg(F.transform(members, lambda x: x["key"]).alias("members")).select("m", "bag", "members")


def best_in_tasks(grouped: DataFrame, weights: np.ndarray, items: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """``(item, score, key)``: of each task's classes the ``k`` best documents of every item.

    Items are scored in blocks: the classes' shares of the block's terms times
    a matrix that says which item holds which term.  Sums below 2**53 are exact
    in doubles; if larger ones can occur, the product is taken in integers.
    """
    spark = grouped.sparkSession
    largest = max((int(weights[t].sum()) for _, t in items), default=0) * _TOP_SHARE
    kind = np.float64 if largest < 1 << 53 else np.int64
    shared = spark.sparkContext.broadcast((weights, items))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        blocks = []
        for at in range(0, len(items), _TOGETHER):
            own = items[at : at + _TOGETHER]
            terms = np.unique(np.concatenate([t for _, t in own]))
            holds = np.zeros((len(terms), len(own)), kind)
            for i, (_, t) in enumerate(own):
                holds[np.searchsorted(terms, t), i] = 1
            place = np.full(len(weights), -1, np.int64)
            place[terms] = np.arange(len(terms))
            blocks.append((at, place, holds))
        score, key = np.zeros((len(items), 0), np.int64), np.zeros((len(items), 0), object)
        best = [(score[i], key[i]) for i in range(len(items))]
        for batch in batches:
            row, term, tf = _cells(batch.column(1))
            m = batch.column(0).to_numpy()
            share = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            members = None
            for at, place, holds in blocks:
                there = place[term]
                some = there >= 0
                matrix = np.zeros((len(m), len(holds)), kind)
                matrix[row[some], there[some]] = share[some]
                scores = (matrix @ holds).astype(np.int64)
                least = np.partition(scores, -k, 0)[-k] if len(m) > k else np.zeros(scores.shape[1], np.int64)
                for i in range(scores.shape[1]):
                    old_score, old_key = best[at + i]
                    bar = max(1, least[i], old_score[-1] if len(old_score) == k else 0)
                    found = np.flatnonzero(scores[:, i] >= bar)
                    if not len(found):
                        continue
                    members = members or batch.column(2).to_pylist()
                    new = [(-s, x is None, x or 0, x) for s, x in zip(old_score.tolist(), old_key.tolist())]
                    new += [(-s, x is None, x or 0, x) for f in found for s in [int(scores[f, i])] for x in members[f]]
                    new = sorted(new, key=lambda x: x[:3])[:k]
                    best[at + i] = np.array([-x[0] for x in new], np.int64), np.array([x[3] for x in new], object)
        out = [(items[i][0], s, x) for i, (ss, xs) in enumerate(best) for s, x in zip(ss.tolist(), xs.tolist())]
        columns = zip(*out) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "score", "key"])

    return by_batches(grouped, work, "item long, score long, key long")


def ranked(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, k: int = 10, block_bytes: int = 8 << 20
) -> DataFrame:
    """``(item_id, rank, key, score)``: the ``k`` highest-scoring documents of every item, those above 0 only.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z
    lower-cased.  With N documents that hold a term, L terms in all, n in one
    document, df documents that hold a term and tf occurrences, a term weighs
    ``w = floor(1000 ln((2N+2)/(2df+1)))``, a document has
    ``m = 10 + 90nN div L``, and scores the sum of ``w (10**9 tf div (1000tf + 8m))``
    over the item's distinct terms.  Equal scores go by ascending key, null
    keys last.

    Documents are cut down to the items' vocabulary; those with one bag and
    one ``m`` are one class, scored once.  Null and empty texts hold no term;
    an item without terms has no rows.  Repeated rows are documents of their
    own, repeated items are ranked each by itself; empty tables give an empty
    result.  Other columns are ignored.

    Items are taken in groups whose terms have about ``block_bytes`` bytes, so
    what is broadcast is bounded; one group is one pass over the documents.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items, item_key, item_text).where(F.size("terms") > 0))
    size = wanted.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.length(t) + 8))).first()[0]
    groups = max(1, math.ceil((size or 0) / block_bytes))
    found = []
    for group in range(groups if size else 0):
        own = wanted.where(F.pmod("item", F.lit(groups)) == group).collect()
        vocabulary = sorted({bytes(t) for r in own for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        bagged = written(bags(docs, key, text, vocabulary), "bags")
        documents, length = bagged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = term_weights(document_counts(bagged, len(vocabulary)), documents)
        numbered = [(r["item"], np.array([number[bytes(t)] for t in r["terms"]])) for r in own]
        best = best_in_tasks(classes(bagged, documents, length, k), weights, numbered, k)
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        found.append(best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k))
        if groups > 1:
            found[-1] = stored(found[-1])
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, key long, score long")
    return reduce(DataFrame.unionByName, found).join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "key", "score")

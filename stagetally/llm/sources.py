"""How far the sources of a language diverge: smoothed term frequencies compared by run-length columns."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batches, written
from .terms import term_lists, term_table

_TERMS = term_table()
_SCALE = 1_000_000_000
#: A task's counts are passed on when they hold this many different terms.
_HELD = 400_000


def _term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, count, df)``, added up over the documents of a task before they are shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(Counter)
        holders: dict = defaultdict(Counter)

        def out():
            for (lang, source), own in counts.items():
                df = holders[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array([source] * len(own), pa.string()),
                        pa.array(list(own), pa.binary()),
                        pa.array(list(own.values()), pa.int64()),
                        pa.array([df[t] for t in own], pa.int64()),
                    ],
                    ["lang", "source", "term", "count", "df"],
                )
            counts.clear()
            holders.clear()

        for batch in batches:
            for lang, source, text in zip(*(c for c in batch.columns)):
                group = lang.as_py(), source.as_py()
                distinct: set[bytes] = set()
                for part in term_lists(text.as_py(), _TERMS):
                    counts[group].update(part)
                    distinct.update(part)
                holders[group].update(distinct)
            if sum(map(len, counts.values())) > _HELD:
                yield from out()
        yield from out()

    return by_batches(docs.select("lang", "source", "text"), work, "lang string, source string, term binary, count long, df long")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10**9 (count + 5) / (total + 5 terms))``, exactly; any count and total of 64 bits will do."""
    wide = lambda c, digits: c.cast(f"decimal({digits})")
    top = wide(F.lit(_SCALE), 10) * wide(count + F.lit(5), 20)
    return F.lit(1).cast("long") + F.call_function("div", top, wide(total + F.lit(5) * terms, 20))


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """The same for arrays of 64-bit integers; three steps of long division keep every product within 64 bits."""
    bottom = totals + 5 * terms
    rest, done = counts + 5, np.zeros(np.broadcast_shapes(counts.shape, totals.shape), np.int64)
    for _ in range(3):
        rest = rest * 1000
        done, rest = done * 1000 + rest // bottom, rest % bottom
    return done + 1


def runs(column: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length code of a column in which every entry stands for ``weights`` equal ones: ends and values."""
    last = np.flatnonzero(np.append(column[1:] != column[:-1], True))
    return np.cumsum(weights)[last], column[last]


def divergences(counts: np.ndarray, weights: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """For all pairs of columns, the sum over all rows of the absolute difference of their shares.

    Row i of ``counts`` stands for ``weights[i]`` terms.  Rows are reordered so
    that equal counts lie together, each column is run-length coded once, and
    two columns are compared per stretch between the boundaries of either.
    """
    order = np.lexsort(counts.T[np.argsort([-len(np.unique(c)) for c in counts.T], kind="stable")])
    counts, weights = counts[order], weights[order]
    coded = []
    for column, total in zip(counts.T, totals):
        ends, values = runs(column, weights)
        coded.append((ends, shares(values, total, terms)))
    out = np.zeros((len(totals), len(totals)), np.int64)
    for a, (ends, p) in enumerate(coded):
        for b, (other, q) in enumerate(coded[:a]):
            cuts = np.union1d(ends, other)
            gap = np.abs(p[np.searchsorted(ends, cuts)] - q[np.searchsorted(other, cuts)])
            out[a, b] = out[b, a] = int(gap @ np.diff(cuts, prepend=0))
    return out


def _pair_values(vectors: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """``(lang, source, item, value)``: partial sums for all ordered pairs of sources of a language.

    ``vectors(lang, vector, terms_alike)`` are the different count vectors,
    dealt by their hash into so many blocks; the language's sources, their
    totals and V go with every block.
    """
    rows = vectors.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)))
    heads = groups.select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def work(rows: pa.Table, heads: pa.Table) -> pa.Table:
        names = sorted(heads["source"].to_pylist())
        column = {s: i for i, s in enumerate(names)}
        total = dict(zip(heads["source"].to_pylist(), heads["total"].to_pylist()))
        lists = rows["vector"].combine_chunks()
        counts = np.zeros((len(names), len(lists)), np.int64)
        flat = lists.flatten()
        number = np.array([column[s] for s in flat.field("source").to_pylist()], np.int64)
        counts[number, np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))] = flat.field("count").to_numpy()
        values = np.zeros((len(names),) * 2, np.int64)
        if len(lists):
            totals = np.array([total[s] for s in names], np.int64)
            values = divergences(counts.T, rows["terms_alike"].to_numpy(), totals, heads["terms"][0].as_py())
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        lang = heads["lang"][0].as_py() if len(heads) else ""
        return pa.table(
            {
                "lang": pa.array([lang] * len(a), pa.string()),
                "source": pa.array([names[i] for i in a], pa.string()),
                "item": pa.array([names[i] for i in b], pa.string()),
                "value": pa.array(values[a, b], pa.int64()),
            }
        )

    return (
        rows.groupBy("lang", "block")
        .cogroup(heads.groupBy("lang", "block"))
        .applyInArrow(work, "lang string, source string, item string, value long")
    )


def divergence(
    docs: DataFrame, lang: str, source: str, text: str, least_documents: int = 30, top: int = 50, cells: int = 100_000
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: the audit of every (lang, source) that occurs.

    Null lang, source and text count as ''.  Terms are runs of letters and
    characters beyond ASCII, A-Z lower-cased; a language keeps the V terms that
    at least ``least_documents`` of its documents hold.  With N occurrences of
    kept terms, a term with ``count`` of them has the share
    ``1 + floor(10**9 (count + 5) / (N + 5 V))``, in a group and in its language.

    Part ``pair``: every other source of the language with the sum of absolute
    differences of shares over all kept terms (0 if there are none).  Part
    ``term``: kept terms that occur in the group and have a larger share there
    than in the language, with the difference, the first ``top`` of them.  Rank
    is by value, largest first, then by the item's UTF-8 bytes.

    Groups without terms have pairs too; a language with one source has none.
    Repeated rows count again; an empty table gives an empty result; other
    columns are ignored.  Very long texts are counted in parts.

    Every distinct combination of counts over a language's sources is kept
    once, with how many terms have it, and blocks hold about ``cells`` counts.
    A group that is far larger than the others costs no more than they do.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    clean = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    counted = _term_counts(clean)
    per_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("df").alias("df"))
    kept = written(
        per_source.groupBy("lang", "term")
        .agg(
            F.sum("df").alias("df"),
            F.sum("count").alias("lang_count"),
            F.array_sort(F.collect_list(F.struct("source", "count"))).alias("vector"),
        )
        .where(F.col("df") >= least_documents)
        .select("lang", F.col("term").cast("string").alias("term"), "lang_count", "vector"),
        "kept-terms",
    )
    entries = kept.select("lang", "term", "lang_count", F.explode("vector").alias("e")).select("lang", "term", "lang_count", "e.*")
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    whole = kept.groupBy("lang").agg(F.sum("lang_count").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = written(
        clean.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(whole, "lang", "left")
        .select("lang", "source", zero("total"), zero("lang_total"), zero("terms")),
        "source-totals",
    )
    vectors = kept.groupBy("lang", "vector").agg(F.count(F.lit(1)).alias("terms_alike"))
    pairs = groups.select("lang", "source").join(
        groups.select("lang", F.col("source").alias("item")), "lang"
    ).where("source <> item")
    widest = groups.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    sums = _pair_values(vectors, groups, kept.count() * widest // cells + 1).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pair = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", zero("value")
    )
    over = entries.join(groups, ["lang", "source"])
    value = share(F.col("count"), F.col("total"), F.col("terms")) - share(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    term = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pair).unionByName(ranked(term).where(F.col("rank") <= top))

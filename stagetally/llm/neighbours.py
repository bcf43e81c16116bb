"""Nearest neighbours by inner product: a block matrix join over int8 tiles."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Products of int8 values summed over so many components stay exact in float32.
_EXACT = 1024


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors and norms of what decoding loses."""
    scale = np.maximum(np.abs(vectors).max(1) / 127, np.finfo(np.float64).tiny)
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(vectors - decoded, axis=1)


def tile_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of two int8 blocks, as doubles."""
    total = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _EXACT):
        total += a[:, i : i + _EXACT].astype(np.float32) @ b[:, i : i + _EXACT].astype(np.float32).T
    return total


def tile_nearest(query_ids, queries, ids, vectors, k: int) -> Iterator[tuple[int, int, float]]:
    """``(query id, id, score)`` of at least the k nearest of the tile to each query, exactly scored.

    Products of codes give every score up to a bound on the error of
    quantisation.  Pairs whose upper bound reaches the k-th largest lower
    bound of their query survive, are scored in doubles, and the k best stay
    (ties to smaller ids).  A query's own row is no candidate of it.
    """
    qc, qs, qn, qe = quantised(queries)
    vc, vs, vn, ve = quantised(vectors)
    near = tile_products(qc, vc) * qs[:, None] * vs[None, :]
    error = (qe[:, None] * (vn + ve)[None, :] + qn[:, None] * ve[None, :]) * (1 + 1e-9) + 1e-12 * qn[:, None] * vn[None, :]
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    low = near - error
    floor = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
    for row, (bound, limit) in enumerate(zip(near + error, floor)):
        alive = np.flatnonzero((bound >= limit) & (near[row] > -np.inf))
        scores = (vectors[alive] * queries[row]).sum(1)
        best = np.lexsort((ids[alive], -scores))[:k]
        for i in best:
            yield int(query_ids[row]), int(ids[alive[i]]), float(scores[i])


def usable(vector: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    table: DataFrame,
    key: str,
    vector: str,
    is_query: Callable[[Column], Column],
    k: int = 20,
    query_rows: int = 256,
    candidate_rows: int = 4096,
    fan_in: int = 32,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k largest inner products of every query row.

    ``is_query`` gives a condition on the key column.  Candidates are all rows but those
    of the query's own key.  Null keys, and vectors that are null, zero or hold
    a null or non-finite component take no part; nor do candidates of another
    dimension than the query.  Repeated rows are separate candidates of one id;
    a repeated query id counts once, with its smallest vector.  The result is exact.

    Rows are dealt evenly into query blocks and candidate blocks of bounded
    size.  Each tile of the block matrix is one group; the partial results of
    a query block are merged by heaps, ``fan_in`` at a time.
    """
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = stored(rows.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v")))
    asked = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    asked = stored(asked.withColumn("d", F.size("v")))
    n_queries, n_rows = (max(1, math.ceil(x.count() / n)) for x, n in ((asked, query_rows), (rows, candidate_rows)))
    deal = F.monotonically_increasing_id()
    left = asked.withColumn("qb", F.pmod(deal, F.lit(n_queries))).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    right = rows.withColumn("cb", F.pmod(deal, F.lit(n_rows))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    shape = [F.col("qb").cast("int"), F.col("cb").cast("int"), "id", "d", "v"]
    tiles = left.select(F.lit(True).alias("asks"), *shape).unionByName(right.select(F.lit(False).alias("asks"), *shape))
    tiles = tiles.select(F.struct("qb", "cb").alias("tile"), "asks", "id", "d", "v")

    def tile(group: pa.Table) -> pa.Table:
        at = group["tile"][0].as_py()
        asks, ids, dims = (group[c].to_numpy() for c in ("asks", "id", "d"))
        flat = group["v"].combine_chunks().flatten().to_numpy()
        ends = np.cumsum(dims)
        found = []
        for d in np.unique(dims[asks]):
            mine = np.flatnonzero(dims == d)
            block = np.stack([flat[e - d : e] for e in ends[mine]])
            q, c = asks[mine], ~asks[mine]
            if c.any():
                found += tile_nearest(ids[mine][q], block[q], ids[mine][c], block[c], k)
        return _rows(at["qb"], at["cb"], found)

    def merge(group: pa.Table) -> pa.Table:
        return _rows(group["qb"][0].as_py(), group["cb"][0].as_py(), _merged(group, k))

    schema = "qb int, cb int, query_id long, rank int, vec_id long, score double"
    found, blocks = tiles.groupBy("tile").applyInArrow(tile, schema), n_rows
    while blocks > 1:
        found = found.withColumn("cb", (F.col("cb") / fan_in).cast("int"))
        found, blocks = found.groupBy("qb", "cb").applyInArrow(merge, schema), math.ceil(blocks / fan_in)

    return found.select("query_id", "rank", "vec_id", "score")


def _rows(qb: int, cb: int, found: list[tuple[int, int, float]]) -> pa.Table:
    """Rows sorted by query, best first, as a table with ranks."""
    q, v, s = zip(*found) if found else ((), (), ())
    n, ranks = len(found), []
    for i in range(n):
        ranks.append(ranks[-1] + 1 if i and q[i] == q[i - 1] else 1)
    return pa.table(
        {
            "qb": pa.array([qb] * n, pa.int32()),
            "cb": pa.array([cb] * n, pa.int32()),
            "query_id": pa.array(q, pa.int64()),
            "rank": pa.array(ranks, pa.int32()),
            "vec_id": pa.array(v, pa.int64()),
            "score": pa.array(s, pa.float64()),
        }
    )


def _merged(group: pa.Table, k: int) -> list[tuple[int, int, float]]:
    """The k best rows of each query, kept in a heap while the rows stream by; best first."""
    heaps: dict[int, list[tuple[float, int]]] = {}
    for q, v, s in zip(*(group[c].to_pylist() for c in ("query_id", "vec_id", "score"))):
        heap = heaps.setdefault(q, [])
        if len(heap) < k:
            heapq.heappush(heap, (s, -v))
        else:
            heapq.heappushpop(heap, (s, -v))
    return [(q, -v, s) for q, heap in sorted(heaps.items()) for s, v in sorted(heap, reverse=True)]

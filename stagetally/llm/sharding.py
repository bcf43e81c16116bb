"""Resharding by minimum-cost flow: the fewest bytes move to meet new capacities."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stagetally.session import literal_table

from .common import stored


def least_moves(
    sizes: Sequence[int], capacities: Sequence[int], cost: Callable[[int, int], float] | None = None
) -> list[list[int]]:
    """Bytes from each old shard to each new one at the least total cost.

    Old and new shards of one number are the same place.  The default cost of
    a byte is 0 where it is and 1 elsewhere.  The capacities must hold all
    bytes.  Solved by successive cheapest augmenting paths over shards, so its
    work depends on the number of shards alone.
    """
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards are too small")
    cost = cost or (lambda i, j: float(i != j))
    n, m = len(sizes), len(capacities)
    prices = [[cost(i, j) for j in range(m)] for i in range(n)]
    flow = [[0] * m for _ in range(n)]
    supply, room = list(sizes), list(capacities)
    lift = [0.0] * (n + m)
    while any(supply):
        best, came = [math.inf] * (n + m), [-1] * (n + m)
        heap = [(0.0, i) for i in range(n) if supply[i]]
        for _, i in heap:
            best[i] = 0.0
        heapq.heapify(heap)
        while heap:
            d, x = heapq.heappop(heap)
            if d > best[x]:
                continue
            if x < n:
                steps = ((n + j, prices[x][j]) for j in range(m))
            else:
                steps = ((i, -prices[i][x - n]) for i in range(n) if flow[i][x - n])
            for y, price in steps:
                reduced = max(0.0, price + lift[x] - lift[y])
                if d + reduced < best[y]:
                    best[y], came[y] = d + reduced, x
                    heapq.heappush(heap, (best[y], y))
        ends = [j for j in range(m) if room[j] and best[n + j] < math.inf]
        end = min(ends, key=lambda j: best[n + j] + lift[n + j])
        far = max(b for b in best if b < math.inf)
        lift = [h + min(b, far) for h, b in zip(lift, best)]
        path, x = [], n + end
        while came[x] >= 0:
            path.append((came[x], x))
            x = came[x]
        amount = min([supply[x], room[end], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        supply[x] -= amount
        room[end] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    """Capacities that differ by one byte at most and hold exactly the total."""
    return [total * (i + 1) // shards - total * i // shards for i in range(shards)]


def resharded(
    rows: DataFrame, old: str, size: str, capacities: Callable[[int], Sequence[int]], block_rows: int = 2048
) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 within a shard).

    ``old`` is the number of the shard a row is in (from 0, not null), ``size``
    its bytes (not null); ``capacities`` gives the new shards' bytes for the
    total.  ``rows`` should be stored and must not use names that begin with
    two underscores.

    The rows of an old shard are dealt evenly into blocks.  Block totals give
    the sizes of the old shards, whose flow is solved on the driver; each old
    shard's run of bytes is then cut at the flows, its own share first.  A row
    goes where its middle byte lies.  Whole blocks are placed by their totals
    and only rows within a block are put in order, so no task holds a shard,
    and new shards differ from their capacities by less than one row for each
    of the transfers.  An empty table gives an empty result.
    """
    blocks = max(1, math.ceil(rows.count() / block_rows))
    dealt = rows.withColumn("__block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))
    dealt = dealt.withColumn("__row", F.monotonically_increasing_id())
    totals = stored(dealt.groupBy(F.col(old).alias("__old"), "__block").agg(F.sum(size).alias("__bytes")))
    held = {r[0]: r[1] for r in totals.groupBy("__old").agg(F.sum("__bytes")).collect()}
    sizes = [held.get(i, 0) for i in range(max(held, default=-1) + 1)]
    flow = least_moves(sizes, capacities(sum(sizes)))
    cuts = literal_table(
        rows.sparkSession,
        [(i, *cut) for i, to in enumerate(flow) for cut in _cuts(i, to)],
        "old bigint, shard int, cut_from bigint, cut_to bigint",
    )
    cuts = cuts.groupBy(F.col("old").alias("__old")).agg(
        F.sort_array(F.collect_list(F.struct("cut_from", "cut_to", "shard"))).alias("__cuts")
    )
    before = Window.partitionBy("__old").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__start", F.coalesce(F.sum("__bytes").over(before), F.lit(0))).join(cuts, "__old")
    block = Window.partitionBy(old, "__block")
    inner = block.orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("__start") + F.coalesce(F.sum(size).over(inner), F.lit(0)) + F.floor(F.col(size) / 2)
    placed = (
        dealt.join(starts.drop("__bytes"), (F.col(old) == F.col("__old")) & (dealt["__block"] == starts["__block"]))
        .drop(starts["__block"])
        .withColumn("__at", middle)
        .withColumn("shard", F.element_at(F.filter("__cuts", lambda c: c["cut_to"] > F.col("__at")), 1)["shard"])
        .withColumn("__rank", F.row_number().over(Window.partitionBy(old, "__block", "shard").orderBy("__row")) - 1)
        .drop("__start", "__cuts", "__at", "__old")
    )
    placed = stored(placed)
    counts = placed.groupBy("shard", F.col(old).alias("__old"), F.col("__block").alias("__of")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    earlier = Window.partitionBy("__in").orderBy("__old", "__of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumnRenamed("shard", "__in").withColumn(
        "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    )
    return (
        placed.join(
            offsets,
            (F.col("shard") == F.col("__in")) & (F.col(old) == F.col("__old")) & (F.col("__block") == F.col("__of")),
        )
        .withColumn("slot", F.col("__first") + F.col("__rank"))
        .drop("__block", "__row", "__rank", "__in", "__old", "__of", "__n", "__first")
    )


def _cuts(own: int, to: Sequence[int]) -> list[tuple[int, int, int]]:
    """``(shard, from, to)`` byte ranges of one old shard; what stays comes first."""
    found, at = [], 0
    for j in sorted(range(len(to)), key=lambda j: (j != own, j)):
        if to[j]:
            found.append((j, at, at + to[j]))
            at += to[j]
    return found


def rewrite(rows: DataFrame, old: str, folder: str) -> list[int]:
    """Write the shards whose rows changed below ``folder`` (``shard=N``); their numbers.

    ``rows`` comes from :func:`resharded`.  A shard is affected if a row came
    into it or left it; the files of others are left as they are.  A shard
    that lost all its rows loses its folder, after the others are written.
    """
    spark: SparkSession = rows.sparkSession
    moved = rows.where(F.col("shard") != F.col(old)).select(F.explode(F.array("shard", F.col(old).cast("int"))).alias("s"))
    touched = sorted(r[0] for r in moved.distinct().collect())
    if touched:
        kept = rows.where(F.col("shard").isin(touched))
        emptied = set(touched) - {r[0] for r in kept.select("shard").distinct().collect()}
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        kept.write.mode("overwrite").partitionBy("shard").parquet(folder)
        # Dynamic overwrite replaces only partitions that have a row.
        for shard in sorted(emptied):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"shard={shard}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return touched


def old_layout(key: Column, shards: int) -> Column:
    """Where keys lie before: by their hash, null keys in shard 0."""
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(shards)), F.lit(0)).cast(T.LongType())

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetally.session import cut_lineage, scratch_path

#: Rows of one Arrow batch; texts are long, so a batch is kept well under the default.
BATCH_ROWS = 1000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(work, schema)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return cut_lineage(df)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder; smaller than a checkpoint where rows are many."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def connected(links: DataFrame) -> DataFrame:
    """Connected components of the graph given by ``links(a, b)``.

    Returns ``(node, root)`` for every node on a link, the root being the
    smallest node of its component.  Alternates the two star contractions, each
    of which hangs neighbours on the smallest of them; a round keeps at most as
    many rows as it got, so no component is ever gathered in one task.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    before, now = None, _signature(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both, keep_center=False).where("u > v").distinct()
        edges = stored(_hang(large, keep_center=True).where("u > v").distinct())
        before, now = now, _signature(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _hang(edges: DataFrame, keep_center: bool) -> DataFrame:
    """Hang the neighbours of every ``u`` (and ``u`` itself, if kept) on the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    low = low.select("u", F.least("u", "low").alias("low"))
    hung = (
        edges.join(low, "u")
        .where(F.lit(True) if keep_center else F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return hung.unionByName(low.select("u", F.col("low").alias("v"))) if keep_center else hung


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))
    ).first()
    return tuple(row)


def per_process(name: str, make: Callable):
    """What ``make`` returns, made once in a Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]

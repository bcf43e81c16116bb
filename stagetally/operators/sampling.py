"""Bounded samples and per-object limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_values(
    counted: DataFrame, groups: list[str], value: str, n: int = 5, count: str | None = None
) -> DataFrame:
    """First ``n`` distinct values per group, sorted, as an array.

    ``counted`` already has one row per (group, value).  The row-number filter
    lets Spark keep only ``n`` rows per group on the map side, so no task ever
    holds all distinct values of a group, however many there are.  Naming the
    ``count`` column carries it along unused: the plan below then equals that of
    an aggregate over the counts, and Spark computes its shuffles once for both.
    """
    w = Window.partitionBy(*groups).orderBy(value)
    first = counted.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n)
    kept = F.struct(F.col(value).alias("v"), *([F.col(count).alias("n")] if count else []))
    listed = F.transform(F.sort_array(F.collect_list(kept)), lambda k: k.getField("v"))
    return first.groupBy(*groups).agg(listed.alias("sample_values"))


def limit_per_object(df: DataFrame, n: int | None, kind: str, order: list[str]) -> DataFrame:
    """First ``n`` rows of every object kind in the given order; 0 or None keeps all.

    The row-number filter is pushed below the shuffle by Spark, so each task
    forwards at most ``n`` rows of a kind.
    """
    if not n:
        return df
    w = Window.partitionBy(kind).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")

"""Row numbers within groups of any size, without a task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagetally.session import cut_lineage


def numbered_in_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, ranges: int | None = None
) -> DataFrame:
    """``df`` with the row number of each row in its group, in the given order; ``df`` is computed now.

    Rows are dealt into ranges of (group, order), so a group with most rows is
    spread over many of them.  Rows are counted per range and group, sums over
    a group's ranges give the number of rows before each range, and a window
    within (range, group) gives the rest.  Rows that tie on all of ``order``
    get different numbers, in any order.  The ranges are stored first, because
    numbers and counts have to speak of the same ones.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *[F.col(c) for c in group], *order)
    dealt = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint"))).drop("_rows")
    within = Window.partitionBy("_range", *group).orderBy(*order)
    placed = dealt.withColumn("_place", F.row_number().over(within))
    offsets = before.withColumnsRenamed({c: f"_b_{c}" for c in ["_range", *group]})
    match = F.col("_range") == F.col("_b__range")
    for c in group:
        match &= F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    joined = placed.join(offsets, match)
    return joined.select(*df.columns, (F.col("_before") + F.col("_place")).cast("int").alias(name))

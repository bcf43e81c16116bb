"""Distinct counts, value lists and sums over the same groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_aggregate(
    df: DataFrame,
    keys: list[str],
    distinct: Mapping[str, str],
    lists: Mapping[str, str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Per group: distinct counts, sorted distinct lists and sums (names -> columns).

    A list is comma-joined; without a value it is NULL, of one empty text it is empty.  Putting
    ``collect_set`` next to ``count(DISTINCT)`` would keep set objects for every
    distinct id, and sums next to distinct ids would be carried by every one of
    them.  Here sums are taken per combination of listed values, which mostly
    collapse before the shuffle; each distinct column is reduced to its values
    by itself (large groups spread over them), from the columns it needs, so
    Spark leaves out left joins that only gave others; and the last aggregate
    puts the few rows of each group together.
    """
    listed = {c: f"_l{i}" for i, c in enumerate(dict.fromkeys(lists.values()))}
    counted = {c: f"_n{i}" for i, c in enumerate(dict.fromkeys(distinct.values()))}
    measures = {name: f"_m{i}" for i, name in enumerate(sums)}

    rows = df.select(
        *keys,
        *[F.col(c).cast("string").alias(v) for c, v in listed.items()],
        *[sums[name].alias(m) for name, m in measures.items()],
    )
    parts = rows.groupBy(*keys, *listed.values()).agg(*[F.sum(m).alias(m) for m in measures.values()])
    for column, n in counted.items():
        values = df.select(*keys, F.col(column).cast("string").alias("_value")).distinct()
        values = values.groupBy(*keys).agg(F.count("_value").alias(n))
        parts = parts.unionByName(values, allowMissingColumns=True)

    def joined(column: str) -> Column:
        found = F.collect_set(listed[column])
        return F.when(F.size(found) > 0, F.array_join(F.sort_array(found), ","))

    return parts.groupBy(*keys).agg(
        *[joined(c).alias(name) for name, c in lists.items()],
        *[F.coalesce(F.sum(counted[c]), F.lit(0).cast("bigint")).alias(name) for name, c in distinct.items()],
        *[F.sum(m).alias(name) for name, m in measures.items()],
    )

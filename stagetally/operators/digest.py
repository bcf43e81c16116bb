"""Digests of tables that don't depend on the order of their rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST = ["rows", "hash_sum", "hash_xor"]


def row_hash(columns: Iterable[str]) -> Column:
    """64-bit hash of a row; where its NULLs are counts, which the hash function alone leaves out."""
    columns = list(columns)
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _total(hashed: Column) -> Column:
    """The sum of 64-bit hashes, from sums of three parts of them: longs add up much faster than decimals, and 2**41 rows don't overflow."""
    parts = [
        (F.shiftright(hashed, 43), 1 << 43),
        (F.shiftright(hashed, 21).bitwiseAND(F.lit((1 << 22) - 1)), 1 << 21),
        (hashed.bitwiseAND(F.lit((1 << 21) - 1)), 1),
    ]
    low, *rest = [F.coalesce(F.sum(c), F.lit(0)).cast("decimal(20)") * F.lit(factor).cast("decimal(14)") for c, factor in reversed(parts)]
    for part in rest:
        low = low + part
    return low.cast("decimal(38)")


def digest_of(columns: Iterable[str]) -> list[Column]:
    """Aggregates: rows, and sum and exclusive or of their hashes.

    Equal for equal multisets of rows, whatever their order; the sums of two
    parts add up, so a digest can be taken while rows are written.
    """
    hashed = row_hash(columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        _total(hashed).alias("hash_sum"),
        F.coalesce(F.bit_xor(hashed), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def digests(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """One digest per group, over all columns (the group's own too)."""
    return df.groupBy(*by).agg(*digest_of(df.columns))

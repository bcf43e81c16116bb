"""Pairs of texts of which one contains the other, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of the grams that longer texts are found by.
GRAM = 3


def _parts(name: str, size: int) -> Column:
    """Distinct substrings of one length; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.length(name) - size + 1)
    found = F.array_distinct(F.transform(starts, lambda i: F.substr(F.col(name), i, F.lit(size))))
    return F.when(F.length(name) >= size, found)


def contained_in(small: DataFrame, big: DataFrame, gram: int = GRAM) -> DataFrame:
    """``(small, big)`` for all pairs where ``big(big)`` contains ``small(small)``; both have distinct texts without NULL.

    A text shorter than ``gram`` is found by equality with the substrings of
    its length.  A longer one is looked up by the rarest of its grams: it is
    compared with the texts that hold that gram only, and with none if they
    lack any of its grams.  So the rows made grow with the lengths of the
    texts, not with their squares.  The empty text is in every text.
    """
    short = small.filter(F.length("small") < gram)
    pieces = F.concat(F.array(F.lit("")), *[F.coalesce(_parts("big", n), F.array()) for n in range(1, gram)])
    by_part = short.join(big.select("big", F.explode(pieces).alias("_part")), F.col("small") == F.col("_part"))

    held = big.select("big", F.explode(_parts("big", gram)).alias("_gram"))
    frequency = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_times"))
    wanted = small.withColumn("_grams", _parts("small", gram)).select("small", F.size("_grams").alias("_n"), F.explode("_grams").alias("_gram"))
    rarest = (
        wanted.join(frequency, "_gram")
        .groupBy("small", "_n")
        .agg(F.min(F.struct("_times", "_gram")).alias("_least"), F.count(F.lit(1)).alias("_found"))
        .filter("_found = _n")
        .select("small", F.col("_least._gram").alias("_gram"))
    )
    by_gram = rarest.join(held, "_gram").filter(F.contains("big", "small"))
    return by_part.select("small", "big").unionByName(by_gram.select("small", "big"))

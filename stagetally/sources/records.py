"""CSV records with quoted line breaks, read by as many tasks as a file has splits.

A line alone does not tell whether it begins inside a quoted field.  But each
line says what becomes of either case, and these two answers are put together
over lines, splits and files; only then are lines joined to records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line ends within a quoted field, if it begins inside one or outside.

    A field is quoted if a quote is its first character.  A doubled quote in it
    stands for one; a single one ends the quoting, whatever follows up to the
    next comma.  A quote elsewhere means nothing.
    """
    pieces = F.split(line, '"', -1)
    last = F.element_at(pieces, -1)
    begin = F.struct(F.lit(_INSIDE if inside else _OUTSIDE).alias("at"), F.lit(not inside).alias("fresh"))

    def quote(state: Column, piece: Column) -> Column:
        """The state after a piece without quotes and the quote behind it."""
        fresh = F.when(piece == "", state["fresh"]).otherwise(piece.endswith(","))
        opened = F.when(fresh, _INSIDE).otherwise(_OUTSIDE)
        at = (
            F.when(state["at"] == _INSIDE, _CLOSED)
            .when((state["at"] == _CLOSED) & (piece == ""), _INSIDE)
            .otherwise(opened)
        )
        return F.struct(at.alias("at"), F.lit(False).alias("fresh"))

    state = F.aggregate(F.slice(pieces, F.lit(1), F.size(pieces) - 1), begin, quote)
    return F.when(~line.contains('"'), F.lit(inside)).otherwise((state["at"] == _INSIDE) & last.isNotNull())


def csv_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, modified_at, number, record)``: the records of CSV files, numbered from 1 in each file.

    Blank lines between records are left out; line breaks within a record are
    ``\\n``.  A quote that is never closed takes the rest of its file.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", True)
        .text(paths)
        .select(
            F.regexp_replace("value", "\r$", "").alias("line"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    out, inn = ends_inside(F.col("line"), False), ends_inside(F.col("line"), True)
    lines = lines.withColumns({"_out": out, "_in": inn})
    fixed, swap = F.col("_out") == F.col("_in"), F.col("_out") & ~F.col("_in")
    split = Window.partitionBy("path", "block").orderBy("place")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    # A line that ends the same way in both cases settles what follows; others keep or turn the state.
    turns = F.coalesce(F.sum(swap.cast("int")).over(before), F.lit(0))
    lines = lines.withColumn("_turns", turns)
    lines = lines.withColumns(
        {
            "_known": F.last(F.when(fixed, F.col("_out")), ignorenulls=True).over(before),
            "_since": F.col("_turns") - F.coalesce(F.last(F.when(fixed, F.col("_turns")), ignorenulls=True).over(before), F.lit(0)),
        }
    )
    odd = F.pmod("_since", F.lit(2)) == 1
    lines = lines.withColumns(
        {
            "_if_out": F.coalesce("_known", F.lit(False)) != odd,
            "_if_in": F.coalesce("_known", F.lit(True)) != odd,
        }
    )
    starts = {c: (~F.col(f"_if_{c}") & (F.col("line") != "")).cast("int") for c in ("out", "in")}
    after = {c: F.when(F.col(f"_if_{c}"), F.col("_in")).otherwise(F.col("_out")) for c in ("out", "in")}
    blocks = lines.groupBy("path", "block").agg(
        *[F.sum(starts[c]).alias(f"_starts_{c}") for c in starts],
        *[F.max_by(after[c], F.col("place")).alias(f"_after_{c}") for c in after],
    )
    blocks = _block_states(blocks)
    joined = lines.join(blocks, ["path", "block"])
    inside = F.when(F.col("_begins_in"), F.col("_if_in")).otherwise(F.col("_if_out"))
    joined = joined.withColumn("_inside", inside)
    start = (~F.col("_inside") & (F.col("line") != "")).cast("int")
    number = F.col("_earlier") + F.sum(start).over(split.rowsBetween(Window.unboundedPreceding, 0))
    numbered = joined.withColumn("number", number).filter(F.col("_inside") | (F.col("line") != ""))
    columns = ["path", "modified_at", "number"]
    open_ended = F.when(F.col("_inside"), F.col("_in")).otherwise(F.col("_out"))
    whole = numbered.filter(~F.col("_inside") & ~open_ended).select(*columns, F.col("line").alias("record"))
    parts = numbered.filter(F.col("_inside") | open_ended).groupBy("path", "number").agg(
        F.first("modified_at").alias("modified_at"),
        F.array_sort(F.collect_list(F.struct("block", "place", "line"))).alias("_lines"),
    )
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")
    return whole.unionByName(parts.select(*columns, text.alias("record")))


def _block_states(blocks: DataFrame) -> DataFrame:
    """``(path, block, _begins_in, _earlier)``: how each split of a file begins, and the records before it.

    The splits of a file are put together in order; there is one row per split.
    """
    step = F.struct("block", "_starts_out", "_starts_in", "_after_out", "_after_in")
    files = blocks.groupBy("path").agg(F.array_sort(F.collect_list(step)).alias("_blocks"))
    kind = "array<struct<block:bigint,_begins_in:boolean,_earlier:bigint>>"
    begin = F.struct(
        F.lit(False).alias("inside"), F.lit(0).cast("bigint").alias("records"), F.array().cast(kind).alias("done")
    )

    def put(state: Column, b: Column) -> Column:
        starts = F.when(state["inside"], b["_starts_in"]).otherwise(b["_starts_out"])
        this = F.struct(b["block"].alias("block"), state["inside"].alias("_begins_in"), state["records"].alias("_earlier"))
        return F.struct(
            F.when(state["inside"], b["_after_in"]).otherwise(b["_after_out"]).alias("inside"),
            (state["records"] + starts).cast("bigint").alias("records"),
            F.concat(state["done"], F.array(this)).cast(kind).alias("done"),
        )

    found = files.select("path", F.aggregate("_blocks", begin, put)["done"].alias("_done"))
    return found.select("path", F.inline("_done"))

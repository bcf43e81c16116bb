"""Snapshot identifiers: canonical form, format classes, dates in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
CANONICAL_TIME = "T06:00:00Z"
_ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})(:\d{2})?([.,]\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def format_snapshot_id(ts: Column) -> Column:
    """Second-precision UTC text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_snapshot_id(text: Column) -> Column:
    """Timestamp of a canonical identifier; NULL when it is not one."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def readable_snapshot_id(c: Column) -> Column:
    """The canonical identifier; NULL where ``canonical_snapshot_id`` would put the current time."""
    nothing = F.lit(None).cast("timestamp")
    return F.when(parse_snapshot_id(canonical_snapshot_id(c, nothing)).isNotNull(), canonical_snapshot_id(c, nothing))


def canonical_snapshot_id(c: Column, as_of: Column | None = None) -> Column:
    """Identifier without fractions, a bare date moved to 06:00.

    Offsets are dropped, not applied: the wall clock is kept and marked ``Z``,
    which is what downstream tables already hold.  Blank or unreadable values
    become ``as_of`` (now, unless given).
    """
    fallback = format_snapshot_id(F.current_timestamp() if as_of is None else as_of)
    day = F.regexp_extract(c, _ISO, 1)
    clock = F.concat(
        F.regexp_extract(c, _ISO, 2),
        F.coalesce(F.nullif(F.regexp_extract(c, _ISO, 3), F.lit("")), F.lit(":00")),
    )
    wall = F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit("yyyy-MM-dd HH:mm:ss"))
    is_utc = c.endswith("Z")
    return (
        F.when(c.isNull() | (c == ""), fallback)
        .when(is_utc & ~c.contains("."), c)
        .when(is_utc, F.concat(F.substring_index(c, ".", 1), F.lit("Z")))
        .when(~c.contains("+") & (F.length(c) == 10) & c.contains("-"), F.concat(c, F.lit(CANONICAL_TIME)))
        .otherwise(F.coalesce(format_snapshot_id(wall), fallback))
    )


def migrated_snapshot_id(c: Column) -> Column:
    """Migration rule: every time that is not already UTC is reset to 06:00."""
    is_utc = c.endswith("Z")
    return (
        F.when(is_utc & ~c.contains("."), c)
        .when(is_utc, F.concat(F.substring_index(c, ".", 1), F.lit("Z")))
        .otherwise(F.concat(F.substring_index(c, "T", 1), F.lit(CANONICAL_TIME)))
    )


def snapshot_id_format(c: Column) -> Column:
    """Struct describing how an identifier is written."""
    size = F.length(c)
    kind = (
        F.when(size == 10, "date_only")
        .when(size == 19, "datetime_no_tz")
        .when((size == 20) & c.endswith("Z"), "datetime_utc")
        .when((size == 27) & c.endswith("Z"), "datetime_microseconds_utc")
        .otherwise("custom")
    )
    return F.struct(
        c.contains(".").alias("has_microseconds"),
        (c.endswith("Z") | c.contains("+") | c.endswith("UTC")).alias("has_timezone"),
        size.cast("bigint").alias("length"),
        kind.alias("format_type"),
    )


def file_date(name: Column) -> Column:
    """First ``YYYY-MM-DD`` in a file name, NULL when there is none."""
    return F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))

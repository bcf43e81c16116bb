"""The snapshot registry as an append-only log.

A change is a file of rows; nothing is rewritten and there is no folder per
snapshot.  Rows that say what to remove or to change stand in the log too;
reading folds them (``operators.registry.current_rows``).  Small files are
merged by size tiers.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.functions.records import stringify_complex
from stagetally.operators.registry import CONTROL, current_rows
from stagetally.session import literal_table
from stagetally.sources.merging import finish_swaps, swap_files

LOG = "snapshot_registry"
#: So many files of one size tier are merged into one; a tier is so many times larger than the one before.
TIER = 16
_TIER_BYTES = 64 << 10
_last = [0]


def next_entry() -> int:
    """A number for a change: later changes, also of other processes with a right clock, have larger ones."""
    _last[0] = max(_last[0] + 1, time.time_ns() // 1000)
    return _last[0]


def log_rows(warehouse, df: DataFrame, entry: int | None = None) -> DataFrame:
    """Registry rows with control columns, as they are stored; absent control columns are NULL."""
    if not any(c in df.columns for c in CONTROL):
        df = stringify_complex(df)
    if "_entry" not in df.columns:
        df = df.withColumn("_entry", F.lit(next_entry() if entry is None else entry))
    absent = {c: F.lit(None) for c in CONTROL if c not in df.columns}
    df = df.withColumns(absent) if absent else df
    return warehouse._conform(df, LOG, CONTROL)


def append(warehouse, df: DataFrame, one_file: bool = False, entry: int | None = None) -> None:
    """Add rows; ``one_file`` is for the few rows of a change."""
    unpartitioned(warehouse)
    rows = log_rows(warehouse, df, entry)
    (rows.coalesce(1) if one_file else rows).write.mode("append").parquet(warehouse.path(LOG))
    compact(warehouse)


def superseding(
    warehouse, snapshot_ids: Iterable, removed: Iterable[str] = (), status: str | None = None, note: str | None = None
) -> DataFrame:
    """Control rows: for each snapshot, triggers whose earlier rows go, or a status and note for its earlier rows."""
    rows = literal_table(warehouse.spark, [(s,) for s in snapshot_ids], "snapshot_id timestamp")
    gone = F.array(*[F.lit(t) for t in removed]) if removed else F.lit(None)
    return rows.select(
        "snapshot_id",
        gone.cast("array<string>").alias("_removes"),
        F.lit(status).cast("string").alias("_status"),
        F.lit(note).cast("string").alias("_note"),
    )


def read(warehouse) -> DataFrame:
    """The rows in force."""
    return current_rows(raw(warehouse))


def raw(warehouse, files: list[str] | None = None) -> DataFrame:
    """The log itself; a registry that is stored by snapshot, without control columns, is read too."""
    return warehouse._read_at(files or warehouse.path(LOG), LOG, control=CONTROL)


def _files(warehouse) -> list[tuple[str, int]]:
    fs, root = warehouse._fs(warehouse.path(LOG))
    found = [(s.getPath(), s.getLen()) for s in fs.listStatus(root) if s.isFile()]
    return [(p.toString(), n) for p, n in found if not p.getName().startswith(("_", "."))]


def unpartitioned(warehouse) -> None:
    """Turn a registry that is stored by snapshot into a log, once."""
    if warehouse._folders(warehouse.path(LOG)):
        warehouse._swap_in(log_rows(warehouse, raw(warehouse).drop("_entry"), 0), LOG, keep_if_empty=False)


def compact(warehouse, tier: int = TIER) -> int:
    """Merge the files of each tier that has ``tier`` of them into one; returns how many were merged.

    A file in tier k has less than ``tier**k`` times 64 KB.  If all files are
    merged, the rows in force replace them.
    """
    finish_swaps(warehouse, LOG)
    tiers: dict[int, list[str]] = {}
    files = _files(warehouse)
    for path, size in files:
        tiers.setdefault(max(0, math.ceil(math.log(max(1, size) / _TIER_BYTES, tier))), []).append(path)
    merged = 0
    for own in tiers.values():
        if len(own) < tier:
            continue
        rows = raw(warehouse, own)
        if len(own) == len(files):
            rows = current_rows(rows, keep_entry=True)
        beside = f"{warehouse.root}/_new-{warehouse.prefix}{LOG}-{uuid.uuid4().hex}"
        log_rows(warehouse, rows).coalesce(1).write.parquet(beside)
        swap_files(warehouse, LOG, beside, own)
        merged += len(own)
    return merged

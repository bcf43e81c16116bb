"""Upserts that rewrite only the files that hold matched rows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SWAP = "_swap-"


def files_with(warehouse, name: str, keys: DataFrame, key: str) -> list[str]:
    """Paths of the table's files that hold a row with one of ``keys(_wanted)``."""
    held = warehouse.read_with_files(name).select(F.col(key).cast("string").alias("_held"), "_file")
    found = held.join(keys, F.col("_held") == F.col("_wanted"), "left_semi").select("_file").distinct().collect()
    jvm = warehouse.spark._jvm
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_file"])).toString() for r in found)


def swap_files(warehouse, name: str, beside: str, removed: list[str]) -> None:
    """Put the files below ``beside`` into the table and take the ``removed`` ones out.

    What is to be done is written down first; :func:`finish_swaps` ends a swap
    that was cut off, so the table never stays half changed for the next writer.
    """
    fs, root = warehouse._fs(warehouse.path(name))
    fs.mkdirs(root)
    note = warehouse._fs(f"{warehouse.path(name)}/{_SWAP}{uuid.uuid4().hex}")[1]
    out = fs.create(note, False)
    out.write(bytearray(json.dumps({"beside": beside, "removed": removed}).encode()))
    out.close()
    finish_swaps(warehouse, name)


def finish_swaps(warehouse, name: str) -> int:
    """End the swaps of a table that are written down; returns how many there were."""
    fs, root = warehouse._fs(warehouse.path(name))
    notes = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(_SWAP)] if fs.exists(root) else []
    for note in notes:
        stream = fs.open(note)
        todo = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        _move_in(warehouse, fs, todo["beside"], warehouse.path(name))
        for path in todo["removed"]:
            fs.delete(warehouse._fs(path)[1], False)
        fs.delete(warehouse._fs(todo["beside"])[1], True)
        fs.delete(note, False)
    return len(notes)


def _move_in(warehouse, fs, beside: str, table: str) -> None:
    """Every data file below ``beside`` to the same place below the table; those already moved are gone there."""
    source = warehouse._fs(beside)[1]
    if not fs.exists(source):
        return
    depth = fs.makeQualified(source).depth()
    files, found = fs.listFiles(source, True), []
    while files.hasNext():
        found.append(files.next().getPath())
    path_of = warehouse.spark._jvm.org.apache.hadoop.fs.Path
    for file in found:
        if file.getName().startswith(("_", ".")):
            continue
        names = []
        while file.depth() > depth + len(names):
            at = file
            for _ in names:
                at = at.getParent()
            names.append(at.getName())
        target = warehouse._fs(table)[1]
        for part in reversed(names):
            target = path_of(target, part)
        fs.mkdirs(target.getParent())
        if not fs.rename(file, target):
            raise OSError(f"cannot move {file.toString()}")

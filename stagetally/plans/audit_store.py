"""Parts of audits kept beside a warehouse, one folder per table and snapshot."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.operators.audit_parts import PARTS, parts_of, rules_version
from stagetally.schemas import PARTITIONED
from stagetally.session import cut_lineage, literal_table
from stagetally.sources.warehouse import Warehouse, as_timestamp


def _path(warehouse: Warehouse) -> str:
    return f"{warehouse.root}/_audit-{warehouse.prefix}parts"


def _states(warehouse: Warehouse, name: str) -> dict:
    """Snapshot -> digest of its files' names, sizes and times, and of the rules; from a listing."""
    fs, root = warehouse._fs(warehouse.path(name))
    path_of = warehouse.spark._jvm.org.apache.hadoop.fs.Path
    found = {}
    for snapshot, folder in warehouse._folders(warehouse.path(name)):
        files = sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path_of(root, folder)))
        found[snapshot] = hashlib.sha256(repr((rules_version(), files)).encode()).hexdigest()
    return found


def _stored(warehouse: Warehouse) -> DataFrame:
    fs, path = warehouse._fs(_path(warehouse))
    if not fs.exists(path):
        return literal_table(warehouse.spark, [], PARTS)
    return warehouse.spark.read.schema(PARTS).parquet(_path(warehouse))


def audit_parts(warehouse: Warehouse, tables: list[str]) -> DataFrame:
    """Parts of all the tables; only snapshots that changed since the last audit are read and stored anew.

    Tables without snapshots, the registry and rows without a snapshot id are
    always read.  Parts of snapshots that are gone are left out and removed.
    """
    spark = warehouse.spark
    facts = [t for t in tables if t in PARTITIONED]
    states = {t: _states(warehouse, t) for t in facts}
    stored = _stored(warehouse)
    state_rows = stored.filter("kind = 'state'").select("table", F.col("snapshot_id").cast("string").alias("id"), "value").collect()
    known = {(r["table"], as_timestamp(r["id"])): r["value"] for r in state_rows}
    current = {(t, s): v for t in facts for s, v in states[t].items() if s is not None}
    kept = [k for k, v in current.items() if known.get(k) == v]
    fresh = [parts_of(t, warehouse.read(t)) for t in tables if t not in facts]
    changed: dict[str, list] = {}
    for t, s in sorted(current.keys() - set(kept)):
        changed.setdefault(t, []).append(s)
    new = []
    for t in facts:
        whole = warehouse.read(t)
        if None in states[t]:
            fresh.append(parts_of(t, whole.filter(F.col("snapshot_id").isNull())))
        if t in changed:
            new.append(parts_of(t, warehouse.read_snapshots(t, changed[t])))
    if new:
        marks = [(t, s, "state", "", current[t, s], 0) for t, ids in changed.items() for s in ids]
        new.append(literal_table(spark, marks, PARTS))
        rows = reduce(DataFrame.unionByName, new)
        rows.hint("rebalance", "table", "snapshot_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "table", "snapshot_id"
        ).parquet(_path(warehouse))
    _remove(warehouse, known.keys() - current.keys())
    wanted = literal_table(spark, list(current), "table string, snapshot_id timestamp")
    out = _stored(warehouse).filter("kind <> 'state'").join(wanted, ["table", "snapshot_id"], "left_semi")
    return out.unionByName(cut_lineage(reduce(DataFrame.unionByName, fresh))) if fresh else out


def _remove(warehouse: Warehouse, gone) -> None:
    for table, snapshot in gone:
        fs, folder = warehouse._fs(f"{_path(warehouse)}/table={table}")
        for found, name in warehouse._folders(folder.toString()):
            if found == snapshot:
                fs.delete(warehouse.spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)

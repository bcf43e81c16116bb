"""Loads of several tables that become visible together and can be taken back.

Rows are written beside their tables first.  Only when every table is complete
are the files moved in, so a source that fails halfway changes nothing.  Files
carry the load's name: what a load that died while moving has left can be found
and removed without touching rows of others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stagetally.operators.digest import DIGEST, digest_of, digests

_KEY = "snapshot_id"
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


class Load:
    """A load into the fact tables of a warehouse; use it in a ``with`` block, which removes what is left beside."""

    def __init__(self, warehouse):
        self.warehouse = warehouse
        self.name = f"load-{uuid.uuid4().hex}"
        self.observed: dict[str, dict] = {}

    def __enter__(self) -> "Load":
        return self

    def __exit__(self, *error) -> None:
        for name in self.observed:
            fs, path = self.warehouse._fs(self._path(name))
            fs.delete(path, True)

    def _path(self, name: str) -> str:
        return f"{self.warehouse.root}/_new-{self.warehouse.prefix}{name}-{self.name}"

    def stage(self, df: DataFrame, name: str) -> None:
        """Compute and write the rows of one table; its digest is taken on the way.

        Rows without a snapshot id are written too, but never moved in.
        """
        seen = Observation()
        self.observed[name] = {}
        rows = self.warehouse._conform(df, name)
        rows = rows.hint("rebalance", F.col(_KEY)).observe(seen, *digest_of(rows.columns))
        (
            rows.write.mode("errorifexists")
            .option("mapreduce.output.basename", self.name)
            .partitionBy(_KEY)
            .parquet(self._path(name))
        )
        self.observed[name] = seen.get

    def stage_all(self, tables: Mapping[str, DataFrame]) -> None:
        """Stage several tables at a time, so that the tail of one write does not leave the cluster idle.

        All have ended, well or not, when this returns or raises.
        """
        with ThreadPoolExecutor(max(1, len(tables))) as pool:
            running = [pool.submit(self.stage, df, name) for name, df in tables.items()]
        for one in running:
            one.result()

    def rows(self, name: str) -> DataFrame:
        """What is staged, before it is published."""
        return self.warehouse._read_at(self._path(name), name)

    def snapshots(self, name: str) -> dict[datetime, str]:
        """Staged snapshots and their folders, from a listing."""
        return {s: f for s, f in self.warehouse._folders(self._path(name)) if s is not None}

    def digests(self, name: str) -> DataFrame:
        """Digest per staged snapshot; an error if together they aren't what the source gave."""
        found = digests(self.rows(name), [_KEY])
        rows = found.collect()
        if sum(r["rows"] for r in rows) != self.observed[name].get("rows", 0) or sum(r["hash_sum"] for r in rows) != self.observed[
            name
        ].get("hash_sum", 0):
            raise OSError(f"{name}: what was written is not what was computed")
        return self.warehouse.spark.createDataFrame(rows, found.schema)

    def counts(self, name: str, wanted: Iterable[datetime] = ()) -> dict[datetime, int]:
        """Rows per staged snapshot; 0 for those ``wanted`` that have none."""
        from stagetally.sources.warehouse import as_timestamp

        found = self.rows(name).filter(F.col(_KEY).isNotNull()).groupBy(F.col(_KEY).cast("string")).count().collect()
        return dict.fromkeys(wanted, 0) | {as_timestamp(r[0]): r[1] for r in found}

    def publish(self, replaced: Iterable[datetime] = ()) -> None:
        """Move all staged snapshots in.

        ``replaced`` snapshots lose the rows they had, and are gone if nothing
        is staged for them; other snapshots keep theirs.  Nothing is computed
        here: files are renamed.
        """
        replaced = set(replaced)
        for name in self.observed:
            fs, table = self.warehouse._fs(self.warehouse.path(name))
            fs.mkdirs(table)
            there = dict(self.warehouse._folders(self.warehouse.path(name)))
            staged = self.snapshots(name)
            for snapshot in replaced & set(there) - set(staged):
                fs.delete(self._child(table, there[snapshot]), True)
            for snapshot, folder in staged.items():
                source = self._child(self.warehouse._fs(self._path(name))[1], folder)
                target = self._child(table, there.get(snapshot, folder))
                if snapshot in there and snapshot in replaced:
                    old = self.warehouse._fs(f"{self._path(name)}/_old-{folder}")[1]
                    self._rename(fs, target, old)
                    try:
                        self._rename(fs, source, target)
                    except Exception:
                        self._rename(fs, old, target)
                        raise
                elif snapshot in there:
                    for status in fs.listStatus(source):
                        self._rename(fs, status.getPath(), self._child(target, status.getPath().getName()))
                else:
                    self._rename(fs, source, target)

    def _child(self, path, name: str):
        return self.warehouse.spark._jvm.org.apache.hadoop.fs.Path(path, name)

    @staticmethod
    def _rename(fs, source, target) -> None:
        if not fs.rename(source, target):
            raise OSError(f"cannot move {source.toString()} to {target.toString()}")


def withdraw(warehouse, load: str, names: Iterable[str], snapshot_ids: Iterable[datetime]) -> None:
    """Remove what a load has moved into some snapshots of the tables."""
    wanted = set(snapshot_ids)
    for name in names:
        fs, table = warehouse._fs(warehouse.path(name))
        for snapshot, folder in warehouse._folders(warehouse.path(name)):
            if snapshot not in wanted:
                continue
            path = warehouse.spark._jvm.org.apache.hadoop.fs.Path(table, folder)
            files = [s.getPath() for s in fs.listStatus(path)]
            own = [f for f in files if f.getName().startswith(load)]
            if own and len(own) == len([f for f in files if not f.getName().startswith((".", "_"))]):
                fs.delete(path, True)
            else:
                for f in own:
                    fs.delete(f, False)

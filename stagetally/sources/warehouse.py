"""Parquet-backed tables: reading, appending, replacing, upserting, mirroring.

Fact tables are laid out one directory per ``snapshot_id``, so a snapshot scan
prunes partitions and a rewrite touches only the snapshots it concerns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions.records import stringify_complex
from stagetally.operators.alignment import required_tables_present
from stagetally.operators.digest import DIGEST, digest_of, digests
from stagetally.operators.profiles import table_row_counts
from stagetally.schemas import FACT_TABLES, PARTITIONED, TABLES
from stagetally.session import configure, cut_lineage, literal_table
from stagetally.sources import log
from stagetally.sources.merging import files_with, finish_swaps, swap_files
from stagetally.sources.staging import Load

_KEY = "snapshot_id"


class Warehouse:
    """A folder of tables.

    ``prefix`` is put before every table's folder name, and ``column_names``
    (table -> {our name: stored name}) maps columns stored under other names.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        column_names: Mapping[str, Mapping[str, str]] | None = None,
    ):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.column_names = {t: dict(m) for t, m in (column_names or {}).items()}
        #: Digests of the rows that were copied elsewhere, by target path.
        self._copied: dict[str, tuple] = {}

    # -- locations ---------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{self.prefix}{name}"

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return jvm_path.getFileSystem(conf), jvm_path

    def exists(self, name: str) -> bool:
        fs, path = self._fs(self.path(name))
        return fs.exists(path)

    def tables(self) -> list[str]:
        """Names of the known tables that are present."""
        return [t for t in TABLES if self.exists(t)]

    def require(self, *names: str) -> None:
        """Raise unless all the tables are present."""
        rows = required_tables_present(self.spark, [n for n in names if self.exists(n)], list(names))
        missing = [r["table"] for r in rows.filter("NOT present").collect()]
        if missing:
            raise FileNotFoundError(f"missing at {self.root}: {', '.join(missing)}")

    # -- reading -----------------------------------------------------------------

    def read_or_empty(self, name: str) -> DataFrame:
        """The table, or no rows before its first write."""
        return self.read(name) if self.exists(name) else literal_table(self.spark, [], TABLES[name])

    def read(self, name: str) -> DataFrame:
        """The table under its declared schema; an absent one is an error."""
        if not self.exists(name):
            raise FileNotFoundError(f"no table {name} at {self.path(name)}")
        return log.read(self) if name == log.LOG else self._read_at(self.path(name), name)

    def read_with_files(self, name: str) -> DataFrame:
        """The table with ``_file``, the URI of each row's file."""
        return self._read_at(self.path(name), name, F.col("_metadata.file_path").alias("_file"))

    def _read_at(self, path: str | list[str], name: str, *more, control: Mapping[str, str] = {}) -> DataFrame:
        """Rows at a path, or in some of the table's files, with further columns and stored control columns."""
        schema = TABLES[name]
        stored = self.column_names.get(name, {})
        disk = T.StructType(
            [T.StructField(stored.get(f.name, f.name), f.dataType) for f in schema]
            + [T.StructField(c, _type(kind)) for c, kind in control.items()]
        )
        reader = self.spark.read.schema(disk)
        df = reader.parquet(path) if isinstance(path, str) else reader.option("basePath", self.path(name)).parquet(*path)
        return df.select(*[F.col(stored.get(c, c)).alias(c) for c in schema.names], *control, *more)

    def read_table_for_snapshot(self, name: str, snapshot_id) -> DataFrame:
        """One snapshot of a fact table; the filter prunes directories."""
        return self.read(name).filter(F.col(_KEY) == as_timestamp(snapshot_id))

    def read_snapshots(self, name: str, snapshot_ids: Iterable | None) -> DataFrame:
        df = self.read(name)
        if snapshot_ids is None:
            return df
        return df.filter(F.col(_KEY).isin([as_timestamp(s) for s in snapshot_ids]))

    # -- writing -----------------------------------------------------------------

    def _conform(self, df: DataFrame, name: str, control: Mapping[str, str] = {}) -> DataFrame:
        """Declared columns in order, cast by name, then control columns; absent ones become NULL."""
        extra = [F.col(c).cast(kind).alias(c) for c, kind in control.items()]
        df = df if control else stringify_complex(df)
        stored = self.column_names.get(name, {})
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(stored.get(f.name, f.name))
                for f in TABLES[name]
            ],
            *extra,
        )

    def _store(self, df: DataFrame, name: str, mode: str, dynamic: bool = False, path: str | None = None) -> None:
        """Write conformed rows; ``dynamic`` overwrites only the snapshots present."""
        if name in PARTITIONED:
            # Rebalancing gathers each snapshot's rows into a few well-sized files and,
            # under AQE, still splits a snapshot that holds most of the rows.
            writer = df.hint("rebalance", F.col(_KEY)).write.partitionBy(_KEY)
        else:
            writer = df.write
        kind = "dynamic" if dynamic else "static"
        writer.mode(mode).option("partitionOverwriteMode", kind).parquet(path or self.path(name))

    def append_table(self, df: DataFrame, name: str) -> None:
        if name == log.LOG:
            log.append(self, df)
            return
        self._store(self._conform(df, name), name, "append")

    def replace_table(self, df: DataFrame, name: str) -> bool:
        """Replace the whole table; an empty input leaves it as it is."""
        return self._swap_in(self._conform(df, name), name)

    def _swap_in(self, df: DataFrame, name: str, keep_if_empty: bool = True) -> bool:
        """Write the rows beside the table, then put them in its place.

        The old files stay until the new ones are complete, so the input may be
        derived from the table, is computed once, and a failed write loses
        nothing.  Rows are counted during the write.
        """
        seen = Observation()
        fs, table = self._fs(self.path(name))
        beside = f"{self.root}/_new-{self.prefix}{name}-{uuid.uuid4().hex}"
        new, old = self._fs(beside)[1], self._fs(beside.replace("/_new-", "/_old-"))[1]
        try:
            self._store(df.observe(seen, *digest_of(df.columns)), name, "errorifexists", path=beside)
            self._last_digest = tuple(seen.get.get(c, 0) for c in DIGEST)
            if not self._last_digest[0] and keep_if_empty:
                return False
            there = fs.exists(table)
            if there and not fs.rename(table, old):
                raise OSError(f"cannot move {table.toString()}")
            if not fs.rename(new, table):
                if there:
                    fs.rename(old, table)
                raise OSError(f"cannot move {new.toString()}")
            fs.delete(old, True)
            return True
        finally:
            fs.delete(new, True)

    def replace_snapshots(self, df: DataFrame, name: str, snapshot_ids: Iterable) -> dict[datetime, int]:
        """Make the given snapshots hold exactly the rows of ``df``.

        Returns rows written per snapshot.  Only those directories are touched,
        after all rows are written; a snapshot that produced no row is removed
        in the same step.  The input is computed once and may be derived from
        the table.
        """
        wanted = {as_timestamp(s) for s in snapshot_ids}
        with Load(self) as load:
            load.stage(df.filter(F.col(_KEY).isin(list(wanted))), name)
            counts = load.counts(name, wanted)
            load.publish(wanted)
        return counts

    def replace_snapshot(self, df: DataFrame, name: str, snapshot_id) -> int:
        return self.replace_snapshots(df, name, [snapshot_id])[as_timestamp(snapshot_id)]

    def _drop_snapshots(self, name: str, snapshot_ids: Iterable[datetime]) -> None:
        """Remove whole snapshot directories (a listing and deletes, no data read)."""
        doomed = {as_timestamp(s) for s in snapshot_ids}
        if not doomed or not self.exists(name):
            return
        fs, root = self._fs(self.path(name))
        for snapshot, folder in self._folders(self.path(name)):
            if snapshot in doomed:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(root, folder), True)

    def _folders(self, path: str) -> list[tuple[datetime | None, str]]:
        """Snapshot (None for rows without one) and name of every partition folder at a path."""
        fs, root = self._fs(path)
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = []
        for status in fs.listStatus(root) if fs.exists(root) else []:
            folder = status.getPath().getName()
            if folder.startswith(f"{_KEY}="):
                value = unescape(folder.split("=", 1)[1])
                found.append((None if value == "__HIVE_DEFAULT_PARTITION__" else as_timestamp(value), folder))
        return found

    def upsert_table(self, source: DataFrame, name: str, key: str) -> None:
        """Merge by key: matched rows updated, new rows added, the rest kept.

        Keys compare as text; NULL keys never match, so they are always added.
        A matched row keeps the target's value in columns the source lacks.
        Repeated keys in the source are an error.

        Only files that hold a matched row are rewritten; new rows go to files
        of their own.  The source is computed once, of the target's other files
        only the keys are read.
        """
        source = cut_lineage(stringify_complex(source).withColumn(key, F.col(key).cast("string")))
        keys = source.filter(F.col(key).isNotNull()).select(F.col(key).alias("_wanted"))
        if not keys.groupBy("_wanted").count().filter("count > 1").isEmpty():
            raise ValueError(f"upsert into {name}: {key} is not unique in the source")
        if not self.exists(name):
            self.append_table(source, name)
            return
        finish_swaps(self, name)
        files = files_with(self, name, keys, key)
        touched = self._read_at(files, name) if files else literal_table(self.spark, [], TABLES[name])
        merged = self._conform(merge_rows(touched, source, key), name)
        beside = f"{self.root}/_new-{self.prefix}{name}-{uuid.uuid4().hex}"
        try:
            self._store(merged, name, "errorifexists", path=beside)
        except Exception:
            fs, path = self._fs(beside)
            fs.delete(path, True)
            raise
        swap_files(self, name, beside, files)

    def snapshots_of(self, trigger: str) -> list[datetime]:
        """Snapshots a trigger has registered."""
        ids = self.read_or_empty("snapshot_registry").filter(F.col("triggered_by") == trigger)
        ids = ids.filter(F.col(_KEY).isNotNull()).select(F.col(_KEY).cast("string")).distinct()
        return [as_timestamp(r[0]) for r in ids.collect()]

    def delete_snapshots(self, name: str, trigger: str) -> list[datetime]:
        """Delete from a fact table the snapshots a trigger has registered."""
        doomed = self.snapshots_of(trigger)
        self._drop_snapshots(name, doomed)
        return doomed

    def forget_trigger(self, trigger: str) -> None:
        """Remove a trigger's rows from the registry."""
        ids = self.snapshots_of(trigger)
        if ids:
            log.append(self, log.superseding(self, ids, [trigger]), one_file=True)

    def delete_snapshots_by_source(self, name: str, trigger: str) -> list[datetime]:
        """Delete the snapshots a trigger registered, then its registry rows."""
        doomed = self.delete_snapshots(name, trigger)
        self.forget_trigger(trigger)
        return doomed

    # -- whole datasets ------------------------------------------------------------

    def mirror_dataset(self, target: "Warehouse", names: Iterable[str] | None = None) -> list[str]:
        """Copy every table to another warehouse, replacing what is there."""
        copied = list(names) if names is not None else self.tables()
        for name in copied:
            target._swap_in(target._conform(self.read(name), name), name, keep_if_empty=False)
            self._copied[target.path(name)] = target._last_digest
        return copied

    def verify_mirror(self, target: "Warehouse", names: Iterable[str] | None = None) -> DataFrame:
        """Per table: rows on both sides, whether schemas agree, and the verdict.

        Contents are compared by digests that don't depend on the order of
        rows.  That of a table this object has mirrored was taken while it was
        copied; other sources are scanned.
        """
        names = list(names) if names is not None else self.tables()
        known = [(n, *self._copied[target.path(n)]) for n in names if target.path(n) in self._copied]
        scanned = [n for n in names if target.path(n) not in self._copied]
        schema = "table string, rows bigint, hash_sum decimal(38), hash_xor bigint"
        empty = self.spark.createDataFrame(known, schema)
        source = reduce(DataFrame.unionByName, [_digest_row(self.read(n), n) for n in scanned], empty)
        stored = reduce(DataFrame.unionByName, [_digest_row(target.read_or_empty(n), n) for n in names])
        stored = stored.select("table", *[F.col(c).alias(f"_{c}") for c in DIGEST])
        same = literal_table(
            self.spark,
            [(n, _stored_schema(self, n) == _stored_schema(target, n)) for n in names],
            T.StructType([T.StructField("table", T.StringType()), T.StructField("schema_equal", T.BooleanType())]),
        )
        equal = (F.col("hash_sum") == F.col("_hash_sum")) & (F.col("hash_xor") == F.col("_hash_xor"))
        return (
            source.join(stored, "table")
            .join(same, "table")
            .select(
                "table",
                F.col("rows").alias("source_rows"),
                F.col("_rows").alias("target_rows"),
                "schema_equal",
                F.when(F.col("rows") != F.col("_rows"), "row count mismatch")
                .when(~equal, "content mismatch")
                .when(~F.col("schema_equal"), "schema mismatch")
                .otherwise("valid")
                .alias("verdict"),
            )
        )


def _digest_row(df: DataFrame, name: str) -> DataFrame:
    return digests(df).select(F.lit(name).alias("table"), *DIGEST)


def _stored_schema(warehouse: Warehouse, name: str) -> list[tuple[str, str]] | None:
    """Column names and types as found on disk."""
    if not warehouse.exists(name):
        return None
    disk = warehouse.spark.read.parquet(warehouse.path(name)).schema
    return sorted((f.name, f.dataType.simpleString()) for f in disk if not f.name.startswith("_"))


def _type(ddl: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def merge_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Result of an upsert: one full outer join on the text key, which the source has once, and the rows without a key."""
    target = target.withColumn(key, F.col(key).cast("string"))
    shared = [c for c in target.columns if c in source.columns and c != key]
    source = source.select(key, *shared)
    new = source.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in shared]
    )
    joined = target.filter(F.col(key).isNotNull()).join(new, F.col(key) == F.col("_key"), "full_outer")
    merged = joined.select(
        *[
            F.coalesce(key, "_key").alias(c)
            if c == key
            else F.when(F.col("_key").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in shared
            else F.col(c)
            for c in target.columns
        ]
    )
    unkeyed = target.filter(F.col(key).isNull())
    fresh = source.filter(F.col(key).isNull())
    return merged.unionByName(unkeyed).unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def table_counts(tables: Mapping[str, DataFrame], snapshot_id=None) -> DataFrame:
    """Rows per table in one job; fact tables limited to a snapshot when given."""

    def limited(name: str, df: DataFrame) -> DataFrame:
        if snapshot_id is None or name not in FACT_TABLES:
            return df
        return df.filter(F.col(_KEY) == as_timestamp(snapshot_id))

    return table_row_counts({name: limited(name, df) for name, df in tables.items()})


def as_timestamp(value) -> datetime:
    """UTC datetime of an identifier given as text or datetime; naive means UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def write_report(report: DataFrame, path: str) -> None:
    """Issues or summary rows as JSON lines."""
    report.write.mode("overwrite").json(path)

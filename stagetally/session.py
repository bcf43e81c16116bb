"""Session helpers: settings, small literal tables and the shared scratch folder."""

from __future__ import annotations

import atexit
import datetime as dt
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "timestamp": pa.timestamp("us", "UTC"),
    "array<string>": pa.list_(pa.string()),
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; leave sizing to the cluster and to AQE."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small constant table, its schema given as a type or as DDL text.

    Going through Arrow gives a LocalRelation, so the optimizer knows the exact
    size and picks a broadcast by itself; no hint is needed.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    rows = list(rows)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in schema])
    arrays = [
        pa.array([_utc(v) for v in values], field.type)
        for values, field in zip(columns, arrow)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def _utc(value):
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own, removed when Python ends; on a cluster a machine-local folder would be
    wrong, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="stagetally-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result outlives executors and its own inputs."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

"""Dated CSV exports whose headers drift from file to file.

Reading files with different headers in one call silently shifts columns, so
the exports are grouped by header first and each group is read with its own
schema.  The driver only ever holds one header line per export.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.functions.snapshots import file_date, format_snapshot_id
from stagetally.schemas import COMPANY_EXPORT_EVIDENCE, DEAL_EXPORT_EVIDENCE
from stagetally.sources.records import csv_records

MALFORMED = "malformed"
FILE_COLUMNS = ["export_file", "export_date", "exported_at", MALFORMED]
HEADER_CHARS = 1_000_000
_BOM = "\ufeff"


@dataclass(frozen=True)
class ExportGroup:
    """All exports of one kind that share one header."""

    kind: str | None
    columns: list[str]
    frame: DataFrame


def classify_export(file_name: str, columns: list[str]) -> str | None:
    """'company' or 'deal' by name keyword, else by the columns present."""
    name = file_name.lower()
    if "company" in name:
        return "company"
    if "deal" in name:
        return "deal"
    if all(c in columns for c in COMPANY_EXPORT_EVIDENCE):
        return "company"
    lowered = [c.lower() for c in columns]
    if sum(any(mark in c for c in lowered) for mark in DEAL_EXPORT_EVIDENCE) >= 2:
        return "deal"
    return None


def _below(spark: SparkSession, root: str, file_path: str) -> Column:
    """The entry directly below the root that a file belongs to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getRawPath().rstrip("/")
    inside = F.substring_index(F.col(file_path), f"/{folder.rsplit('/', 1)[-1]}/", -1)
    return F.substring_index(inside, "/", 1)


def export_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header record of every export; exports have one header in all their files.

    An export is one CSV file or a folder of part files.  Files are opened on
    the driver and read up to the end of their first record only; a record
    that is not closed within ``HEADER_CHARS`` is an error.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    depth = fs.makeQualified(root).depth()
    headers: dict[str, list[str]] = {}
    files = fs.listFiles(root, True)
    while files.hasNext():
        file = files.next().getPath()
        top = file
        while top.depth() > depth + 1:
            top = top.getParent()
        if not file.getName().endswith(".csv") or file.getName().startswith(("_", ".")):
            continue
        columns = next(csv.reader([_first_record(jvm, fs, file).lstrip(_BOM)]), [])
        if headers.setdefault(top.getName(), columns) != columns:
            raise ValueError(f"the files of export {top.getName()} have different headers")
    return headers


def _first_record(jvm, fs, file) -> str:
    """A file's first CSV record; quoted line breaks belong to it."""
    stream = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(file), "UTF-8"))
    try:
        record = stream.readLine() or ""
        while record.count('"') % 2:
            line = stream.readLine()
            if line is None or len(record) > HEADER_CHARS:
                raise ValueError(f"no complete header in {file.toString()}")
            record += "\n" + line
        return record
    finally:
        stream.close()


def read_export_groups(spark: SparkSession, path: str, multi_line: bool = True) -> list[ExportGroup]:
    """One group per (kind, header), every column read as text.

    Quoted fields may hold line breaks, and a large file is read by many tasks
    all the same; ``multi_line=False`` saves the shuffle that takes, for
    exports known to have none.  A record with too few or too many fields is
    kept as it stands in ``malformed``, which is NULL for all others.
    """
    headers = {name: tuple(columns) for name, columns in export_headers(spark, path).items()}
    grouped: dict[tuple, list[str]] = {}
    for name, columns in sorted(headers.items()):
        grouped.setdefault((classify_export(name, list(columns)), columns), []).append(name)
    groups = []
    for (kind, columns), names in grouped.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, MALFORMED)])
        paths = [f"{path.rstrip('/')}/{n}" for n in names]
        frame = _by_records(spark, paths, schema) if multi_line else _by_lines(spark, paths, schema)
        frame = frame.withColumn("export_file", _below(spark, path, "_path")).drop("_path")
        frame = frame.withColumn("export_date", file_date(F.col("export_file")))
        groups.append(ExportGroup(kind, list(columns), frame))
    return groups


def _by_lines(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Every line a record."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # else fields that no one reads would not be counted
        .option("recursiveFileLookup", True)
        .csv(paths)
        .withColumn("_path", F.col("_metadata.file_path"))
        .withColumn("exported_at", F.col("_metadata.file_modification_time"))
    )


def _by_records(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Records that may go over several lines; the first of each file is its header."""
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    ddl = ", ".join(f"{quoted(f.name)} STRING" for f in schema)
    options = {"escape": '"', "columnNameOfCorruptRecord": MALFORMED, "mode": "PERMISSIVE"}
    rows = csv_records(spark, paths).filter("number > 1")
    parsed = rows.select(F.from_csv("record", ddl, options).alias("r"), "path", "modified_at")
    return parsed.select(
        *[F.col("r").getField(f.name).alias(f.name) for f in schema],
        F.col("path").alias("_path"),
        F.col("modified_at").alias("exported_at"),
    )


def read_exports(spark: SparkSession, path: str, kind: str, multi_line: bool = True) -> DataFrame:
    """All rows of one kind, malformed ones too; columns a file lacks are NULL."""
    frames = [g.frame for g in read_export_groups(spark, path, multi_line) if g.kind == kind]
    if not frames:
        raise FileNotFoundError(f"no {kind} export below {path}")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def list_exports(spark: SparkSession, path: str) -> DataFrame:
    """Name and newest modification time of every export; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.groupBy(_below(spark, path, "path").alias("file_name")).agg(
        F.max("modificationTime").alias("modified_at")
    )


def pair_export_files(files: DataFrame) -> DataFrame:
    """Dates that have both a company and a deal file, with their snapshot id.

    ``files`` needs ``file_name`` and ``modified_at``.  The snapshot id is the
    earlier of the two modification times, to the second.  When a date has
    several files of a kind the last name wins.
    """
    name = F.lower("file_name")
    is_company = name.contains("company")
    is_deal = ~is_company & name.contains("deal")
    stamp = format_snapshot_id(F.col("modified_at"))

    def last(which, value):
        return F.max_by(value, F.when(which, F.col("file_name")))

    return (
        files.withColumn("export_date", file_date(F.col("file_name")))
        .filter(F.col("export_date").isNotNull())
        .groupBy("export_date")
        .agg(
            F.max(F.when(is_company, F.col("file_name"))).alias("company_file"),
            F.max(F.when(is_deal, F.col("file_name"))).alias("deals_file"),
            last(is_company, stamp).alias("company_timestamp"),
            last(is_deal, stamp).alias("deals_timestamp"),
        )
        .filter("company_file IS NOT NULL AND deals_file IS NOT NULL")
        .withColumn("snapshot_id", F.least("company_timestamp", "deals_timestamp"))
    )

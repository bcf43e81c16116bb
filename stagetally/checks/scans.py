"""Sources and sinks (survey section 2.1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.checks.base import AS_OF, SNAPSHOT, Bed, check, ts
from stagetally.operators import registry as log
from stagetally.schemas import COMPANY_PROPERTIES, DEAL_ASSOCIATIONS
from stagetally.sources import exports, landing
from stagetally.sources.warehouse import as_timestamp, table_counts, write_report


def _stamp():
    return F.lit(AS_OF).cast("timestamp")


PAGE_SIZE = 100

# What a landed company looks like: source property -> derived column.
_LANDED = COMPANY_PROPERTIES | {"owner_id": "owner_id"}


def landed_companies(bed: Bed) -> str:
    """Object pages of one snapshot's companies, written as JSON lines."""
    rows = bed.companies.filter(F.col("snapshot_id") == F.lit(SNAPSHOT).cast("timestamp"))
    prop = F.create_map(*[x for s, t in _LANDED.items() for x in (F.lit(s), F.col(t))])
    key = F.col("company_id").cast("bigint")
    record = F.struct(F.col("company_id").alias("id"), prop.alias("properties"))
    return _write_pages(bed, rows, key, record, "landed-companies")


def landed_deals(bed: Bed) -> str:
    """Object pages of all deals; a deal links to none, one or two companies."""
    key = F.col("o_orderkey")
    prop = F.create_map(
        F.lit("dealname"), F.concat(F.lit("Deal "), key.cast("string")),
        F.lit("dealstage"), F.upper("o_orderpriority"),
        F.lit("amount"), F.when(key % 17 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")),
    )
    first = F.struct(F.col("o_custkey").cast("string").alias("id"))
    second = F.struct((F.col("o_custkey") + 1).cast("string").alias("id"))
    ids = (
        F.when(key % 3 == 0, F.array(first))
        .when(key % 3 == 1, F.array(first, second))
        .otherwise(F.array().cast("array<struct<id:string>>"))
    )
    links = F.when(key % 5 > 0, F.create_map(F.lit("companies"), F.struct(ids.alias("results"))))
    record = F.struct(
        key.cast("string").alias("id"), prop.alias("properties"), links.alias("associations")
    )
    return _write_pages(bed, bed.table("orders"), key, record, "landed-deals")


def _write_pages(bed: Bed, rows: DataFrame, key, record, label: str) -> str:
    path = bed.scratch(label)
    pages = rows.groupBy(F.floor(key / PAGE_SIZE).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(key.alias("k"), F.to_json(record).alias("r")))).alias("rs")
    )
    body = F.array_join(F.transform("rs", lambda r: r.getField("r")), ",")
    pages.select(F.concat(F.lit('{"results":['), body, F.lit("]}")).alias("value")).write.text(path)
    return path


def landed_owners(bed: Bed) -> str:
    key = F.col("s_suppkey")
    owner = F.to_json(
        F.struct(
            key.cast("string").alias("id"),
            F.concat(F.lit(" "), F.col("s_name"), F.lit("@Example.COM ")).alias("email"),
            F.col("s_name").alias("firstName"),
            F.when(key % 2 == 0, "Ray").alias("lastName"),
            F.when(key % 4 == 0, 0).when(key % 4 > 1, key).alias("userId"),
            F.when(key % 3 == 0, F.lit(True)).when(key % 3 == 1, F.lit(False)).alias("active"),
            F.lit("2024-01-01T00:00:00Z").alias("createdAt"),
            F.when(key % 5 == 0, "2024-02-02T03:04:05.678Z").when(key % 5 == 1, "").alias("updatedAt"),
        )
    )
    path = bed.scratch("landed-owners")
    pages = bed.table("supplier").groupBy(F.floor(key / PAGE_SIZE)).agg(F.collect_list(owner).alias("o"))
    pages.select(
        F.concat(F.lit('{"results":['), F.array_join("o", ","), F.lit("]}")).alias("value")
    ).write.text(path)
    return path


def landed_stages(bed: Bed) -> str:
    """Stage lists built from parts: a list per brand, a stage per part."""
    key = F.col("p_partkey")
    closed = F.when(key % 4 == 0, '"True"').when(key % 4 == 1, "true").when(key % 4 == 2, '"false"')
    stage = F.concat(
        F.lit('{"id":"'), key.cast("string"),
        F.lit('","label":"'), F.col("p_name"), F.lit('"'),
        F.when(key % 3 > 0, F.concat(F.lit(',"displayOrder":'), F.col("p_size").cast("string"))).otherwise(""),
        F.lit(',"metadata":{"probability":"'), (F.col("p_size") / 100).cast("string"), F.lit('"'),
        F.coalesce(F.concat(F.lit(',"isClosed":'), closed), F.lit("")), F.lit("}}"),
    )
    # A group per brand and thousand parts keeps every written line small.
    pages = bed.table("part").groupBy("p_brand", F.floor(key / 1000)).agg(F.collect_list(stage).alias("s"))
    path = bed.scratch("landed-stages")
    pages.select(
        F.concat(
            F.lit('{"results":[{"id":"'), F.lower("p_brand"), F.lit('","label":"'), "p_brand",
            F.lit('","stages":['), F.array_join("s", ","), F.lit("]}]}"),
        ).alias("value")
    ).write.text(path)
    return path


_COMPANY_2000 = "SELECT * FROM companies WHERE snapshot_id = TIMESTAMP '2000-01-01'"


@check("S01", f"""
SELECT company_id AS id, CAST(CAST(company_id AS BIGINT) % {PAGE_SIZE} AS BIGINT) AS position,
       company_name, lifecycle_stage, proff_link
FROM ({_COMPANY_2000})""")
def read_object_pages(bed: Bed) -> DataFrame:
    rows = landing.read_object_pages(bed.spark, landed_companies(bed))
    prop = F.col("properties")
    return rows.select(
        "id", "position",
        prop["name"].alias("company_name"),
        prop["lifecyclestage"].alias("lifecycle_stage"),
        prop["proff_link"].alias("proff_link"),
    )


@check("S02", f"""
SELECT company_id, company_name, lifecycle_stage, lead_status, owner_id, company_type, development_category,
       hiring_developers, inhouse_developers, proff_likviditetsgrad, proff_link, proff_lonnsomhet, proff_soliditet,
       {ts("snapshot_id")}, '2024-01-01 00:00:00.000000' AS record_timestamp
FROM ({_COMPANY_2000})""")
def project_properties(bed: Bed) -> DataFrame:
    pages = landing.read_object_pages(bed.spark, landed_companies(bed))
    return landing.project_properties(
        pages, "companies", "company_id", _LANDED, F.lit(SNAPSHOT).cast("timestamp"), _stamp()
    )


@check("S03", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 < 2 THEN CAST(o_custkey AS VARCHAR) END AS associated_company_id,
       CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 2 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR)
            ELSE concat(CAST(o_custkey AS VARCHAR), '|', CAST(o_custkey + 1 AS VARCHAR)) END AS all_companies
FROM orders""")
def resolve_associations(bed: Bed) -> DataFrame:
    pages = landing.read_object_pages(bed.spark, landed_deals(bed))
    one = landing.resolve_associations(pages, DEAL_ASSOCIATIONS)
    both = landing.resolve_associations(one, {"companies": ("all_companies", "multiple")})
    return both.select("id", "associated_company_id", "all_companies")


@check("S04", """
SELECT CAST(s_suppkey AS VARCHAR) AS owner_id, lower(concat(s_name, '@example.com')) AS email, s_name AS first_name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Ray' END AS last_name,
       CASE WHEN s_suppkey % 4 > 1 THEN CAST(s_suppkey AS VARCHAR) END AS user_id,
       s_suppkey % 3 = 0 AS active,
       CASE WHEN s_suppkey % 5 = 0 THEN '2024-02-02 03:04:05.678000' ELSE '2024-01-01 00:00:00.000000' END AS record_timestamp
FROM supplier""")
def read_owners(bed: Bed) -> DataFrame:
    return landing.read_owners(bed.spark, landed_owners(bed))


@check("S05", """
SELECT lower(p_brand) AS pipeline_id, p_brand AS pipeline_label, CAST(p_partkey AS VARCHAR) AS stage_id, p_name AS stage_label,
       p_partkey % 4 < 2 AS is_closed, p_size / 100 AS probability,
       CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS BIGINT) ELSE 0 END AS display_order,
       '2024-01-01 00:00:00.000000' AS record_timestamp
FROM part""")
def flatten_deal_stages(bed: Bed) -> DataFrame:
    return landing.flatten_deal_stages(bed.spark, landed_stages(bed), _stamp())


DEAL_EXPORTS = [
    # (folder, filter, extra columns): three header variants, as dated exports have.
    ("export-deals-2025-03-12.csv", "o_orderkey % 3 = 0", []),
    ("export-deals-2025-06-01.csv", "o_orderkey % 3 = 1", ["Associated Company IDs (Primary)"]),
    (
        "export-deals-2025-06-08.csv",
        "o_orderkey % 3 = 2",
        ["Associated Company (Primary)", "Associated Company IDs (Primary)"],
    ),
]
COMPANY_EXPORTS = [("export-company-2025-03-12.csv", 0), ("export-company-2025-06-08.csv", 1)]


def written_exports(bed: Bed) -> str:
    """Deal and company exports as CSV folders with drifting headers."""
    path = bed.scratch("exports")
    orders = bed.table("orders")
    extra = {
        "Associated Company (Primary)": F.concat(F.lit("Company, "), F.col("o_custkey").cast("string")),
        "Associated Company IDs (Primary)": F.col("o_custkey").cast("string"),
    }
    for name, which, added in DEAL_EXPORTS:
        orders.filter(which).select(
            F.col("o_orderkey").cast("string").alias("Record ID"),
            F.concat(F.lit("Deal, no "), F.col("o_orderkey").cast("string")).alias("Deal Name"),
            F.col("o_orderpriority").alias("Deal Stage"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("Close Date"),
            F.concat(F.lit("Nation_"), (F.col("o_custkey") % 25).cast("string")).alias("Deal owner"),
            F.concat(F.lit("kr "), F.col("o_totalprice").cast("string")).alias("Amount"),
            F.col("o_orderstatus").alias("Deal Type"),
            *[extra[c].alias(c) for c in added],
        ).write.option("header", True).csv(f"{path}/{name}")
    for name, part in COMPANY_EXPORTS:
        bed.table("customer").filter(F.col("c_custkey") % 2 == part).select(
            F.when(F.col("c_custkey") % 50 > 1, F.col("c_custkey").cast("string")).alias("Record ID"),
            F.col("c_name").alias("Company name"),
            F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("Company owner"),
            F.when(F.col("c_custkey") % 7 == 0, " Sales Qualified Lead")
            .otherwise(F.initcap("c_mktsegment"))
            .alias("Lifecycle Stage"),
            F.when(F.col("c_custkey") % 3 == 0, "Attempted to contact").alias("Lead Status"),
            F.lit("Prospect").alias("Type"),
        ).write.option("header", True).csv(f"{path}/{name}")
    return path


def set_modified(bed: Bed, path: str, part: str, at: str) -> None:
    """Give the files of the exports whose name holds a text a modification time."""
    jvm = bed.spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(bed.spark._jsparkSession.sessionState().newHadoopConf())
    files = fs.listFiles(root, True)
    while files.hasNext():
        file = files.next().getPath()
        if part in file.toString():
            fs.setTimes(file, int(as_timestamp(at).timestamp() * 1000), -1)


_EXPORT_DAY = (
    "CASE o_orderkey % 3 WHEN 0 THEN '2025-03-12' WHEN 1 THEN '2025-06-01' ELSE '2025-06-08' END"
)


@check("S06", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, concat('Deal, no ', o_orderkey) AS deal_name,
       concat('kr ', o_totalprice) AS amount,
       CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS VARCHAR) END AS company_ids,
       CASE WHEN o_orderkey % 3 = 2 THEN concat('Company, ', o_custkey) END AS company,
       {_EXPORT_DAY} AS export_date
FROM orders""")
def read_exports(bed: Bed) -> DataFrame:
    rows = exports.read_exports(bed.spark, written_exports(bed), "deal")
    return rows.select(
        F.col("Record ID").alias("deal_id"),
        F.col("Deal Name").alias("deal_name"),
        F.col("Amount").alias("amount"),
        F.col("`Associated Company IDs (Primary)`").alias("company_ids"),
        F.col("`Associated Company (Primary)`").alias("company"),
        "export_date",
    )


def export_files(bed: Bed) -> DataFrame:
    """A listing of export files, one per order, four kinds of name."""
    key = F.col("o_orderkey")
    kind = F.when(key % 7 < 3, "Company").when(key % 7 < 6, "deals").otherwise("notes")
    day = F.when(key % 11 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("undated")
    return bed.table("orders").select(
        F.concat(F.lit("export-"), kind, F.lit("-"), day, F.lit("-"), F.lpad(key.cast("string"), 12, "0"),
                 F.lit(".csv")).alias("file_name"),
        (F.col("o_orderdate").cast("timestamp") + F.make_interval(mins=(key % 1000).cast("int"))).alias("modified_at"),
    )


FILE_PAIRS_SQL = """(
  SELECT day AS export_date,
         max(name) FILTER (WHERE kind = 'Company') AS company_file,
         max(name) FILTER (WHERE kind = 'deals') AS deals_file,
         arg_max(stamp, name) FILTER (WHERE kind = 'Company') AS company_timestamp,
         arg_max(stamp, name) FILTER (WHERE kind = 'deals') AS deals_timestamp
  FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day,
               CASE WHEN o_orderkey % 7 < 3 THEN 'Company' WHEN o_orderkey % 7 < 6 THEN 'deals' ELSE 'notes' END AS kind,
               concat('export-', kind, '-', day, '-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), '.csv') AS name,
               strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1000 AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS stamp
        FROM orders WHERE o_orderkey % 11 > 0) f
  GROUP BY day)"""


@check("S07", f"""
SELECT *, least(company_timestamp, deals_timestamp) AS snapshot_id
FROM {FILE_PAIRS_SQL} WHERE company_file IS NOT NULL AND deals_file IS NOT NULL""")
def pair_export_files(bed: Bed) -> DataFrame:
    return exports.pair_export_files(export_files(bed))


@check("S09", f"""
SELECT deal_id, deal_name, amount, {ts("snapshot_id")}, CAST(n AS BIGINT) AS copies
FROM deals CROSS JOIN (SELECT 2 AS n) x""")
def append_table(bed: Bed) -> DataFrame:
    """Appending twice keeps both copies, with ids stored as text."""
    wh = bed.warehouse()
    rows = bed.deals.withColumn("deal_id", F.col("deal_id").cast("bigint"))
    wh.append_table(rows, "deals")
    wh.append_table(rows, "deals")
    return (
        wh.read("deals")
        .groupBy("deal_id", "deal_name", "amount", "snapshot_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@check("S10", "SELECT owner_id, email, first_name, last_name, user_id, active FROM reps")
def replace_table(bed: Bed) -> DataFrame:
    """Replaced once by other rows, then by nothing, which changes nothing."""
    wh = bed.warehouse("owners")
    wh.replace_table(bed.reps, "owners")
    wh.replace_table(bed.reps.filter("false"), "owners")
    return wh.read("owners").drop("record_timestamp")


_UPSERT_SQL = """
SELECT CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS owner_id,
       concat('new', s_suppkey) AS email, s_name AS first_name,
       CASE WHEN s_suppkey % 3 = 0 THEN r.last_name END AS last_name,
       CASE WHEN s_suppkey % 3 = 0 THEN r.user_id END AS user_id,
       CASE WHEN s_suppkey % 3 = 0 THEN r.active END AS active
FROM supplier LEFT JOIN reps r ON r.owner_id = CAST(s_suppkey AS VARCHAR)
UNION ALL
SELECT owner_id, email, first_name, last_name, user_id, active FROM reps
WHERE CAST(owner_id AS BIGINT) % 3 = 1"""


@check("S11", _UPSERT_SQL)
def upsert_table(bed: Bed) -> DataFrame:
    """A third of the keys matched, a third new rows without key, a third new keys."""
    wh = bed.warehouse()
    stored = bed.reps.filter(F.col("owner_id").cast("bigint") % 3 != 2)
    wh.append_table(stored, "owners")
    key = F.col("s_suppkey")
    source = bed.table("supplier").select(
        F.when(key % 3 != 1, key).alias("owner_id"),
        F.concat(F.lit("new"), key.cast("string")).alias("email"),
        F.col("s_name").alias("first_name"),
    )
    wh.upsert_table(source, "owners", "owner_id")
    return wh.read("owners").drop("record_timestamp")


@check("S12", """
SELECT strftime(snapshot_id, '%Y') AS year, count(*) AS deals, round(sum(amount), 2) AS amount
FROM (SELECT snapshot_id, amount FROM deals WHERE snapshot_id NOT IN (TIMESTAMP '1999-01-01', TIMESTAMP '2000-01-01')
      UNION ALL SELECT snapshot_id, amount * 2 FROM deals WHERE snapshot_id = TIMESTAMP '2000-01-01')
GROUP BY 1""")
def replace_snapshot(bed: Bed) -> DataFrame:
    """One snapshot replaced, one cleared by an empty result, the others untouched."""
    wh = bed.warehouse("deals")
    doubled = bed.deals.withColumn("amount", F.col("amount") * 2)
    wh.replace_snapshot(doubled.filter("snapshot_id = '2000-01-01'"), "deals", SNAPSHOT)
    wh.replace_snapshot(doubled.filter("false"), "deals", "1999-01-01T00:00:00Z")
    return (
        wh.read("deals")
        .groupBy(F.date_format("snapshot_id", "yyyy").alias("year"))
        .agg(F.count(F.lit(1)).alias("deals"), F.round(F.sum("amount"), 2).alias("amount"))
    )


@check("S13", """
SELECT 'deals' AS "table", count(*) AS "rows" FROM deals
WHERE snapshot_id NOT IN (SELECT snapshot_id FROM year_registry WHERE triggered_by = 'manual' AND user_id < 20)
UNION ALL
SELECT 'snapshot_registry', count(*) FROM year_registry WHERE NOT (triggered_by = 'manual' AND user_id < 20)
""".replace("year_registry WHERE", "(SELECT r.*, e.user_id FROM year_registry r JOIN events e ON e.ts = r.record_timestamp AND e.props = r.notes) WHERE"))
def delete_snapshots_by_source(bed: Bed) -> DataFrame:
    """Snapshots registered by one trigger are gone, and so are its log rows."""
    wh = bed.warehouse("deals")
    marked = bed.table("events").select("ts", "props", "user_id")
    log_rows = bed.year_registry.join(
        marked, (F.col("record_timestamp") == F.col("ts").cast("timestamp")) & (F.col("notes") == F.col("props"))
    )
    chosen = (F.col("triggered_by") == "manual") & (F.col("user_id") < 20)
    wh.append_table(
        log_rows.withColumn("triggered_by", F.when(chosen, log.MIGRATION).otherwise(F.col("triggered_by"))),
        "snapshot_registry",
    )
    wh.delete_snapshots_by_source("deals", log.MIGRATION)
    return table_counts({n: wh.read(n) for n in ("deals", "snapshot_registry")})


_MIRRORED = ["companies", "deals", "owners", "snapshot_registry"]
_COUNTS = {"companies": "companies", "deals": "deals", "owners": "owners", "snapshot_registry": "year_registry"}


@check("S17", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS \"rows\" FROM {t}" for n, t in _COUNTS.items()))
def mirror_dataset(bed: Bed) -> DataFrame:
    wh, copy = bed.warehouse(*_MIRRORED), bed.warehouse()
    wh.mirror_dataset(copy)
    return table_counts({n: copy.read(n) for n in copy.tables()})


@check("S18", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS source_rows, "
    f"count(*) + {'(SELECT count(*) FROM deals)' if n == 'deals' else '0'} AS target_rows, "
    f"TRUE AS schema_equal, '{'row count mismatch' if n == 'deals' else 'valid'}' AS verdict FROM {t}"
    for n, t in _COUNTS.items()))
def verify_mirror(bed: Bed) -> DataFrame:
    """A faithful copy except for one table that was loaded twice."""
    wh, copy = bed.warehouse(*_MIRRORED), bed.warehouse()
    wh.mirror_dataset(copy)
    copy.append_table(bed.deals, "deals")
    return wh.verify_mirror(copy)


@check("S19", """
SELECT 'deals' AS "table", 'deal_stage' AS field, deal_stage AS mixed_case_value, count(*) AS record_count
FROM deals WHERE deal_stage <> lower(deal_stage) GROUP BY deal_stage""")
def stored_report(bed: Bed) -> DataFrame:
    """Report rows written as JSON and read back."""
    path = bed.scratch("report")
    mixed = bed.deals.filter(F.col("deal_stage") != F.lower("deal_stage"))
    write_report(
        mixed.groupBy(
            F.lit("deals").alias("table"),
            F.lit("deal_stage").alias("field"),
            F.col("deal_stage").alias("mixed_case_value"),
        ).agg(F.count(F.lit(1)).alias("record_count")),
        path,
    )
    return bed.spark.read.schema(
        "table string, field string, mixed_case_value string, record_count bigint"
    ).json(path)


@check("S20", f"SELECT company_id, company_name, lifecycle_stage, {ts('snapshot_id')} FROM ({_COMPANY_2000})")
def read_table_for_snapshot(bed: Bed) -> DataFrame:
    rows = bed.warehouse("companies").read_table_for_snapshot("companies", SNAPSHOT)
    return rows.select("company_id", "company_name", "lifecycle_stage", "snapshot_id")

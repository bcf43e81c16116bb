"""Projections, filters and joins (survey sections 2.2 and 2.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagetally.checks.base import AS_OF, Bed, check, ts
from stagetally.checks.scans import FILE_PAIRS_SQL, export_files
from stagetally.operators import alignment, exports, history, integrity, profiles, registry, scoring
from stagetally.plans.report import enriched_units
from stagetally.schemas import DEALS
from stagetally.sources.exports import pair_export_files
from stagetally.sources.warehouse import table_counts

_UNIT_ROWS = f"""company_id, deal_id, owner_id, lifecycle_stage, lead_status, deal_stage, combined_stage, stage_level,
  adjusted_score, stage_source, {ts("snapshot_id")}, {ts("record_timestamp")}"""


# -- projections and filters -----------------------------------------------------------------


@check("F01", "SELECT combined_stage, count(*) AS units FROM staged GROUP BY combined_stage")
def combined_stage(bed: Bed) -> DataFrame:
    units = scoring.staged_units(bed.companies, bed.deals, bed.stages)
    return units.groupBy("combined_stage").agg(F.count(F.lit(1)).alias("units"))


@check("F02", "SELECT stage_source, count(*) AS units FROM staged GROUP BY stage_source")
def stage_source(bed: Bed) -> DataFrame:
    units = scoring.staged_units(bed.companies, bed.deals, bed.stages)
    return units.groupBy("stage_source").agg(F.count(F.lit(1)).alias("units"))


@check("F03", """SELECT lifecycle_stage, lead_status, deal_stage, CAST(normalization_applied AS BIGINT) AS normalization_applied,
  count(*) AS units FROM staged GROUP BY ALL""")
def normalization_applied(bed: Bed) -> DataFrame:
    units = scoring.staged_units(bed.companies, bed.deals, bed.stages)
    keys = ["lifecycle_stage", "lead_status", "deal_stage", "normalization_applied"]
    return units.groupBy(*keys).agg(F.count(F.lit(1)).alias("units"))


@check("F04", f"SELECT deal_id, associated_company_id, {ts('snapshot_id')}, stage AS deal_stage, CAST((given_stage <> stage) IS TRUE AS BIGINT) AS deal_flag FROM tidy_deals")
def open_deals(bed: Bed) -> DataFrame:
    return scoring.prepared_deals(bed.deals, bed.stages)


@check("F05", """SELECT stage_level, count(*) AS units, sum(adjusted_score) AS score
FROM units WHERE stage_level NOT IN (-1, 9) GROUP BY stage_level""")
def active_units(bed: Bed) -> DataFrame:
    return scoring.active_units(bed.units).groupBy("stage_level").agg(
        F.count(F.lit(1)).alias("units"), F.sum("adjusted_score").alias("score")
    )


def _foreign_deals(bed: Bed) -> DataFrame:
    """Deals of an older layout: numeric ids, text amounts, other names."""
    key = F.col("o_orderkey")
    return bed.table("orders").select(
        key.alias("deal_id"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("deal_stage"),
        F.when(key % 13 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(key % 7 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("owner_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("close_date"),
        F.col("o_orderstatus").alias("not_in_target"),
    )


_FOREIGN = """
  CAST(o_orderkey AS VARCHAR) AS deal_id, CAST(NULL AS VARCHAR) AS deal_name, {stage} AS deal_stage,
  CAST(NULL AS VARCHAR) AS deal_type, CASE WHEN o_orderkey % 13 > 0 THEN o_totalprice END AS amount,
  {owner} AS owner_id, CAST(NULL AS VARCHAR) AS associated_company_id"""
_STAMPS = ", '2025-06-08 06:00:00.000000' AS snapshot_id, '2024-01-01 00:00:00.000000' AS record_timestamp"


def _constants():
    return {
        "snapshot_id": F.lit("2025-06-08T06:00:00Z").cast("timestamp"),
        "record_timestamp": F.lit(AS_OF).cast("timestamp"),
    }


@check("F06", "SELECT " + _FOREIGN.format(
    stage="lower(trim(o_orderpriority))",
    owner="CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey AS VARCHAR) END") + _STAMPS + " FROM orders")
def align_to_schema(bed: Bed) -> DataFrame:
    return alignment.align_to_schema(_foreign_deals(bed), DEALS, _constants())


@check("F07", "SELECT " + _FOREIGN.format(
    stage="concat(' ', o_orderpriority, ' ')",
    owner="CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END") + _STAMPS
    + ", strftime(o_orderdate, '%Y-%m-%d') AS closedate, CAST(NULL AS VARCHAR) AS createdate FROM orders")
def align_with_alternatives(bed: Bed) -> DataFrame:
    target = StructType(list(DEALS.fields)).add("closedate", "string").add("createdate", "string")
    return alignment.align_with_alternatives(_foreign_deals(bed), target, _constants())


@check("F08", f"""
SELECT nullif(trim(CAST(c_custkey AS VARCHAR)), '') AS company_id, c_name AS company_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'salesqualifiedlead' ELSE lower(c_mktsegment) END AS lifecycle_stage,
       CASE WHEN c_custkey % 2 = 0 THEN 'attempted_to_contact' END AS lead_status,
       CASE WHEN c_custkey % 5 > 0 THEN concat('n', c_nationkey) END AS owner_id,
       CASE WHEN c_custkey % 3 > 0 THEN 'prospect' END AS company_type,
       CAST(NULL AS VARCHAR) AS development_category, CAST(NULL AS VARCHAR) AS hiring_developers,
       CAST(NULL AS VARCHAR) AS inhouse_developers, CAST(NULL AS VARCHAR) AS proff_likviditetsgrad,
       concat('https://www.example.com/c/', c_custkey) AS proff_link,
       CASE WHEN c_custkey % 4 = 0 THEN 'god' END AS proff_lonnsomhet, CAST(NULL AS VARCHAR) AS proff_soliditet
       {_STAMPS} FROM customer""")
def map_export_company(bed: Bed) -> DataFrame:
    key = F.col("c_custkey")
    rows = bed.table("customer").select(
        key.alias("Record ID"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias("Company name"),
        F.when(key % 5 > 0, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).otherwise(" ").alias("Company owner"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Sales Qualified Lead").otherwise(F.col("c_mktsegment")).alias("Lifecycle Stage"),
        F.when(key % 2 == 0, " Attempted to Contact").alias("Lead Status"),
        F.when(key % 3 > 0, "Prospect ").otherwise("").alias("Type"),
        F.concat(F.lit("HTTPS://WWW.Example.com/C/"), key.cast("string")).alias("Proff Link"),
        F.when(key % 4 == 0, "God").alias("Proff Lønnsomhet"),
    )
    stamps = _constants()
    return exports.map_export_company(rows, stamps["snapshot_id"], stamps["record_timestamp"])


@check("F09", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, concat('Deal ', o_orderkey) AS deal_name, lower(o_orderpriority) AS deal_stage,
       lower(o_orderstatus) AS deal_type, CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END AS amount,
       CASE WHEN o_orderkey % 4 > 0 THEN concat('owner ', o_custkey) END AS owner_id,
       CASE WHEN o_orderkey % 8 > 0 THEN CAST(o_custkey AS VARCHAR) END AS associated_company_id
       {_STAMPS} FROM orders""")
def map_export_deal(bed: Bed) -> DataFrame:
    """Header variant in which three columns are only found by similarity."""
    key = F.col("o_orderkey")
    rows = bed.table("orders").select(
        key.cast("string").alias("Record ID"),
        F.concat(F.lit("Deal "), key.cast("string")).alias("DEAL NAME"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("Deal Stage"),
        F.when(key % 4 > 0, F.concat(F.lit("owner "), F.col("o_custkey").cast("string"))).otherwise("  ").alias("Deal owner"),
        F.when(key % 9 > 0, F.concat(F.lit("kr "), F.col("o_totalprice").cast("string"))).otherwise("tbd").alias("Amount"),
        F.col("o_orderstatus").alias("Deal Type"),
        F.when(key % 8 > 0, F.col("o_custkey").cast("string")).otherwise("").alias("Associated Company IDs (Primary)"),
    )
    stamps = _constants()
    return exports.map_export_deal(rows, stamps["snapshot_id"], stamps["record_timestamp"])


@check("F11", """SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_name AS company_name FROM customer
WHERE c_custkey % 5 > 0 AND c_custkey % 7 > 0""")
def drop_empty_rows(bed: Bed) -> DataFrame:
    key = F.col("c_custkey")
    rows = bed.table("customer").select(
        F.when((key % 5 > 0) & (key % 7 > 0), key.cast("string")).alias("record_id"),
        F.when(key % 5 > 0, F.col("c_name")).alias("company_name"),
    )
    return exports.drop_empty_rows(rows)


@check("F12", """
WITH source(field, source_type, n) AS (
  SELECT 'deal_id', 'bigint', count(o_orderkey) FROM orders UNION ALL
  SELECT 'deal_stage', 'string', count(o_orderpriority) FROM orders UNION ALL
  SELECT 'amount', 'string', count(o_totalprice) FROM orders UNION ALL
  SELECT 'owner_id', 'string', count(o_custkey) FROM orders UNION ALL
  SELECT 'close_date', 'string', count(o_orderdate) FROM orders UNION ALL
  SELECT 'not_in_target', 'string', count(o_orderstatus) FROM orders),
target(field, target_type) AS (VALUES
  ('deal_id', 'string'), ('deal_name', 'string'), ('deal_stage', 'string'), ('deal_type', 'string'), ('amount', 'double'),
  ('owner_id', 'string'), ('associated_company_id', 'string'), ('snapshot_id', 'timestamp'), ('record_timestamp', 'timestamp'))
SELECT field, source_type, target_type,
       CASE WHEN target_type IS NULL THEN 'missing' WHEN source_type IS NULL THEN 'extra'
            WHEN source_type <> target_type THEN 'type mismatch' ELSE 'same' END AS difference,
       (source_type IS NULL OR (target_type IS NOT NULL AND source_type = target_type)) AS compatible,
       coalesce(n, 0) AS rows_with_value
FROM source FULL OUTER JOIN target USING (field)""".replace("WITH source", ", source", 1))
def schema_diff(bed: Bed) -> DataFrame:
    """The comparison, with how many source rows each field would carry over."""
    source = _foreign_deals(bed)
    diff = alignment.schema_diff(bed.spark, source.schema, DEALS)
    filled = profiles.completeness(source, source.columns).select("field", F.col("non_null").alias("rows_with_value"))
    return diff.join(filled, "field", "left").na.fill(0, ["rows_with_value"])


@check("F14", """
SELECT *, snapshot_companies > 0 AND snapshot_deals > 0 AND owners_data > 0 AND deal_stages_data > 0 AS all_present FROM (
SELECT (SELECT count(*) FROM companies WHERE snapshot_id = TIMESTAMP '2000-01-01') AS snapshot_companies,
       (SELECT count(*) FROM deals WHERE snapshot_id = TIMESTAMP '2000-01-01') AS snapshot_deals,
       (SELECT count(*) FROM owners) AS owners_data, (SELECT count(*) FROM stages) AS deal_stages_data) n""")
def required_data_exists(bed: Bed) -> DataFrame:
    at = F.col("snapshot_id") == F.lit("2000-01-01").cast("timestamp")
    return profiles.required_data_exists(bed.companies.filter(at), bed.deals.filter(at), bed.owners, bed.stages)


@check("F14", f"""SELECT {ts("snapshot_id")}, count(*) FILTER (WHERE kind = 'c') AS snapshot_companies, count(*) FILTER (WHERE kind = 'd') AS snapshot_deals,
(SELECT count(*) FROM reps) AS owners_data, (SELECT count(*) FROM stages) AS deal_stages_data,
count(*) FILTER (WHERE kind = 'c') > 0 AND count(*) FILTER (WHERE kind = 'd') > 0 AS all_present
FROM (SELECT snapshot_id, 'r' AS kind FROM year_registry UNION ALL
  SELECT snapshot_id, 'c' FROM companies WHERE snapshot_id IN (SELECT snapshot_id FROM year_registry) UNION ALL
  SELECT snapshot_id, 'd' FROM deals WHERE snapshot_id IN (SELECT snapshot_id FROM year_registry)) x GROUP BY snapshot_id""")
def required_data_per_snapshot(bed: Bed) -> DataFrame:
    """The verdict that gates scoring, for every registered snapshot."""
    return profiles.required_data_per_snapshot(bed.year_registry, bed.companies, bed.deals, bed.reps, bed.stages)


_REQUIRED = ["companies", "deals", "contacts"]


@check("F14", """SELECT t AS "table", t <> 'contacts' AS present, CASE t WHEN 'companies' THEN (SELECT count(*) FROM companies)
WHEN 'deals' THEN (SELECT count(*) FROM deals) END AS records FROM (VALUES ('companies'), ('deals'), ('contacts')) v(t)""")
def required_tables_present(bed: Bed) -> DataFrame:
    """Which required tables a stored warehouse has, and their rows."""
    wh = bed.warehouse("companies", "deals")
    found = alignment.required_tables_present(bed.spark, wh.tables(), _REQUIRED)
    counts = table_counts({t: wh.read(t) for t in wh.tables()}).withColumnRenamed("rows", "records")
    return found.join(counts, "table", "left")


# -- joins ---------------------------------------------------------------------------------------


@check("J01", """SELECT d.deal_id, d.deal_stage, r.is_closed FROM deals d LEFT JOIN stages r
ON lower(d.deal_stage) = lower(r.stage_id)""")
def deals_with_stage_reference(bed: Bed) -> DataFrame:
    return scoring.deals_with_stage(bed.deals, bed.stages).select("deal_id", "deal_stage", "is_closed")


@check("J02", f"SELECT company_id, deal_id, {ts('snapshot_id')} FROM staged")
def companies_with_open_deals(bed: Bed) -> DataFrame:
    deals = scoring.prepared_deals(bed.deals, bed.stages)
    joined = scoring.companies_with_deals(
        scoring.prepared_companies(bed.companies), deals, scoring.heavy_companies(deals, least_rows=50_000)
    )
    return joined.select("company_id", "deal_id", "snapshot_id")


@check("J03", f"SELECT {_UNIT_ROWS} FROM units")
def units_with_stage_mapping(bed: Bed) -> DataFrame:
    """Scored units; stages listed twice in the mapping are kept twice."""
    return bed.units


_ENRICHED = """units u
  LEFT JOIN companies c ON u.company_id = c.company_id AND u.snapshot_id = c.snapshot_id
  LEFT JOIN deals d ON u.deal_id = d.deal_id AND u.snapshot_id = d.snapshot_id
  LEFT JOIN owners o ON u.owner_id = o.owner_id"""


@check("J04", f"""SELECT u.company_id, {ts("u.snapshot_id")}, c.company_type, c.company_name, c.development_category, count(*) AS units
FROM {_ENRICHED} GROUP BY u.company_id, u.snapshot_id, c.company_type, c.company_name, c.development_category""")
def units_with_companies(bed: Bed) -> DataFrame:
    rows = history.with_companies(bed.units, bed.companies)
    keys = ["company_id", "snapshot_id", "company_type", "company_name", "development_category"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("units"))


@check("J05", f"""SELECT u.company_id, u.deal_id, {ts("u.snapshot_id")}, d.deal_type, d.deal_name, d.amount AS deal_amount
FROM {_ENRICHED}""")
def units_with_deals(bed: Bed) -> DataFrame:
    return history.with_deals(bed.units, bed.deals).select(
        "company_id", "deal_id", "snapshot_id", "deal_type", "deal_name", "deal_amount"
    )


@check("J06", f"""SELECT u.owner_id, o.email AS owner_email,
  concat(coalesce(o.first_name, ''), ' ', coalesce(o.last_name, '')) AS owner_name, count(*) AS units
FROM {_ENRICHED} GROUP BY ALL""")
def units_with_owners(bed: Bed) -> DataFrame:
    rows = history.with_owners(bed.units, bed.owners)
    return rows.groupBy("owner_id", "owner_email", "owner_name").agg(F.count(F.lit(1)).alias("units"))


@check("J07", """, per_owner AS (
  SELECT snapshot_id, record_timestamp, owner_id, count(DISTINCT company_id) AS total_companies, sum(adjusted_score) AS total_score
  FROM (SELECT * FROM units WHERE stage_level NOT IN (-1, 9)
        UNION ALL SELECT * REPLACE (record_timestamp + INTERVAL 1 DAY AS record_timestamp) FROM units
                  WHERE stage_level NOT IN (-1, 9) AND year(snapshot_id) = 1999) u
  GROUP BY ALL),
totals AS (SELECT snapshot_id, record_timestamp, count(DISTINCT owner_id) AS active_owners, sum(total_score) AS total_score_all_owners
           FROM per_owner GROUP BY ALL)
SELECT strftime(p.snapshot_id, '%Y') AS year, p.owner_id, p.total_companies, p.total_score, t.active_owners, t.total_score_all_owners
FROM per_owner p JOIN totals t ON p.snapshot_id = t.snapshot_id""")
def owners_with_snapshot_totals(bed: Bed) -> DataFrame:
    """One snapshot was loaded twice, so its owner rows come out four times."""
    units = enriched_units(bed.units, bed.companies, bed.deals, bed.owners)
    again = units.filter(F.year("snapshot_id") == 1999).withColumn(
        "record_timestamp", F.col("record_timestamp") + F.expr("INTERVAL '1' DAY")
    )
    rows = history.owner_aggregates(units.unionByName(again))
    rows = history.with_snapshot_totals(rows, history.snapshot_totals(rows))
    return rows.select(
        F.date_format("snapshot_id", "yyyy").alias("year"),
        "owner_id", "total_companies", "total_score", "active_owners", "total_score_all_owners",
    )


_ORPHANS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{f}' AS field, t.{f} AS value FROM {src} t
    WHERE t.{f} IS NOT NULL AND t.{f} <> '' AND NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{rf} = t.{f})"""
    for t, src, f, ref, rf in [
        ("companies", "companies", "owner_id", "owners", "owner_id"),
        ("deals", "deals", "owner_id", "owners", "owner_id"),
        ("deals", "deals", "associated_company_id", "companies", "company_id"),
        ("pipeline_units_snapshot", "units", "owner_id", "owners", "owner_id"),
        ("pipeline_units_snapshot", "units", "company_id", "companies", "company_id"),
        ("pipeline_units_snapshot", "units", "deal_id", "deals", "deal_id"),
    ]
)


@check("J08", f"""
SELECT "table", field, 'orphaned_reference' AS issue_type, 'critical' AS severity, count(*) AS "count",
       array_to_string(list_slice(list_sort(list(DISTINCT value)), 1, 5), '|') AS sample_values
FROM ({_ORPHANS}) o GROUP BY "table", field""")
def orphan_references(bed: Bed) -> DataFrame:
    return integrity.orphan_references(bed.audited).drop("description")


@check("J09", f"""
, per_snapshot AS (
  SELECT s.snapshot_id, count(c.company_id) AS company_count, count(d.deal_id) AS deal_count
  FROM (SELECT DISTINCT snapshot_id FROM year_registry) s
  LEFT JOIN companies c ON s.snapshot_id = c.snapshot_id LEFT JOIN deals d ON s.snapshot_id = d.snapshot_id
  GROUP BY s.snapshot_id)
SELECT {ts("r.snapshot_id")}, r.triggered_by, r.status, {ts("r.record_timestamp")},
       CAST(sum(p.company_count) AS BIGINT) AS company_count, CAST(sum(p.deal_count) AS BIGINT) AS deal_count,
       CAST(sum(p.company_count + p.deal_count) AS BIGINT) AS total_count
FROM year_registry r JOIN per_snapshot p ON p.snapshot_id = r.snapshot_id
GROUP BY r.snapshot_id, r.triggered_by, r.status, r.record_timestamp""")
def registry_snapshot_details(bed: Bed) -> DataFrame:
    """Counts as the plain three-way join multiplies them."""
    return registry.snapshot_details(bed.year_registry, bed.companies, bed.deals)


@check("J09", f"""
SELECT {ts("r.snapshot_id")}, r.triggered_by, r.status, {ts("r.record_timestamp")},
       coalesce(c.n, 0) AS company_count, coalesce(d.n, 0) AS deal_count, coalesce(c.n, 0) + coalesce(d.n, 0) AS total_count
FROM (SELECT DISTINCT snapshot_id, triggered_by, status, record_timestamp FROM year_registry) r
LEFT JOIN (SELECT snapshot_id, count(company_id) AS n FROM companies GROUP BY 1) c ON c.snapshot_id = r.snapshot_id
LEFT JOIN (SELECT snapshot_id, count(deal_id) AS n FROM deals GROUP BY 1) d ON d.snapshot_id = r.snapshot_id""")
def registry_snapshot_counts(bed: Bed) -> DataFrame:
    """Counts as one would expect them."""
    return registry.snapshot_details(bed.year_registry, bed.companies, bed.deals, multiply=False)


def _searched_names(bed: Bed) -> DataFrame:
    """Owner names as exports spell them: exact, longer, shorter, unknown, blank."""
    key = F.col("c_custkey")
    nation = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    name = (
        F.when(key % 7 == 0, F.concat(F.lit(" "), F.lower(nation)))
        .when(key % 7 == 1, F.concat(nation, F.lit(" Jr")))
        .when(key % 7 == 2, F.concat(F.lit("tion_"), F.col("c_nationkey").cast("string")))
        .when(key % 7 == 3, F.concat(F.lit("Nobody "), key.cast("string")))
        .when(key % 7 == 4, "  ")
        .when(key % 7 == 5, nation)
    )
    return bed.table("customer").select(key.alias("k"), name.alias("owner"))


@check("J10", """
, names AS (
  SELECT c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN concat(' nation_', c_nationkey) WHEN 1 THEN concat('NATION_', c_nationkey, ' Jr')
    WHEN 2 THEN concat('tion_', c_nationkey) WHEN 3 THEN concat('Nobody ', c_custkey) WHEN 4 THEN '  '
    WHEN 5 THEN concat('NATION_', c_nationkey) END AS owner FROM customer),
lookup AS (SELECT lower(n_name) AS name, concat('id', n_nationkey) AS id, n_nationkey AS rank FROM nation),
hits AS (
  SELECT n.k, arg_min(l.id, CASE WHEN lower(trim(n.owner)) = l.name THEN -1 ELSE l.rank END) AS id
  FROM names n JOIN lookup l ON contains(l.name, lower(trim(n.owner))) OR contains(lower(trim(n.owner)), l.name)
  GROUP BY n.k)
SELECT n.k, coalesce(h.id, n.owner) AS owner FROM names n LEFT JOIN hits h ON h.k = n.k""")
def owner_name_to_id(bed: Bed) -> DataFrame:
    lookup = bed.table("nation").select(
        F.lower("n_name").alias("name"),
        F.concat(F.lit("id"), F.col("n_nationkey").cast("string")).alias("owner_id"),
        F.col("n_nationkey").alias("rank"),
    )
    return exports.resolve_owner_names(_searched_names(bed), "owner", lookup)


@check("J11", f"""
SELECT o.o_orderkey, p.snapshot_id FROM orders o JOIN {FILE_PAIRS_SQL} f0
  ON f0.export_date = strftime(o.o_orderdate, '%Y-%m-%d')
  JOIN (SELECT export_date, least(company_timestamp, deals_timestamp) AS snapshot_id FROM {FILE_PAIRS_SQL} f1) p
  ON p.export_date = f0.export_date
WHERE f0.company_file IS NOT NULL AND f0.deals_file IS NOT NULL""")
def export_rows_with_file_pair(bed: Bed) -> DataFrame:
    rows = bed.table("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("export_date"))
    return exports.with_file_pairs(rows, pair_export_files(export_files(bed))).select("o_orderkey", "snapshot_id")


@check("J12", f"""SELECT company_id, {ts("snapshot_id")} FROM companies WHERE snapshot_id =
  (SELECT snapshot_id + INTERVAL 1 YEAR FROM year_registry WHERE status LIKE '%completed%'
   ORDER BY record_timestamp DESC, snapshot_id DESC LIMIT 1)""")
def latest_snapshot_rows(bed: Bed) -> DataFrame:
    """Snapshots are one year later here, so that the newest one (1994) has companies."""
    known = bed.year_registry.withColumn("snapshot_id", F.col("snapshot_id") + F.expr("INTERVAL '1' YEAR"))
    return registry.latest_snapshot_rows(bed.companies, known).select("company_id", "snapshot_id")



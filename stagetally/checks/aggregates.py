"""Aggregates, windows, ordering and set operations (survey sections 2.4 to 2.7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.checks.base import AS_OF, FIRST_YEAR, LAST_YEAR, Bed, check, ts
from stagetally.checks.shaping import _ENRICHED
from stagetally.operators import exports, history, integrity, profiles, registry
from stagetally.operators.sampling import limit_per_object, sample_values
from stagetally.plans.report import enriched_units, owner_history, register_report_view
from stagetally.plans.score import score_snapshots
from stagetally.sources.warehouse import as_timestamp, table_counts


def _at_2000(df: DataFrame) -> DataFrame:
    return df.filter(F.col("snapshot_id") == F.lit("2000-01-01").cast("timestamp"))


_AT_2000 = "WHERE snapshot_id = TIMESTAMP '2000-01-01'"


# -- score history and the report -------------------------------------------------------------


@check("A01", f"""SELECT owner_id, combined_stage, num_companies, total_score, {ts("snapshot_id")}, {ts("record_timestamp")}
FROM history""")
def score_history(bed: Bed) -> DataFrame:
    return bed.history


_BANDS = {"nurturing": (0, 0), "lead": (1, 3), "sql": (4, 4), "opportunity": (5, 8)}
_TYPES = {
    "prospect": ("company", "Prospect"),
    "customer": ("company", "Customer"),
    "partner": ("company", "Partner"),
    "vendor": ("company", "Vendor"),
    "new_business": ("deal", "New Business"),
    "existing_business": ("deal", "Existing Business"),
}
_LISTS = {
    "company_types": "company_type",
    "deal_types": "deal_type",
    "development_categories": "development_category",
    "hiring_status": "hiring_developers",
}
_OWNER_KEYS = "snapshot_id, record_timestamp, owner_id, owner_email, owner_name"


def _joined(key: str, other: str) -> str:
    """Equality of the group keys, NULL equal to NULL."""
    return " AND ".join(f"{key}.{k} IS NOT DISTINCT FROM {other}.{k}" for k in _OWNER_KEYS.split(", "))


# Everything that is counted per owner goes into one long table of (group, what, n, score),
# which is pivoted once; lists come from a long table of distinct values.
REPORT_CTES = f"""
, report_rows AS (
  SELECT u.snapshot_id, u.record_timestamp, u.owner_id, o.email AS owner_email,
         concat(ifnull(o.first_name, ''), ' ', ifnull(o.last_name, '')) AS owner_name,
         u.company_id, u.deal_id, u.stage_level, u.adjusted_score, ifnull(d.amount, 0) AS deal_value,
         c.company_type, d.deal_type, c.development_category, c.hiring_developers
  FROM {_ENRICHED} WHERE u.stage_level BETWEEN 0 AND 8),
bands AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, (a, b) in _BANDS.items())}) v(band, low, high)),
long_counts AS (
  SELECT {_OWNER_KEYS}, band AS what, adjusted_score AS score FROM report_rows JOIN bands ON stage_level BETWEEN low AND high
  UNION ALL SELECT {_OWNER_KEYS}, 'company ' || company_type, 0 FROM report_rows WHERE company_type IS NOT NULL
  UNION ALL SELECT {_OWNER_KEYS}, 'deal ' || deal_type, 0 FROM report_rows WHERE deal_type IS NOT NULL
  UNION ALL SELECT {_OWNER_KEYS}, 'any deal', 0 FROM report_rows WHERE deal_type IS NOT NULL),
counted AS (
  SELECT {_OWNER_KEYS}, map_from_entries(list((what, n))) AS n, map_from_entries(list((what, score))) AS score
  FROM (SELECT {_OWNER_KEYS}, what, count(*) AS n, sum(score) AS score FROM long_counts GROUP BY ALL) GROUP BY ALL),
long_values AS (
  {" UNION ".join(f"SELECT {_OWNER_KEYS}, '{name}' AS list, {column} AS item FROM report_rows WHERE {column} IS NOT NULL" for name, column in _LISTS.items())}),
listed AS (
  SELECT {_OWNER_KEYS}, map_from_entries(list((list, text))) AS lists
  FROM (SELECT {_OWNER_KEYS}, list, string_agg(item, ',' ORDER BY item) AS text FROM long_values GROUP BY ALL) GROUP BY ALL),
measured AS (
  SELECT {_OWNER_KEYS}, count(DISTINCT company_id) AS total_companies, count(DISTINCT deal_id) AS total_deals,
         sum(adjusted_score) AS total_score, avg(adjusted_score) AS avg_score_per_unit, sum(deal_value) AS total_deal_value
  FROM report_rows GROUP BY ALL),
per_owner AS (
  SELECT m.*, {", ".join(f"l.lists['{name}'] AS {name}" for name in _LISTS)},
    {", ".join(f"CAST(ifnull(k.n['{b}'], 0) AS BIGINT) AS {b}_count, CAST(ifnull(k.score['{b}'], 0) AS DOUBLE) AS {b}_score" for b in _BANDS)},
    {", ".join(f"CAST(ifnull(k.n['{of} {value}'], 0) AS BIGINT) AS {n}_count" for n, (of, value) in _TYPES.items())},
    CAST(ifnull(k.n['any deal'], 0) AS BIGINT) AS companies_with_deals
  FROM measured m LEFT JOIN counted k ON {_joined("m", "k")} LEFT JOIN listed l ON {_joined("m", "l")}),
totals AS (
  SELECT snapshot_id, record_timestamp, count(DISTINCT owner_id) AS active_owners,
         CAST(sum(total_companies) AS BIGINT) AS total_companies_all_owners,
         sum(total_score) AS total_score_all_owners, avg(total_score) AS avg_score_per_owner
  FROM measured GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY record_timestamp, snapshot_id) AS turn FROM per_owner),
compared AS (
  SELECT now.* EXCLUDE (turn), ago.total_score AS previous_total_score, ago.total_companies AS previous_total_companies,
         ago.record_timestamp AS previous_record_timestamp,
         now.total_score - ago.total_score AS score_change_from_previous,
         now.total_companies - ago.total_companies AS company_change_from_previous,
         round((now.total_score - ago.total_score) / nullif(ago.total_score, 0) * 100, 2) AS score_change_percent
  FROM numbered now LEFT JOIN numbered ago
    ON ago.owner_id IS NOT DISTINCT FROM now.owner_id AND ago.turn = now.turn - 1),
report AS (
  SELECT compared.*, totals.* EXCLUDE (snapshot_id, record_timestamp),
         row_number() OVER (PARTITION BY snapshot_id ORDER BY total_score DESC, owner_id NULLS FIRST) AS owner_rank_in_snapshot
  FROM compared JOIN totals USING (snapshot_id))
"""
_ROUNDED_SQL = """round(total_deal_value, 2) AS total_deal_value, round(avg_score_per_unit, 6) AS avg_score_per_unit"""
_TIMES_SQL = f"{ts('snapshot_id')}, {ts('record_timestamp')}"


def _rounded(df: DataFrame) -> DataFrame:
    digits = {"total_deal_value": 2, "avg_score_per_unit": 6, "avg_score_per_owner": 6}
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


def _owner_rows(bed: Bed) -> DataFrame:
    return history.owner_aggregates(enriched_units(bed.units, bed.companies, bed.deals, bed.owners))


@check("A02", REPORT_CTES + f"""SELECT * EXCLUDE (snapshot_id, record_timestamp, total_deal_value, avg_score_per_unit),
{_TIMES_SQL}, {_ROUNDED_SQL} FROM per_owner""")
def owner_snapshot_aggregates(bed: Bed) -> DataFrame:
    return _rounded(_owner_rows(bed))


@check("A03", REPORT_CTES + f"""SELECT {_TIMES_SQL}, active_owners, total_companies_all_owners, total_score_all_owners,
round(avg_score_per_owner, 6) AS avg_score_per_owner FROM totals""")
def snapshot_totals(bed: Bed) -> DataFrame:
    return _rounded(history.snapshot_totals(_owner_rows(bed)))


@check("W01", REPORT_CTES + f"SELECT {ts('snapshot_id')}, owner_id, total_score, owner_rank_in_snapshot FROM report")
def owner_rank_in_snapshot(bed: Bed) -> DataFrame:
    ranked = history.owner_rank(_owner_rows(bed))
    return ranked.select("snapshot_id", "owner_id", "total_score", "owner_rank_in_snapshot")


@check("W02", REPORT_CTES + f"""SELECT {ts('snapshot_id')}, owner_id, previous_total_score, previous_total_companies,
{ts('previous_record_timestamp')} FROM report""")
def previous_period_values(bed: Bed) -> DataFrame:
    rows = history.previous_period(_owner_rows(bed))
    return rows.select(
        "snapshot_id", "owner_id", "previous_total_score", "previous_total_companies", "previous_record_timestamp"
    )


@check("W03", REPORT_CTES + f"""SELECT {ts('snapshot_id')}, owner_id, score_change_from_previous, company_change_from_previous
FROM report""")
def period_change(bed: Bed) -> DataFrame:
    rows = history.period_change(history.previous_period(_owner_rows(bed)))
    return rows.select("snapshot_id", "owner_id", "score_change_from_previous", "company_change_from_previous")


@check("W04", REPORT_CTES + f"SELECT {ts('snapshot_id')}, owner_id, score_change_percent FROM report")
def period_change_percent(bed: Bed) -> DataFrame:
    rows = history.period_change_percent(history.previous_period(_owner_rows(bed)))
    return rows.select("snapshot_id", "owner_id", "score_change_percent")


@check("W05", REPORT_CTES + f"""SELECT * EXCLUDE (snapshot_id, record_timestamp, previous_record_timestamp, total_deal_value,
avg_score_per_unit, avg_score_per_owner), {_TIMES_SQL}, {ts('previous_record_timestamp')}, {_ROUNDED_SQL},
round(avg_score_per_owner, 6) AS avg_score_per_owner FROM report""")
def owner_history_report(bed: Bed) -> DataFrame:
    """The whole report: enrich, aggregate, total, rank, compare, sort."""
    report = owner_history(bed.units, bed.companies, bed.deals, bed.owners)
    return history.report_order(_rounded(report))


@check("W05", REPORT_CTES + f"""SELECT * EXCLUDE (snapshot_id, record_timestamp, previous_record_timestamp, total_deal_value,
avg_score_per_unit, avg_score_per_owner), {ts('snapshot_id')}, {_ROUNDED_SQL},
round(avg_score_per_owner, 6) AS avg_score_per_owner FROM report""")
def owner_history_view(bed: Bed) -> DataFrame:
    """The report as a view, made from the owner rows that scoring keeps; the last snapshot is scored twice."""
    wh = bed.warehouse("companies", "deals", "deal_stage_reference", "owners")
    years = [f"{y}-01-01T00:00:00Z" for y in range(FIRST_YEAR, LAST_YEAR + 1)]
    score_snapshots(wh, years, as_timestamp(AS_OF))
    score_snapshots(wh, years[-1:], as_timestamp("2024-02-01T00:00:00Z"))
    register_report_view(wh, "vw_owner_history_check")
    return _rounded(bed.spark.table("vw_owner_history_check")).drop("record_timestamp", "previous_record_timestamp")


# -- profiles ------------------------------------------------------------------------------------


@check("A04", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{f}' AS field, {f} AS mixed_case_value, count(*) AS record_count, lower({f}) AS expected_value
    FROM {src} WHERE {where} {f} <> lower({f}) GROUP BY {f}"""
    for t, src, f, where in [
        *[("companies", "companies", f, "snapshot_id = TIMESTAMP '2000-01-01' AND") for f in ("lifecycle_stage", "lead_status", "company_type")],
        *[("deals", "deals", f, "snapshot_id = TIMESTAMP '2000-01-01' AND") for f in ("deal_stage", "deal_type")],
        ("owners", "reps", "email", ""),
    ]))
def normalization_violations(bed: Bed) -> DataFrame:
    return profiles.normalization_violations(_at_2000(bed.companies), _at_2000(bed.deals), bed.reps)


def _issues_sql(field: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {field} <> lower({field}) THEN 1 ELSE 0 END), 0) AS BIGINT) AS {field}_issues"


@check("A05", f"""SELECT count(*) AS total, count(DISTINCT lower(lifecycle_stage)) AS unique_lifecycle_stages,
string_agg(DISTINCT lower(lifecycle_stage), ',' ORDER BY lower(lifecycle_stage)) AS lifecycle_stages,
count(DISTINCT owner_id) AS unique_owners, {_issues_sql("lifecycle_stage")}, {_issues_sql("lead_status")}
FROM companies {_AT_2000}""")
def profile_companies(bed: Bed) -> DataFrame:
    return profiles.profile_companies(_at_2000(bed.companies))


@check("A06", f"""SELECT count(*) AS total, count(DISTINCT lower(deal_stage)) AS unique_deal_stages,
string_agg(DISTINCT lower(deal_stage), ',' ORDER BY lower(deal_stage)) AS deal_stages,
count(DISTINCT associated_company_id) AS unique_associated_companies, {_issues_sql("deal_stage")}, {_issues_sql("deal_type")}
FROM deals {_AT_2000}""")
def profile_deals(bed: Bed) -> DataFrame:
    return profiles.profile_deals(_at_2000(bed.deals))


_MAPPING_FIELDS = ["combined_stage", "lifecycle_stage", "lead_status", "deal_stage"]


@check("A07", f"""SELECT count(*) AS total,
string_agg(DISTINCT lower(combined_stage), ',' ORDER BY lower(combined_stage)) AS combined_stages,
{", ".join(map(_issues_sql, _MAPPING_FIELDS))} FROM wide_mapping""")
def profile_stage_mapping(bed: Bed) -> DataFrame:
    return profiles.profile_stage_mapping(bed.wide_mapping)


@check("A07", "SELECT mapping, field, value, lower(value) AS expected FROM (" + " UNION ALL ".join(
    f"SELECT combined_stage AS mapping, '{f}' AS field, {f} AS value FROM wide_mapping" for f in _MAPPING_FIELDS)
    + ") v WHERE value <> lower(value)")
def stage_mapping_case_issues(bed: Bed) -> DataFrame:
    return profiles.mapping_case_issues(bed.wide_mapping)


@check("A08", """SELECT count(*) AS total, count(DISTINCT lower(email)) AS unique_emails,
CAST(sum(CASE WHEN email <> lower(email) THEN 1 ELSE 0 END) AS BIGINT) AS email_issues FROM reps""")
def profile_owners(bed: Bed) -> DataFrame:
    return profiles.profile_owners(bed.reps)


def _listed(source: str, table: str, field: str) -> str:
    return f"""SELECT '{source}' AS source_table, (SELECT count(*) FROM {table}) AS record_count,
    (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT lower({field}) AS v FROM {table}
     WHERE {field} IS NOT NULL) x) AS stages, 0 AS left_out"""


@check("A09", ", c2000 AS (SELECT * FROM companies " + _AT_2000 + "), d2000 AS (SELECT * FROM deals " + _AT_2000 + ") "
    + _listed("companies", "c2000", "lifecycle_stage") + " UNION ALL " + _listed("deals", "d2000", "deal_stage")
    + " UNION ALL " + _listed("stage_mapping", "wide_mapping", "combined_stage"))
def source_summary(bed: Bed) -> DataFrame:
    return profiles.source_summary(_at_2000(bed.companies), _at_2000(bed.deals), bed.wide_mapping)


@check("A10", f"""SELECT 'companies' AS "table", count(*) AS "rows" FROM companies {_AT_2000}
UNION ALL SELECT 'deals', count(*) FROM deals {_AT_2000} UNION ALL SELECT 'owners', count(*) FROM owners
UNION ALL SELECT 'snapshot_registry', count(*) FROM year_registry UNION ALL SELECT 'pipeline_units_snapshot', count(*) FROM units
UNION ALL SELECT 'pipeline_score_history', count(*) FROM history UNION ALL SELECT 'deal_stage_reference', count(*) FROM stages""")
def counts_per_table(bed: Bed) -> DataFrame:
    return table_counts(bed.audited, "2000-01-01T00:00:00Z")


# -- integrity -------------------------------------------------------------------------------------


def _issue_sql(parts: list[tuple[str, str, str, str]], issue: str, severity: str, samples: str) -> str:
    """(reported table, source, field, condition) checks as UNION ALL, non-zero only."""
    union = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{f}' AS field, count(*) AS "count", {samples.format(f=f)} AS sample_values
        FROM {src} WHERE {cond.format(f=f)}""" for t, src, f, cond in parts)
    return f"""SELECT "table", field, '{issue}' AS issue_type, '{severity}' AS severity, "count", sample_values
    FROM ({union}) i WHERE "count" > 0"""


_FIRST_FIVE = "array_to_string(list_slice(list_sort(list(DISTINCT {f})), 1, 5), '|')"
_REFS = [
    ("companies", "companies", "owner_id"), ("deals", "deals", "owner_id"), ("deals", "deals", "associated_company_id"),
    ("pipeline_units_snapshot", "units", "owner_id"), ("pipeline_units_snapshot", "units", "company_id"),
    ("pipeline_units_snapshot", "units", "deal_id"),
]
_REQUIRED = [
    ("companies", "companies", "company_id"), ("companies", "companies", "company_name"), ("deals", "deals", "deal_id"),
    ("deals", "deals", "deal_name"), ("owners", "owners", "owner_id"), ("owners", "owners", "email"),
    ("snapshot_registry", "year_registry", "triggered_by"), ("snapshot_registry", "year_registry", "status"),
]
_LOWER = [
    ("owners", "owners", "email"),
    *[("companies", "companies", f) for f in (
        "lifecycle_stage", "lead_status", "company_type", "development_category", "hiring_developers",
        "inhouse_developers", "proff_likviditetsgrad", "proff_lonnsomhet", "proff_soliditet", "proff_link")],
    ("deals", "deals", "deal_stage"), ("deals", "deals", "deal_type"),
]
BLANK_SQL = _issue_sql([(*r, "{f} = ''") for r in _REFS], "blank_reference_field", "warning", "''''''")
REQUIRED_SQL = _issue_sql([(*r, "{f} IS NULL OR {f} = ''") for r in _REQUIRED], "missing_required_field", "critical", "concat('NULL|', '''''')")
_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def format_sql(source: str) -> str:
    condition = "email IS NOT NULL AND email <> '' AND NOT regexp_matches(email, '" + _EMAIL.replace("{", "{{").replace("}", "}}") + "')"
    return _issue_sql([("owners", source, "email", condition)], "invalid_format", "warning", _FIRST_FIVE)


CASE_SQL = _issue_sql([(*r, "{f} IS NOT NULL AND {f} <> '' AND {f} <> lower({f})") for r in _LOWER], "case_normalization", "warning", _FIRST_FIVE)


DESCRIPTION_SQL = """CASE issue_type
  WHEN 'blank_reference_field' THEN concat('Empty string in ', field, ' should be NULL')
  WHEN 'missing_required_field' THEN concat('Required field ', field, ' is NULL or blank')
  WHEN 'orphaned_reference' THEN concat(field, ' values without a row in ',
    CASE field WHEN 'owner_id' THEN 'owners.owner_id' WHEN 'deal_id' THEN 'deals.deal_id' ELSE 'companies.company_id' END)
  WHEN 'invalid_format' THEN concat('Not an e-mail address in ', field)
  WHEN 'case_normalization' THEN concat(field, ' should be lower case')
  WHEN 'duplicate_records' THEN concat(split_part(sample_values, ' ', 1), ' keys are held by more than one row')
  WHEN 'missing_snapshot_data' THEN 'Registered snapshots without a row in the table'
  WHEN 'unregistered_snapshot' THEN 'Snapshots in the table that are not registered'
  WHEN 'missing_snapshots' THEN 'The registry holds no snapshot'
  WHEN 'anomalous_distribution' THEN concat('Snapshot ', sample_values, ' has ', "count", ' rows, the mean is ', printf('%.0f', (
    SELECT avg(n) FROM (
      SELECT 'companies' AS t, count(DISTINCT company_id) AS n FROM companies GROUP BY snapshot_id
      UNION ALL SELECT 'deals', count(DISTINCT deal_id) FROM deals GROUP BY snapshot_id) sizes
    WHERE t = "table")))
  END AS description"""


def described(sql: str) -> str:
    """Issues with their text."""
    return f'SELECT "table", field, issue_type, severity, "count", sample_values, {DESCRIPTION_SQL} FROM ({sql}) issues'


@check("A11", described(BLANK_SQL))
def blank_reference_count(bed: Bed) -> DataFrame:
    return integrity.blank_reference_count(bed.audited)


@check("A12", described(REQUIRED_SQL))
def missing_required_count(bed: Bed) -> DataFrame:
    return integrity.missing_required_count(bed.audited)


@check("A13", described(format_sql("reps")))
def invalid_format_count(bed: Bed) -> DataFrame:
    return integrity.invalid_format_count({"owners": bed.reps})


@check("A14", described(CASE_SQL))
def case_violation_count(bed: Bed) -> DataFrame:
    return integrity.case_violation_count(bed.audited)


@check("A15", """SELECT count(*) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS duplicate_records
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d""")
def duplicate_records(bed: Bed) -> DataFrame:
    return integrity.duplicate_summary(bed.table("lineitem"), ["l_orderkey", "l_linenumber"])


@check("A16", f"""SELECT {ts("snapshot_id")}, count(DISTINCT company_id) AS companies, count(DISTINCT deal_id) AS deals
FROM (SELECT snapshot_id, company_id, NULL AS deal_id FROM companies
      UNION ALL SELECT snapshot_id, NULL, deal_id FROM deals) u GROUP BY snapshot_id""")
def snapshot_distribution(bed: Bed) -> DataFrame:
    return integrity.snapshot_distribution(bed.companies, bed.deals)


def _monthly(bed: Bed) -> tuple[DataFrame, DataFrame]:
    """Orders as monthly snapshots; the last month is nearly empty."""
    month = F.date_trunc("month", "o_orderdate")
    orders = bed.table("orders").select(
        month.alias("snapshot_id"),
        F.col("o_orderkey").cast("string").alias("deal_id"),
        F.col("o_custkey").cast("string").alias("company_id"),
    )
    return orders.select("snapshot_id", "company_id"), orders.select("snapshot_id", "deal_id")


@check("A17", """
, monthly AS (SELECT date_trunc('month', o_orderdate) AS s, count(DISTINCT o_custkey) AS companies, count(DISTINCT o_orderkey) AS deals
              FROM orders GROUP BY 1),
long AS (SELECT s, 'companies' AS "table", companies AS n, (SELECT avg(companies) FROM monthly) AS mean FROM monthly
         UNION ALL SELECT s, 'deals', deals, (SELECT avg(deals) FROM monthly) FROM monthly)
SELECT "table", n AS "count", strftime(s, '%Y-%m-%d %H:%M:%S') AS sample_values FROM long
WHERE (n / mean < 0.5 OR n / mean > 2.0) AND (SELECT count(*) FROM monthly) > 1""")
def distribution_anomalies(bed: Bed) -> DataFrame:
    found = integrity.distribution_anomalies(integrity.snapshot_distribution(*_monthly(bed)))
    return found.select("table", "count", "sample_values")


@check("A18", """SELECT count(DISTINCT snapshot_id) AS total_snapshots, count(*) AS total_records,
strftime(min(snapshot_id), '%Y-%m-%d %H:%M:%S.%f') AS earliest_snapshot,
strftime(max(snapshot_id), '%Y-%m-%d %H:%M:%S.%f') AS latest_snapshot FROM companies""")
def snapshot_stats(bed: Bed) -> DataFrame:
    return profiles.snapshot_stats(bed.companies)


_KEY_FIELDS = ["deal_id", "deal_name", "deal_stage", "associated_company_id"]


@check("A19", " UNION ALL ".join(
    f"SELECT '{f}' AS field, count({f}) AS non_null, round(count({f}) * 100.0 / count(*), 6) AS percent FROM deals"
    for f in _KEY_FIELDS))
def completeness(bed: Bed) -> DataFrame:
    return profiles.completeness(bed.deals, _KEY_FIELDS).withColumn("percent", F.round("percent", 6))


WRITTEN_ID_SQL = """CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') END"""


def written_ids(bed: Bed) -> DataFrame:
    """Snapshot ids in the three forms older data holds."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = (
        F.when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    return bed.table("orders").select(key.alias("k"), text.alias("snapshot_id"))


FORMAT_SQL = """contains(snapshot_id, '.') AS has_microseconds, snapshot_id LIKE '%Z' AS has_timezone,
  length(snapshot_id) AS length, CASE length(snapshot_id) WHEN 10 THEN 'date_only' WHEN 20 THEN 'datetime_utc'
  ELSE 'datetime_microseconds_utc' END AS format_type"""


@check("A20", f"""SELECT snapshot_id, record_count, {FORMAT_SQL} FROM
(SELECT {WRITTEN_ID_SQL} AS snapshot_id, count(*) AS record_count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) t""")
def snapshot_format_profile(bed: Bed) -> DataFrame:
    return profiles.snapshot_format_profile(written_ids(bed))


def _some_issues(bed: Bed) -> DataFrame:
    """One issue row per log day and event type, sized by its events."""
    events = bed.table("events")
    return events.groupBy(F.col("event_type").alias("issue_type"), F.date_format("ts", "yyyy-MM-dd").alias("field")).agg(
        F.concat(F.lit("t"), F.min(F.col("user_id") % 4).cast("string")).alias("table"),
        F.when(F.min(F.col("event_id") % 3) == 0, "critical")
        .when(F.min(F.col("event_id") % 3) == 1, "warning").otherwise("info").alias("severity"),
        F.count(F.lit(1)).alias("count"),
    )


_SOME_ISSUES_SQL = """(SELECT event_type AS issue_type, strftime(ts, '%Y-%m-%d') AS field, concat('t', min(user_id % 4)) AS "table",
  CASE min(event_id % 3) WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'info' END AS severity, count(*) AS "count"
  FROM events GROUP BY 1, 2) i"""


@check("A21", f"""SELECT 'total' AS dimension, 'all' AS value, count(*) AS issues FROM {_SOME_ISSUES_SQL}
UNION ALL SELECT 'severity', severity, count(*) FROM {_SOME_ISSUES_SQL} GROUP BY severity
UNION ALL SELECT 'table', "table", count(*) FROM {_SOME_ISSUES_SQL} GROUP BY "table"
UNION ALL SELECT 'issue_type', issue_type, count(*) FROM {_SOME_ISSUES_SQL} GROUP BY issue_type""")
def issue_rollup(bed: Bed) -> DataFrame:
    return integrity.issue_rollup(_some_issues(bed))


@check("A22", f"""SELECT n AS total_records, round(greatest(0.0, 100 - p / n * 100), 2) AS integrity_score
FROM (SELECT sum("count" * CASE severity WHEN 'critical' THEN 3.0 WHEN 'warning' THEN 1.0 ELSE 0.1 END) AS p FROM {_SOME_ISSUES_SQL}) a,
     (SELECT (SELECT count(*) FROM companies) + (SELECT count(*) FROM deals) AS n) b""")
def integrity_score(bed: Bed) -> DataFrame:
    counts = table_counts({"companies": bed.companies, "deals": bed.deals})
    return integrity.integrity_score(_some_issues(bed), counts)


@check("A23", f"""SELECT 'found' AS audit, 6 AS position, issue_type, 'Lower-case these values when records are loaded' AS recommendation
FROM ({CASE_SQL}) a GROUP BY issue_type
UNION ALL SELECT 'found', 1, issue_type, 'Store missing references as NULL instead of an empty string' FROM ({BLANK_SQL}) b GROUP BY issue_type
UNION ALL SELECT 'clean', 0, NULL, 'No action needed; keep running the checks'
WHERE (SELECT count(*) FROM companies WHERE lifecycle_stage = 'no such stage') = 0""")
def recommendations(bed: Bed) -> DataFrame:
    """Advice for issues found, and the row that stands for none."""
    found = integrity.case_violation_count(bed.audited).unionByName(integrity.blank_reference_count(bed.audited))
    stage = bed.companies.filter("lifecycle_stage = 'no such stage'").select("company_id")
    none = found.join(stage, found["table"] == stage["company_id"], "left_semi")
    return (
        integrity.recommendations(found)
        .withColumn("audit", F.lit("found"))
        .unionByName(integrity.recommendations(none).withColumn("audit", F.lit("clean")))
    )


@check("A25", f"""SELECT {ts("snapshot_id")}, CAST(sum(c) AS BIGINT) AS companies, CAST(sum(d) AS BIGINT) AS deals,
CAST(sum(c + d) AS BIGINT) AS total
FROM (SELECT snapshot_id, 1 AS c, 0 AS d FROM companies UNION ALL SELECT snapshot_id, 0, 1 FROM deals) x GROUP BY ROLLUP (snapshot_id)""")
def export_summary(bed: Bed) -> DataFrame:
    return exports.export_summary(bed.companies, bed.deals)


# -- order and limits ---------------------------------------------------------------------------------


_LOG_ROW = f"{ts('snapshot_id')}, {ts('record_timestamp')}, triggered_by, status, notes"


@check("O01", REPORT_CTES + f"SELECT {_TIMES_SQL}, owner_id, total_score FROM report")
def report_order(bed: Bed) -> DataFrame:
    rows = _owner_rows(bed).select("snapshot_id", "record_timestamp", "owner_id", "total_score")
    return history.report_order(rows)


@check("O02", f"SELECT {_LOG_ROW} FROM (SELECT * FROM registry WHERE status = 'started' ORDER BY record_timestamp DESC LIMIT 1) t")
def latest_snapshot(bed: Bed) -> DataFrame:
    return registry.latest_snapshot(bed.registry, "started")


@check("O03", f"""SELECT {_LOG_ROW} FROM (SELECT * FROM registry WHERE status = 'completed' AND triggered_by = 'ingest_completion'
ORDER BY record_timestamp DESC LIMIT 1) t""")
def latest_ingested_snapshot(bed: Bed) -> DataFrame:
    return registry.latest_ingested_snapshot(bed.registry)


@check("O04", f"SELECT {_LOG_ROW} FROM (SELECT * FROM registry WHERE status LIKE '%ed' ORDER BY record_timestamp DESC LIMIT 10) t")
def recent_snapshots(bed: Bed) -> DataFrame:
    return registry.recent_snapshots(bed.registry, 10, "%ed")


@check("O05", f"""SELECT {ts("snapshot_id")}, strftime(min(record_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_completed
FROM registry WHERE status = 'completed' GROUP BY snapshot_id""")
def completed_snapshots(bed: Bed) -> DataFrame:
    return registry.completed_snapshots(bed.registry)


@check("O06", """SELECT event_type, array_to_string(list_slice(list_sort(list(DISTINCT props)), 1, 5), '|') AS sample_values
FROM events GROUP BY event_type""")
def distinct_value_samples(bed: Bed) -> DataFrame:
    values = bed.table("events").select("event_type", "props").distinct()
    return sample_values(values, ["event_type"], "props")


@check("O07", """SELECT event_type, event_id FROM (
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) t WHERE n <= 10""")
def limited_objects(bed: Bed) -> DataFrame:
    rows = bed.table("events").select("event_type", "event_id")
    return limit_per_object(rows, 10, "event_type", ["event_id"])


@check("O08", "SELECT owner_id, combined_stage, num_companies, total_score FROM history " + _AT_2000)
def scores_by_owner(bed: Bed) -> DataFrame:
    return registry.scores_by_owner(_at_2000(bed.history))


@check("O09", f"SELECT {ts('snapshot_id')} FROM (SELECT DISTINCT snapshot_id FROM registry) t")
def distinct_snapshots(bed: Bed) -> DataFrame:
    return registry.distinct_snapshots(bed.registry)


# -- set operations -----------------------------------------------------------------------------------


@check("U02", f"SELECT {ts('snapshot_id')} FROM (SELECT snapshot_id FROM companies EXCEPT SELECT snapshot_id FROM year_registry) t")
def unregistered_snapshots(bed: Bed) -> DataFrame:
    return integrity.unregistered_snapshots(bed.companies, bed.year_registry)


@check("U03", f"SELECT {ts('snapshot_id')} FROM (SELECT snapshot_id FROM year_registry EXCEPT SELECT snapshot_id FROM deals) t")
def registered_without_data(bed: Bed) -> DataFrame:
    return integrity.registered_without_data(bed.deals, bed.year_registry)


def _consistency(table: str) -> str:
    def part(kind: str, severity: str, left: str, right: str) -> str:
        return f"""SELECT '{table}' AS "table", 'snapshot_id' AS field, '{kind}' AS issue_type, '{severity}' AS severity, count(*) AS "count",
        array_to_string(list_slice(list_sort(list(strftime(snapshot_id, '%Y-%m-%d %H:%M:%S'))), 1, 5), '|') AS sample_values
        FROM (SELECT snapshot_id FROM {left} EXCEPT SELECT snapshot_id FROM {right}) x"""
    return part("unregistered_snapshot", "warning", table, "year_registry") + " UNION ALL " + part(
        "missing_snapshot_data", "info", "year_registry", table)


CONSISTENCY_SQL = f"SELECT * FROM ({_consistency('companies')} UNION ALL {_consistency('deals')}) c WHERE \"count\" > 0"


@check("U04", described(CONSISTENCY_SQL))
def snapshot_consistency(bed: Bed) -> DataFrame:
    return integrity.snapshot_consistency(bed.audited)

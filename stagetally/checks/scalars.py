"""Row functions over whole tables (survey section 2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetally.checks.aggregates import FORMAT_SQL, WRITTEN_ID_SQL, written_ids
from stagetally.checks.base import AS_OF, Bed, check
from stagetally.functions import events, records, snapshots, text


def _pairs(df: DataFrame, key: str, source, *rules) -> DataFrame:
    """Key, source text and each rule's result."""
    rows = df.select(F.col(key).alias("k"), source.alias("v"))
    return rows.select("k", "v", *[rule(F.col("v")).alias(name) for name, rule in rules])


@check("C01", """SELECT s_suppkey AS k, email AS v, lower(trim(email)) AS email FROM supplier JOIN reps ON owner_id = CAST(s_suppkey AS VARCHAR)""")
def normalize_email(bed: Bed) -> DataFrame:
    return bed.reps.select(
        F.col("owner_id").cast("bigint").alias("k"), F.col("email").alias("v"), text.normalize_email(F.col("email")).alias("email")
    )


# Event types with stray white space and capitals, blank for every fifth row.
_SPELLED = """CASE event_id % 5 WHEN 0 THEN '  ' WHEN 1 THEN upper(event_type) WHEN 2 THEN concat(' ', event_type, chr(9))
  WHEN 3 THEN concat(upper(event_type), ' ', event_type) END"""
_SPELLED_SQL = f"(SELECT event_id AS k, {_SPELLED} AS v FROM events) t"
_STRIP = "trim(v, concat(' ', chr(9)))"


def _spelled(bed: Bed, *rules) -> DataFrame:
    return _pairs(bed.table("events"), "event_id", F.expr(_SPELLED), *rules)


@check("C02", f"SELECT k, v, lower({_STRIP}) AS enum FROM {_SPELLED_SQL}")
def normalize_enum(bed: Bed) -> DataFrame:
    return _spelled(bed, ("enum", text.normalize_enum))


@check("C03", f"SELECT k, v, nullif(lower({_STRIP}), '') AS enum FROM {_SPELLED_SQL}")
def normalize_enum_null(bed: Bed) -> DataFrame:
    return _spelled(bed, ("enum", text.normalize_enum_null))


# Page addresses with the host in capitals; some without scheme, some bare domains.
_URL_PARTS = """regexp_extract(url, '^(https?)://([^/?#]*)(.*)$', {n})"""
_URL = f"""CASE page_id % 4
  WHEN 0 THEN concat(upper({_URL_PARTS.format(n=1)}), '://', upper({_URL_PARTS.format(n=2)}), upper({_URL_PARTS.format(n=3)}))
  WHEN 1 THEN concat('//', upper({_URL_PARTS.format(n=2)}), {_URL_PARTS.format(n=3)})
  WHEN 2 THEN concat(' ', upper({_URL_PARTS.format(n=2)}))
  ELSE concat(url, '?') END"""


@check("C04", f"""SELECT page_id AS k, {_URL} AS v, CASE page_id % 4
  WHEN 0 THEN concat({_URL_PARTS.format(n=1)}, '://', {_URL_PARTS.format(n=2)}, regexp_replace(upper({_URL_PARTS.format(n=3)}), '[?]$', ''))
  WHEN 1 THEN concat('//', {_URL_PARTS.format(n=2)}, {_URL_PARTS.format(n=3)})
  WHEN 2 THEN {_URL_PARTS.format(n=2)}
  ELSE CASE WHEN contains(url, '?') OR contains(url, '#') THEN concat(url, '?') ELSE url END END AS url
FROM pages""")
def normalize_url_domain(bed: Bed) -> DataFrame:
    return _pairs(bed.table("pages"), "page_id", F.expr(_URL), ("url", text.normalize_url_domain))


@check("C05", f"SELECT k, v, nullif(lower(trim(v)), '') AS url FROM (SELECT page_id AS k, {_URL} AS v FROM pages) t")
def normalize_url_full(bed: Bed) -> DataFrame:
    return _pairs(bed.table("pages"), "page_id", F.expr(_URL), ("url", text.normalize_url_full))


_NORMAL = ["lifecycle_stage", "lead_status", "company_type", "development_category", "hiring_developers",
           "inhouse_developers", "proff_likviditetsgrad", "proff_lonnsomhet", "proff_soliditet"]
_LINK_SQL = "replace(replace(proff_link, 'HTTPS://', 'https://'), 'Www.Example.COM', 'www.example.com')"


@check("C06", f"""SELECT company_id, company_name, owner_id, {", ".join(f"lower(trim({f})) AS {f}" for f in _NORMAL)},
{_LINK_SQL} AS proff_link, strftime(snapshot_id, '%Y') AS year FROM companies""")
def normalize_fields(bed: Bed) -> DataFrame:
    rows = records.normalize_fields(bed.companies, "companies")
    return rows.withColumn("year", F.date_format("snapshot_id", "yyyy")).drop("snapshot_id", "record_timestamp")


@check("C07", "SELECT owner_id, field, rule, value, lower(value) AS expected FROM (" + " UNION ALL ".join(
    f"SELECT owner_id, 'email' AS field, '{rule}' AS rule, email AS value FROM reps WHERE email <> lower(email) {extra}"
    for rule, extra in (("enum", ""), ("email", "AND contains(email, '@')"))) + ") v")
def validate_normalized(bed: Bed) -> DataFrame:
    return records.validate_normalized(bed.reps, "owners", ["owner_id"])


_STAGE_TEXT = """CASE c_mktsegment WHEN 'BUILDING' THEN ' Sales Qualified Lead' WHEN 'AUTOMOBILE' THEN 'LEAD'
  WHEN 'MACHINERY' THEN 'Closed-Won ' WHEN 'HOUSEHOLD' THEN '' END"""


@check("C08", f"""SELECT c_custkey AS k, {_STAGE_TEXT} AS v, CASE c_mktsegment WHEN 'BUILDING' THEN 'salesqualifiedlead'
WHEN 'AUTOMOBILE' THEN 'lead' WHEN 'MACHINERY' THEN 'closed-won' WHEN 'HOUSEHOLD' THEN '' END AS stage FROM customer""")
def normalize_lifecycle_stage(bed: Bed) -> DataFrame:
    return _pairs(bed.table("customer"), "c_custkey", F.expr(_STAGE_TEXT), ("stage", text.normalize_lifecycle_stage))


@check("C09", f"SELECT k, v, replace(lower({_STRIP}), ' ', '_') AS status FROM {_SPELLED_SQL}")
def normalize_lead_status(bed: Bed) -> DataFrame:
    return _spelled(bed, ("status", text.normalize_lead_status))


@check("C10", f"SELECT k, v, nullif({_STRIP}, '') AS clean, nullif(v, '') AS exact FROM {_SPELLED_SQL}")
def null_if_blank(bed: Bed) -> DataFrame:
    return _spelled(bed, ("clean", text.null_if_blank), ("exact", text.null_if_empty))


@check("C11", """SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS from_number,
CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN concat(o_orderkey, '.0') ELSE CAST(o_orderkey AS VARCHAR) END AS from_text
FROM orders""")
def clean_id(bed: Bed) -> DataFrame:
    key = F.col("o_orderkey")
    written = (
        F.when(key % 3 == 0, "  ")
        .when(key % 3 == 1, F.concat(F.lit(" "), key.cast("string"), F.lit(".0 ")))
        .otherwise(key.cast("string"))
    )
    return bed.table("orders").select(
        key.alias("k"),
        text.clean_id(key.cast("double") + 0.5, numeric=True).alias("from_number"),
        text.clean_id(written).alias("from_text"),
    )


_MONEY = """CASE o_orderkey % 6 WHEN 0 THEN concat('kr ', o_totalprice) WHEN 1 THEN concat('€', o_totalprice, ' ')
  WHEN 2 THEN concat('$1,', o_orderkey) WHEN 3 THEN 'abc' WHEN 4 THEN concat(o_orderkey, 'd') ELSE '' END"""


@check("C12", f"""SELECT o_orderkey AS k, {_MONEY} AS v, CASE WHEN o_orderkey % 6 < 2 THEN o_totalprice
WHEN o_orderkey % 6 = 2 THEN CAST(concat('1', o_orderkey) AS DOUBLE) END AS amount FROM orders""")
def parse_amount(bed: Bed) -> DataFrame:
    return _pairs(bed.table("orders"), "o_orderkey", F.expr(_MONEY), ("amount", text.parse_amount))


@check("C13", f"""SELECT o_orderkey AS k, {WRITTEN_ID_SQL} AS snapshot_id,
CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT06:00:00Z') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS canonical,
CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT06:00:00Z') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS migrated,
strftime(o_orderdate, '%Y-%m-%dT08:09:10Z') AS from_offset
FROM orders""")
def canonical_snapshot_id(bed: Bed) -> DataFrame:
    rows = written_ids(bed).join(bed.table("orders").select(F.col("o_orderkey").alias("k"), "o_orderdate"), "k")
    offset = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T08:09:10.5+02:00"))
    return rows.select(
        "k", "snapshot_id",
        snapshots.canonical_snapshot_id(F.col("snapshot_id")).alias("canonical"),
        snapshots.migrated_snapshot_id(F.col("snapshot_id")).alias("migrated"),
        snapshots.canonical_snapshot_id(offset).alias("from_offset"),
    )


@check("C14", f"SELECT k, {FORMAT_SQL} FROM (SELECT o_orderkey AS k, {WRITTEN_ID_SQL} AS snapshot_id FROM orders) t")
def snapshot_id_format(bed: Bed) -> DataFrame:
    rows = written_ids(bed).select("k", snapshots.snapshot_id_format(F.col("snapshot_id")).alias("f"))
    return rows.select("k", "f.*")


@check("C15", "SELECT owner_id, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS owner_name FROM reps")
def owner_display_name(bed: Bed) -> DataFrame:
    return bed.reps.select(
        "owner_id", text.owner_display_name(F.col("first_name"), F.col("last_name")).alias("owner_name")
    )


@check("C16", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS file_date FROM orders""")
def file_date(bed: Bed) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 4 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("today")
    name = F.concat(F.lit("weekly-status-"), day, F.lit("_v2.csv"))
    return bed.table("orders").select(F.col("o_orderkey").alias("k"), snapshots.file_date(name).alias("file_date"))


def event_payloads(bed: Bed, rescore: bool = False) -> DataFrame:
    """Queue messages built from events: base64, plain JSON, broken JSON, noise.

    With ``rescore`` the sign-up events ask for all snapshots to be scored.
    """
    key = F.col("event_id")
    year = F.make_date((key % 7 + 1995).cast("int"), F.lit(1), F.lit(1)).cast("timestamp")
    kind = (
        F.when(F.col("event_type") == "purchase", "crm.snapshot.completed")
        .when(F.col("event_type") == "error", "crm.snapshot.failed")
        .when((F.col("event_type") == "signup") & F.lit(rescore), "crm.rescore.all")
        .otherwise(F.concat(F.lit("crm."), F.col("event_type")))
    )
    body = F.to_json(
        F.struct(
            kind.alias("type"),
            F.struct(
                snapshots.format_snapshot_id(year).alias("snapshot_id"),
                F.create_map(F.lit("companies"), F.col("user_id")).alias("data_tables"),
            ).alias("data"),
        )
    )
    value = (
        F.when(key % 5 < 2, F.base64(body.cast("binary")))
        .when(key % 5 < 4, body)
        .when(key % 10 == 4, F.substring(body, 1, 20))
        .otherwise(F.lit("not a message"))
    )
    return bed.table("events").select(key.alias("k"), F.regexp_replace(value, r"[\r\n]+", "").alias("value"))


PAYLOAD_TYPE_SQL = """CASE event_type WHEN 'purchase' THEN 'crm.snapshot.completed' WHEN 'error' THEN 'crm.snapshot.failed'
  ELSE concat('crm.', event_type) END"""


@check("C17", f"""SELECT event_id AS k, CASE WHEN event_id % 5 < 4 THEN {PAYLOAD_TYPE_SQL} END AS type,
CASE WHEN event_id % 5 < 4 THEN concat(1995 + event_id % 7, '-01-01T00:00:00Z') END AS snapshot_id,
CASE WHEN event_id % 5 < 4 THEN user_id END AS companies, event_id % 5 < 4 AS valid FROM events""")
def parse_event(bed: Bed) -> DataFrame:
    rows = event_payloads(bed).select("k", events.parse_event(F.col("value")).alias("e"))
    return rows.select(
        "k", "e.type", "e.data.snapshot_id",
        F.try_element_at("e.data.data_tables", F.lit("companies")).alias("companies"),
        F.col("e").isNotNull().alias("valid"),
    )


def snapshot_counts(bed: Bed) -> DataFrame:
    """Companies and deals per snapshot as count maps."""
    rows = bed.companies.select("snapshot_id", F.lit(1).alias("c"), F.lit(0).alias("d")).unionByName(
        bed.deals.select("snapshot_id", F.lit(0).alias("c"), F.lit(1).alias("d"))
    )
    return rows.groupBy("snapshot_id").agg(F.sum("c").alias("companies"), F.sum("d").alias("deals"))


_STAMP_SQL = "2024-01-01T00:00:00.000000Z"


def _envelope_sql(kind: str, data: str) -> str:
    return f"""concat('{{"type":"{kind}","version":"1.0","timestamp":"{_STAMP_SQL}","source":"crm-ingest-dev","environment":"dev",',
      '"data":{{"snapshot_id":"', strftime(snapshot_id, '%Y-%m-%dT%H:%M:%SZ'), '","timestamp":"{_STAMP_SQL}",', {data}, '}}}}')"""


@check("C18", f"""
SELECT strftime(snapshot_id, '%Y') AS year, {_envelope_sql("crm.snapshot.completed", '''
  '"data_tables":{"companies":', c, ',"deals":', d, '},"reference_tables":{"owners":25},"metadata":{"triggered_by":"ingest_function",',
  '"environment":"dev","target_environment":"dev","total_data_records":', c + d, ',"total_reference_records":25,"function_name":"unknown"}' ''')} AS completed,
  {_envelope_sql("crm.snapshot.failed", '''
  '"error_message":"lost ', d, ' deals","metadata":{"triggered_by":"ingest_function","environment":"dev","function_name":"unknown"}' ''')} AS failed
FROM (SELECT snapshot_id, CAST(sum(c) AS BIGINT) AS c, CAST(sum(d) AS BIGINT) AS d
      FROM (SELECT snapshot_id, 1 AS c, 0 AS d FROM companies UNION ALL SELECT snapshot_id, 0, 1 FROM deals) u GROUP BY 1) s""")
def build_events(bed: Bed) -> DataFrame:
    now = F.lit(AS_OF).cast("timestamp")
    snapshot = snapshots.format_snapshot_id(F.col("snapshot_id"))
    data = F.create_map(F.lit("companies"), F.col("companies"), F.lit("deals"), F.col("deals"))
    reference = F.create_map(F.lit("owners"), F.lit(25).cast("bigint"))
    message = F.concat(F.lit("lost "), F.col("deals").cast("string"), F.lit(" deals"))
    return snapshot_counts(bed).select(
        F.date_format("snapshot_id", "yyyy").alias("year"),
        events.build_completed_event(snapshot, data, reference, now, "dev").alias("completed"),
        events.build_failed_event(snapshot, message, now, "dev").alias("failed"),
    )


@check("C19", """SELECT event_id AS k, concat(coalesce(CASE WHEN event_id % 3 > 0 THEN props END, ''), ' | ', event_type) AS notes FROM events""")
def append_note(bed: Bed) -> DataFrame:
    old = F.when(F.col("event_id") % 3 > 0, F.col("props"))
    return bed.table("events").select(
        F.col("event_id").alias("k"), text.append_note(old, F.col("event_type")).alias("notes")
    )


@check("C20", """SELECT CAST(event_id AS VARCHAR) AS event_id, concat('["', event_type, '","', user_id, '"]') AS tags,
concat('{"kind":"', event_type, '","user":', user_id, '}') AS detail FROM events""")
def stringify_complex(bed: Bed) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    return records.stringify_complex(
        bed.table("events").select(
            "event_id",
            F.array(kind, user.cast("string")).alias("tags"),
            F.struct(kind.alias("kind"), user.alias("user")).alias("detail"),
        )
    )


@check("C21", """SELECT event_id AS k, event_id % 4 IN (0, 1) AS from_text, user_id % 2 = 0 AS from_bool FROM events""")
def bool_from_text(bed: Bed) -> DataFrame:
    key = F.col("event_id")
    word = F.when(key % 4 == 0, "TRUE").when(key % 4 == 1, "true").when(key % 4 == 2, "yes")
    return bed.table("events").select(
        key.alias("k"),
        text.bool_from_text(word).alias("from_text"),
        text.bool_from_text(F.col("user_id") % 2 == 0).alias("from_bool"),
    )

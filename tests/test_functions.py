import pytest
from pyspark.sql import functions as F

from stagetally.functions import events, records, snapshots, text
from stagetally.operators.exports import resolve_columns, resolve_owner_names, similar_column
from stagetally.operators.sampling import limit_per_object, sample_values
from stagetally.schemas import DEAL_EXPORT_COLUMNS
from stagetally.session import literal_table


def apply(spark, rule, values):
    df = literal_table(spark, list(enumerate(values)), "i bigint, v string")
    return [r[0] for r in df.select(rule(F.col("v")).alias("r"), "i").orderBy("i").collect()]


def test_url_domain(spark):
    cases = {
        "HTTP://Foo.COM/Path?Q=A": "http://foo.com/Path?Q=A",
        "  WWW.Example.COM/Path ": "www.example.com/path",
        "//CDN.Example.com/A": "//cdn.example.com/A",
        "https://A.com/x?": "https://a.com/x",
        "https://A.com/X#": "https://a.com/X",
        "https://A.com/X#a#": "https://a.com/X#a#",
        "https://A.com/x;?q=1": "https://a.com/x?q=1",
        "https://A.com/x;p=1": "https://a.com/x;p=1",
        "Foo.com:8080/Path": "foo.com:8080/Path",
        "http://[::1/Path": "http://[::1/Path",
        "": "",
    }
    assert apply(spark, text.normalize_url_domain, cases) == list(cases.values())
    assert apply(spark, text.normalize_url_domain, [None]) == [None]


def test_url_full(spark):
    assert apply(spark, text.normalize_url_full, ["HTTP://Foo.COM/Path?Q=A", " "]) == ["http://foo.com/path?q=a", None]


def test_amounts(spark):
    given = ["kr 1,234.50", "€5", "abc", "", "12d", "-3.5", "1e3", None]
    assert apply(spark, text.parse_amount, given) == [1234.5, 5.0, None, None, None, -3.5, 1000.0, None]


def test_blank_rules(spark):
    given = ["", " \t", " A b ", None]
    assert apply(spark, text.normalize_enum, given) == ["", "", "a b", None]
    assert apply(spark, text.normalize_enum_null, given) == [None, None, "a b", None]
    assert apply(spark, text.null_if_empty, given) == [None, " \t", " A b ", None]
    assert apply(spark, text.normalize_lead_status, ["Attempted to Contact "]) == ["attempted_to_contact"]


@pytest.mark.parametrize("rule", [text.normalize_enum_null, text.null_if_blank, text.normalize_url_full])
def test_null_rules_are_idempotent(spark, rule):
    given = ["", "  X y", "HTTP://A.b/C ", None]
    assert apply(spark, lambda c: rule(rule(c)), given) == apply(spark, rule, given)


def test_snapshot_ids(spark):
    as_of = F.lit("2025-01-02T03:04:05Z").cast("timestamp")
    cases = {
        "2025-06-08": "2025-06-08T06:00:00Z",
        "2025-06-08T01:02:03.5Z": "2025-06-08T01:02:03Z",
        "2025-06-08T01:02:03Z": "2025-06-08T01:02:03Z",
        "2025-06-08T01:02:03+02:00": "2025-06-08T01:02:03Z",
        "2025-06-08 01:02": "2025-06-08T01:02:00Z",
        "no id": "2025-01-02T03:04:05Z",
        "": "2025-01-02T03:04:05Z",
    }
    assert apply(spark, lambda c: snapshots.canonical_snapshot_id(c, as_of), cases) == list(cases.values())
    moved = apply(spark, snapshots.migrated_snapshot_id, ["2025-06-08T01:02:03", "2025-06-08", "2025-06-08T01:02:03.5Z"])
    assert moved == ["2025-06-08T06:00:00Z", "2025-06-08T06:00:00Z", "2025-06-08T01:02:03Z"]


def test_snapshot_formats(spark):
    given = ["2025-06-08", "2025-06-08T01:02:03", "2025-06-08T01:02:03Z", "2025-06-08T01:02:03.000000Z", "x"]
    kinds = [r["format_type"] for r in apply(spark, snapshots.snapshot_id_format, given)]
    assert kinds == ["date_only", "datetime_no_tz", "datetime_utc", "datetime_microseconds_utc", "custom"]


def test_messages(spark):
    import base64

    body = '{"type":"crm.snapshot.completed","data":{"snapshot_id":"s","data_tables":{"deals":2}}}'
    given = [base64.b64encode(body.encode()).decode(), body, body[:-1], "noise", None]
    found = apply(spark, events.parse_event, given)
    assert [f and f["data"]["data_tables"] for f in found] == [{"deals": 2}, {"deals": 2}, None, None, None]


def test_envelope_round_trip(spark):
    now = F.lit("2025-01-01T00:00:00Z").cast("timestamp")
    counts = F.create_map(F.lit("deals"), F.lit(3).cast("bigint"))
    event = events.build_completed_event(F.lit("s"), counts, counts, now, "dev")
    back = spark.range(1).select(events.parse_event(event).alias("e")).first()["e"]
    assert back["type"] == "crm.snapshot.completed" and back["data"]["metadata"]["total_data_records"] == "3"


def test_validation_reports_each_rule(spark):
    df = literal_table(spark, [("1", "A@b.c"), ("2", "a@b.c"), ("3", "NOAT")], "owner_id string, email string")
    found = records.validate_normalized(df, "owners", ["owner_id"])
    assert sorted((r["owner_id"], r["rule"]) for r in found.collect()) == [("1", "email"), ("1", "enum"), ("3", "enum")]


def test_similar_columns():
    assert similar_column("Deal Name", ["Record ID", "deal_name"]) == "deal_name"
    assert similar_column("Company ID", ["Associated Company IDs (Primary)"]) == "Associated Company IDs (Primary)"
    assert similar_column("Amount", ["Stage"]) is None


def test_last_alias_wins_even_with_null():
    header = ["Record ID", "Deal Name", "Deal Stage", "Deal owner", "Amount", "Deal Type"]
    chosen = resolve_columns(header, DEAL_EXPORT_COLUMNS, allow_similar=True)
    assert chosen["owner_id"] == "Deal owner" and chosen["associated_company_id"] is None
    exact_only = resolve_columns(header, DEAL_EXPORT_COLUMNS, allow_similar=False)
    assert exact_only["deal_name"] is None


def test_owner_names_against_brute_force(spark):
    lookup = [("anna berg", "1"), ("bo", "2"), ("carl bo dahl", "3"), ("anna", "4")]
    names = ["Anna Berg", " BO ", "anna", "Carl", "carl bo dahl jr", "berg", "  ", "nobody", None, "x" * 300, "annabo"]

    def brute(name):
        if name is None:
            return None
        key = name.lower().strip()
        exact = dict(lookup).get(key)
        return exact or next((i for n, i in lookup if key in n or n in key), name)

    df = literal_table(spark, list(enumerate(names)), "i bigint, owner string")
    table = literal_table(spark, [(n, i, r) for r, (n, i) in enumerate(lookup)], "name string, owner_id string, rank bigint")
    found = resolve_owner_names(df, "owner", table).orderBy("i").collect()
    assert [r["owner"] for r in found] == [brute(n) for n in names]


def test_samples_and_limits(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    found = {r["k"]: r["sample_values"] for r in sample_values(df, ["k"], "v", 3).collect()}
    assert found[1] == ["0001", "0004", "0007"]
    assert limit_per_object(df, 5, "k", ["v"]).count() == 15
    assert limit_per_object(df, 0, "k", ["v"]).count() == 1000

"""Heavy companies, ranks and owner rows: results against plain plans, and plans against skew."""

import re
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stagetally.operators import history, scoring
from stagetally.operators.ranking import numbered_in_groups
from stagetally.plans import report, score
from stagetally.session import literal_table
from tests.fixtures import AS_OF, S1, S2, company, deal, stages, table


@pytest.fixture
def crowd(spark):
    """Half of all open deals on one company, another heavy one, repeated companies, NULL keys, unknown companies."""
    rng = random.Random(3)
    companies = [company(str(i), "opportunity", s) for i in range(30) for s in (S1, S2)] + [company("0", "lead", S1), company(None, "lead", S1)]
    deals = [deal(f"h{i}", "0", "qualifiedtobuy") for i in range(400)] + [deal(f"g{i}", "1", "presentationscheduled") for i in range(90)]
    deals += [deal(f"c{i}", "2", "closedlost") for i in range(200)]
    deals += [deal(f"d{i}", rng.choice([None, "x", *map(str, range(3, 25))]), "qualifiedtobuy", rng.choice([S1, S2])) for i in range(300)]
    deals += [deal("h1", "0", "qualifiedtobuy")] * 3
    return table(spark, "companies", companies), table(spark, "deals", deals), stages(spark)


def test_heavy_companies_are_counted_once_and_bounded(spark, crowd):
    _, deals, ref = crowd
    prepared = scoring.prepared_deals(deals, ref)
    heavy = {r["company_key"].split("/")[1]: r["salts"] for r in scoring.heavy_companies(prepared, least_rows=50).collect()}
    assert heavy == {"0": 16, "1": 2}
    assert scoring.heavy_companies(prepared, least_rows=50, most=1).count() == 1
    assert scoring.heavy_companies(prepared).count() == 0


@pytest.mark.parametrize("least", [3, 50, 10**6])
def test_salted_join_is_the_left_join(spark, crowd, least):
    companies, deals, ref = crowd
    left, right = scoring.prepared_companies(companies), scoring.prepared_deals(deals, ref)
    found = scoring.companies_with_deals(left, right, scoring.heavy_companies(right, least_rows=least))
    plain = scoring.companies_with_deals(left, right)
    other = right.select("deal_id", "deal_stage", "deal_flag", "associated_company_id", F.col("snapshot_id").alias("s"))
    want = left.join(other, (left.company_id == other.associated_company_id) & (left.snapshot_id == other.s), "left").select(*plain.columns)
    assert sorted(map(str, found.select(*plain.columns).collect())) == sorted(map(str, want.collect())) == sorted(map(str, plain.collect()))


def test_a_heavy_company_is_spread_over_tasks(spark, crowd):
    companies, deals, ref = crowd
    left, right = scoring.prepared_companies(companies), scoring.prepared_deals(deals, ref)
    heavy = scoring.heavy_companies(right, least_rows=50)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = scoring.companies_with_deals(left, right, heavy)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        per_task = [r["count"] for r in joined.filter("company_id = '0'").groupBy(F.spark_partition_id()).count().collect()]
        unsalted = scoring.companies_with_deals(left, right).filter("company_id = '0'")
        assert unsalted.groupBy(F.spark_partition_id()).count().count() <= 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(per_task) >= 8 and max(per_task) < 200
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 4 and "LeftAnti" not in plan


def test_the_join_of_stored_tables_reads_each_once(spark, crowd, warehouse):
    companies, deals, ref = crowd
    for name, df in (("companies", companies), ("deals", deals), ("deal_stage_reference", ref)):
        warehouse.append_table(df, name)
    right = scoring.prepared_deals(warehouse.read("deals"), warehouse.read("deal_stage_reference"))
    heavy = scoring.heavy_companies(right, least_rows=50)
    joined = scoring.companies_with_deals(scoring.prepared_companies(warehouse.read("companies")), right, heavy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"FileScan", plan)) == 3  # companies, deals, and the small stage reference
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 4


def test_numbers_within_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aaaaaab"), rng.randrange(40), i) for i in range(700)] + [(None, 1, 1000), (None, None, 1001)]
    df = literal_table(spark, rows, "g string, v bigint, i bigint")
    order = [F.col("v").desc(), F.col("i")]
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    for ranges in (1, 7):
        found = numbered_in_groups(df, ["g"], order, "n", ranges)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert numbered_in_groups(df.limit(0), ["g"], order, "n").count() == 0


def test_a_group_with_most_rows_is_numbered_in_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("a").alias("g"), (F.col("id") * 7919 % 20_000).alias("v"))
    found = numbered_in_groups(df, ["g"], [F.col("v")], "n", 10)
    assert found.filter("n <> v + 1").count() == 0
    assert "hashpartitioning(g" not in found._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    stored = df.repartitionByRange(10, "g", "v").groupBy(F.spark_partition_id()).count()
    assert stored.agg(F.max("count")).first()[0] < 6000


def owners(spark):
    rows = [("o1", "a@x", "A", None), ("o1", "a@x", "A", None), ("o2", "b@x", "B", "C"), ("o2", "b2@x", "B", "C"), ("o9", None, None, None)]
    return table(spark, "owners", [{"owner_id": i, "email": e, "first_name": f, "last_name": n, "record_timestamp": S1} for i, e, f, n in rows])


def full(warehouse, spark):
    for s in (S1, S2):
        rows = [company("1", "opportunity", s, company_type="Customer"), company("2", "SalesQualifiedLead", s, owner_id="o2"),
                company("3", "lead", s, owner_id=None), company("4", "disqualified", s, owner_id="o9"), company("5", "lead", s, owner_id="o7")]
        warehouse.append_table(table(spark, "companies", rows), "companies")
        warehouse.append_table(table(spark, "deals", [deal(f"a{s}", "1", "qualifiedtobuy", s, deal_type="New Business"),
                                                      deal(f"b{s}", "1", "presentationscheduled", s)]), "deals")
    warehouse.append_table(stages(spark), "deal_stage_reference")
    warehouse.append_table(owners(spark), "owners")


def same(warehouse):
    kept = report.owner_history_report(warehouse)
    plain = report.owner_history_report(warehouse, stored=False)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    return kept.count()


def test_owner_rows_give_the_report_of_all_units(spark, warehouse):
    full(warehouse, spark)
    score.score_snapshots(warehouse, [S1, S2], AS_OF)
    assert report.stored_owner_rows_cover(warehouse) and same(warehouse) > 6
    warehouse.replace_table(owners(spark).filter("owner_id <> 'o1'"), "owners")
    changed = [company("1", "lead", S2, lead_status="new", owner_id="o2")]
    warehouse.replace_snapshots(table(spark, "companies", changed), "companies", [S2])
    score.score_snapshots(warehouse, [S2], AS_OF)
    same(warehouse)


def test_units_without_owner_rows_are_read_in_full(spark, warehouse):
    full(warehouse, spark)
    score.score_snapshots(warehouse, [S1], AS_OF)
    warehouse.append_table(table(spark, "pipeline_units_snapshot", [
        {"company_id": "1", "owner_id": "o1", "stage_level": 4, "adjusted_score": 6.0, "snapshot_id": S2, "record_timestamp": S2}]), "pipeline_units_snapshot")
    assert not report.stored_owner_rows_cover(warehouse)
    same(warehouse)
    assert report.register_report_view(warehouse, "vw_test").count() == spark.table("vw_test").count() > 0


def test_rescoring_a_snapshot_reads_that_snapshot(spark, warehouse, monkeypatch):
    full(warehouse, spark)
    score.score_snapshots(warehouse, [S1, S2], AS_OF)
    whole = type(warehouse).read
    seen = []
    monkeypatch.setattr(type(warehouse), "read_snapshots", lambda self, name, ids: seen.append((name, len(list(ids)))) or whole(self, name).filter(F.col("snapshot_id").isin(list(ids))))
    monkeypatch.setattr(type(warehouse), "read", lambda self, name: seen.append((name, None)) or whole(self, name))
    score.score_snapshots(warehouse, [S2], AS_OF)
    facts = [s for s in seen if s[0] in ("companies", "deals", "pipeline_units_snapshot", "pipeline_owner_rows")]
    assert facts and all(n == 1 for _, n in facts)


def test_ranks_of_the_history(spark):
    rows = literal_table(spark, [(S, "a", 1.0) for S in "xy"] + [("x", "b", 3.0), ("x", None, 1.0)], "snapshot_id string, owner_id string, total_score double")
    found = {(r[0], r[1]): r[3] for r in history.owner_rank(rows).collect()}
    assert found == {("x", "b"): 1, ("x", None): 2, ("x", "a"): 3, ("y", "a"): 1}

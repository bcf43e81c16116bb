"""The owner history report: enrichment, aggregates, rank and change over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagetally.functions.text import owner_display_name
from stagetally.operators.distinct import distinct_aggregate
from stagetally.operators.ranking import numbered_in_groups
from stagetally.schemas import OWNER_ROWS

OWNER_KEYS = ["snapshot_id", "record_timestamp", "owner_id", "owner_email", "owner_name"]


def with_companies(units: DataFrame, companies: DataFrame) -> DataFrame:
    """Company attributes as of the unit's own snapshot."""
    side = companies.select(
        F.col("company_id").alias("_id"),
        F.col("snapshot_id").alias("_snapshot"),
        "company_type",
        "company_name",
        "development_category",
        "hiring_developers",
        "inhouse_developers",
    )
    match = (units["company_id"] == side["_id"]) & (units["snapshot_id"] == side["_snapshot"])
    return units.join(side, match, "left").drop("_id", "_snapshot")


def with_deals(units: DataFrame, deals: DataFrame) -> DataFrame:
    """Deal attributes as of the unit's own snapshot.

    Most units may have no deal.  Their NULL key would send a whole snapshot to
    one task, so the key also says whether there is a deal and holds the
    company otherwise: those rows spread by company and still match nothing.
    """

    def key(has_deal, value):
        return F.struct(has_deal.alias("has_deal"), value.alias("id"))

    side = deals.filter("deal_id IS NOT NULL").select(
        key(F.lit(True), F.col("deal_id")).alias("_id"),
        F.col("snapshot_id").alias("_snapshot"),
        "deal_type",
        "deal_name",
        F.col("amount").alias("deal_amount"),
    )
    wanted = key(F.col("deal_id").isNotNull(), F.coalesce("deal_id", "company_id"))
    units = units.withColumn("_key", wanted)
    match = (units["_key"] == side["_id"]) & (units["snapshot_id"] == side["_snapshot"])
    return units.join(side, match, "left").drop("_id", "_snapshot", "_key")


def with_owners(units: DataFrame, owners: DataFrame) -> DataFrame:
    """Current owner e-mail and display name."""
    side = owners.select(
        F.col("owner_id").alias("_id"),
        F.col("email").alias("owner_email"),
        F.col("first_name").alias("_first"),
        F.col("last_name").alias("_last"),
    )
    return (
        units.join(side, units["owner_id"] == side["_id"], "left")
        .withColumn("owner_name", owner_display_name(F.col("_first"), F.col("_last")))
        .drop("_id", "_first", "_last")
    )


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


LISTS = {
    "company_types": "company_type",
    "deal_types": "deal_type",
    "development_categories": "development_category",
    "hiring_status": "hiring_developers",
}
DISTINCT = {"total_companies": "company_id", "total_deals": "deal_id"}
SUMS = [
    f.name
    for f in OWNER_ROWS
    if f.name not in ("owner_id", "snapshot_id", "record_timestamp", *LISTS, *DISTINCT)
]


def _measures() -> dict[str, Column]:
    """What is summed per owner and snapshot."""
    level, score = F.col("stage_level"), F.col("adjusted_score")
    bands = {
        "nurturing": level == 0,
        "lead": level.between(1, 3),
        "sql": level == 4,
        "opportunity": level.between(5, 8),
    }
    company_types = ["Prospect", "Customer", "Partner", "Vendor"]
    deal_types = {"new_business": "New Business", "existing_business": "Existing Business"}
    return {
        "total_score": score,
        "scored_units": _one_if(score.isNotNull()),
        "total_deal_value": F.coalesce("deal_amount", F.lit(0.0)),
        **{f"{band}_count": _one_if(test) for band, test in bands.items()},
        **{f"{band}_score": F.when(test, score).otherwise(0.0) for band, test in bands.items()},
        **{f"{t.lower()}_count": _one_if(F.col("company_type") == t) for t in company_types},
        "companies_with_deals": _one_if(F.col("deal_type").isNotNull()),
        **{f"{n}_count": _one_if(F.col("deal_type") == t) for n, t in deal_types.items()},
    }


def _finished(rows: DataFrame) -> DataFrame:
    """Report columns of owner rows that have names and all sums."""
    average = F.when(F.col("scored_units") > 0, F.col("total_score") / F.col("scored_units"))
    return rows.withColumn("avg_score_per_unit", average).select(
        *OWNER_KEYS,
        *LISTS,
        *DISTINCT,
        "total_score",
        "avg_score_per_unit",
        *[name for name in SUMS if name not in ("total_score", "scored_units")],
    )


def owner_aggregates(units: DataFrame) -> DataFrame:
    """Everything the report shows per owner and snapshot, of units with company, deal and owner columns."""
    return _finished(distinct_aggregate(units, OWNER_KEYS, DISTINCT, LISTS, _measures()))


def owner_rows(units: DataFrame) -> DataFrame:
    """The same measures of units without owner columns, in the shape that is stored per snapshot.

    Names are left out, because they may change without a snapshot being scored anew.
    """
    keys = ["snapshot_id", "record_timestamp", "owner_id"]
    return distinct_aggregate(units, keys, DISTINCT, LISTS, _measures()).select(*OWNER_ROWS.names)


def named_owner_rows(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """``owner_aggregates`` from stored owner rows and the current owners.

    An owner listed twice under one name has every unit twice in the plain
    join, so its sums are multiplied; under two names it has two rows.
    """
    named = with_owners(owners.select("owner_id").distinct(), owners).select("owner_id", "owner_email", "owner_name")
    named = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("_times"))
    side = named.select(F.col("owner_id").alias("_id"), "owner_email", F.col("owner_name").alias("_name"), "_times")
    joined = rows.join(side, rows["owner_id"] == side["_id"], "left")
    unknown = owner_display_name(F.lit(None).cast("string"), F.lit(None).cast("string"))
    times = F.coalesce("_times", F.lit(1).cast("bigint"))
    joined = joined.withColumns(
        {"owner_name": F.when(F.col("_id").isNull(), unknown).otherwise(F.col("_name")), **{c: F.col(c) * times for c in SUMS}}
    )
    return _finished(joined)


def snapshot_totals(owner_rows: DataFrame) -> DataFrame:
    return owner_rows.groupBy("snapshot_id", "record_timestamp").agg(
        F.count_distinct("owner_id").alias("active_owners"),
        F.sum("total_companies").alias("total_companies_all_owners"),
        F.sum("total_score").alias("total_score_all_owners"),
        F.avg("total_score").alias("avg_score_per_owner"),
    )


def with_snapshot_totals(owner_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Totals joined by snapshot alone.

    A snapshot with several load times therefore repeats its owner rows once
    per load time, as the stored report does.
    """
    totals = totals.drop("record_timestamp")
    return owner_rows.join(totals, "snapshot_id", "inner")


def _last_resort(df: DataFrame, *first: str) -> list[str]:
    """Columns that tell rows of one owner apart, as far as they are there."""
    return [c for c in (*first, "owner_email", "owner_name") if c in df.columns]


def owner_rank(df: DataFrame) -> DataFrame:
    """Rank inside the snapshot by score; ties go to the smaller owner id, then to the earlier load and smaller name.

    The rows are computed here and dealt by snapshot and score, so a snapshot
    with most of the owners is not sorted in one task.
    """
    order = [F.col("total_score").desc(), F.col("owner_id").asc_nulls_first(), *_last_resort(df, "record_timestamp")]
    return numbered_in_groups(df, ["snapshot_id"], order, "owner_rank_in_snapshot")


def previous_period(df: DataFrame) -> DataFrame:
    """Score, companies and load time of the owner's previous row."""
    w = Window.partitionBy("owner_id").orderBy("record_timestamp", "snapshot_id", *_last_resort(df))
    return df.withColumns(
        {
            f"previous_{c}": F.lag(c).over(w)
            for c in ("total_score", "total_companies", "record_timestamp")
        }
    )


def period_change(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "score_change_from_previous": F.col("total_score") - F.col("previous_total_score"),
            "company_change_from_previous": F.col("total_companies")
            - F.col("previous_total_companies"),
        }
    )


def period_change_percent(df: DataFrame) -> DataFrame:
    """Percent change to two digits; NULL without a previous score or when it is 0."""
    previous = F.col("previous_total_score")
    percent = F.when(
        previous != 0, F.round((F.col("total_score") - previous) / previous * 100, 2)
    )
    return df.withColumn("score_change_percent", percent)


def report_order(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.col("record_timestamp").desc(), F.col("total_score").desc(), F.col("owner_id")
    )

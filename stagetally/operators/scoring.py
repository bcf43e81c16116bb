"""Unit scoring: companies and their open deals to scored pipeline units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetally.schemas import SCORE_HISTORY, STAGE_MAPPING, STAGE_MAPPING_ROWS, UNITS
from stagetally.session import literal_table


def stage_mapping(spark: SparkSession, as_of) -> DataFrame:
    """The fixed scoring rows, stamped with a load time."""
    return literal_table(spark, [(*row, as_of) for row in STAGE_MAPPING_ROWS], STAGE_MAPPING)


# -- expressions -----------------------------------------------------------------------


def combined_stage(lifecycle: Column, lead_status: Column, deal_stage: Column) -> Column:
    """One stage name from the normalised lifecycle, lead status and deal stage."""
    return (
        F.when(
            lifecycle == "lead",
            F.concat(F.lit("lead/"), F.coalesce(F.nullif(lead_status, F.lit("")), F.lit("unknown"))),
        )
        .when(
            lifecycle == "opportunity",
            F.concat(F.lit("opportunity/"), F.coalesce(F.nullif(deal_stage, F.lit("")), F.lit("missing"))),
        )
        .when(lifecycle.isin("salesqualifiedlead", "sales qualified lead"), "salesqualifiedlead")
        .when(lifecycle == "closed-won", "closed-won")
        .when(lifecycle == "disqualified", "disqualified")
        .otherwise("unmapped")
    )


def stage_source(deal_id: Column) -> Column:
    return F.when(deal_id.isNull(), "company").otherwise("deal")


def _lowered(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def _status_key(c: Column) -> Column:
    return _lowered(F.replace(c, F.lit(" "), F.lit("_")))


def company_normalized(lifecycle: Column, lead_status: Column) -> Column:
    """1 when scoring had to change either company field."""
    changed = (lifecycle != _lowered(lifecycle)) | (lead_status != _status_key(lead_status))
    return F.when(changed, 1).otherwise(0)


def deal_normalized(deal_stage: Column) -> Column:
    return F.when(deal_stage != _lowered(deal_stage), 1).otherwise(0)


def normalization_applied(company_flag: Column, deal_flag: Column) -> Column:
    return F.greatest(company_flag, F.coalesce(deal_flag, F.lit(0)))


# -- joins -------------------------------------------------------------------------------


def deals_with_stage(deals: DataFrame, stages: DataFrame) -> DataFrame:
    """Deals with their stage row, matched without regard to case.

    No hint: a reference table below the broadcast threshold is broadcast by
    its measured size, anything larger becomes a sort-merge join whose deal
    side AQE can split.
    """
    closed = stages.select(F.lower("stage_id").alias("_stage"), "is_closed")
    return deals.join(closed, F.lower(deals["deal_stage"]) == closed["_stage"], "left").drop("_stage")


def open_deals(staged: DataFrame) -> DataFrame:
    """Deals that are not closed; an unknown stage counts as open."""
    return staged.filter(~F.coalesce(F.col("is_closed"), F.lit(False)))


def heavy_companies(deals: DataFrame, least_rows: int = 500_000, most: int = 10_000) -> DataFrame:
    """Companies of a snapshot with ``least_rows`` deals or more, and how many parts their deals are dealt into.

    ``(company_key, salts)``, from one count of the deals; the ``most`` heaviest
    of them, so the result, a local table, has a bounded size.  ``salts`` are
    powers of two, about one for every ``least_rows`` deals.
    """
    counts = deals.filter("associated_company_id IS NOT NULL").groupBy(
        _company_key(F.col("associated_company_id"), F.col("snapshot_id")).alias("company_key")
    )
    heavy = counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_rows)
    rows = heavy.orderBy(F.col("n").desc(), "company_key").limit(most).collect()
    salted = [(r["company_key"], max(2, 1 << (-(-r["n"] // least_rows) - 1).bit_length())) for r in rows]
    return literal_table(deals.sparkSession, salted, "company_key string, salts int")


def _company_key(company: Column, snapshot: Column) -> Column:
    return F.concat_ws("/", F.unix_micros(snapshot).cast("string"), company)


def _salts(company: Column, snapshot: Column, heavy: DataFrame | None) -> Column:
    """Parts a company's deals are dealt into; 1 for all that are not heavy."""
    by_salts: dict[int, list[str]] = {}
    for row in heavy.collect() if heavy is not None else []:
        by_salts.setdefault(row["salts"], []).append(row["company_key"])
    key, one = _company_key(company, snapshot), F.lit(1)
    for salts, keys in sorted(by_salts.items()):
        one = F.when(key.isin(keys), salts).otherwise(one)
    return one


def companies_with_deals(companies: DataFrame, deals: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Every company of a snapshot with each of its open deals, or alone.

    One left join.  A company may hold a large share of all deals, and neither
    a hash partition nor AQE can split the right side of a left join by
    itself.  So the deals of a company in ``heavy`` (see
    :func:`heavy_companies`, of these very deals) are dealt into parts by their
    hash, and the company's row is repeated for each part; parts that got no
    deal leave no row.  All other rows have one part.
    """
    salts = _salts(F.col("_company"), F.col("_snapshot"), heavy)
    deals = deals.select(
        "deal_id",
        "deal_stage",
        "deal_flag",
        F.col("associated_company_id").alias("_company"),
        F.col("snapshot_id").alias("_snapshot"),
        F.lit(True).alias("_dealt"),
    )
    if heavy is None:
        joined = companies.join(
            deals, (companies["company_id"] == deals["_company"]) & (companies["snapshot_id"] == deals["_snapshot"]), "left"
        )
        return joined.drop("_company", "_snapshot", "_dealt")
    deals = deals.withColumn("_part", F.pmod(F.xxhash64("deal_id", "deal_stage"), salts).cast("int"))
    parts = _salts(F.col("company_id"), F.col("snapshot_id"), heavy)
    sides = companies.withColumn("_side", F.explode(F.sequence(F.lit(0), parts - 1)))
    sides = sides.withColumn("_heavy", parts > 1)
    same = (
        (sides["company_id"] == deals["_company"])
        & (sides["snapshot_id"] == deals["_snapshot"])
        & (sides["_side"] == deals["_part"])
    )
    joined = sides.join(deals, same, "left").filter("_dealt OR NOT coalesce(_heavy, false)")
    return joined.drop("_company", "_snapshot", "_dealt", "_part", "_side", "_heavy")


def with_scores(units: DataFrame, mapping: DataFrame, dedupe_mapping: bool = False) -> DataFrame:
    """Stage level and score by combined stage; unmapped stages get 0 and 0.0.

    A combined stage listed twice in the mapping yields every unit twice, as
    stored scores expect; ``dedupe_mapping`` keeps one row per stage instead.
    """
    rows = mapping.select(
        F.lower("combined_stage").alias("_stage"),
        F.col("stage_level").alias("_level"),
        F.col("adjusted_score").alias("_score"),
    )
    if dedupe_mapping:
        rows = (
            rows.groupBy("_stage")
            .agg(F.min(F.struct("_level", "_score")).alias("_row"))
            .select("_stage", "_row.*")
        )
    return (
        units.join(rows, F.lower(units["combined_stage"]) == rows["_stage"], "left")
        .withColumn("stage_level", F.coalesce("_level", F.lit(0).cast("bigint")))
        .withColumn("adjusted_score", F.coalesce("_score", F.lit(0.0)))
        .drop("_stage", "_level", "_score")
    )


# -- the two scoring tables ----------------------------------------------------------------


def prepared_companies(companies: DataFrame) -> DataFrame:
    return companies.select(
        "company_id",
        "snapshot_id",
        F.col("owner_id"),
        _lowered(F.col("lifecycle_stage")).alias("lifecycle_stage"),
        _status_key(F.col("lead_status")).alias("lead_status"),
        company_normalized(F.col("lifecycle_stage"), F.col("lead_status")).alias("company_flag"),
    )


def prepared_deals(deals: DataFrame, stages: DataFrame) -> DataFrame:
    return open_deals(deals_with_stage(deals, stages)).select(
        "deal_id",
        "associated_company_id",
        "snapshot_id",
        _lowered(F.col("deal_stage")).alias("deal_stage"),
        deal_normalized(F.col("deal_stage")).alias("deal_flag"),
    )


def staged_units(
    companies: DataFrame, deals: DataFrame, stages: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """Units before scoring, with the normalisation flag as a column."""
    joined = companies_with_deals(prepared_companies(companies), prepared_deals(deals, stages), heavy)
    return joined.withColumns(
        {
            "combined_stage": combined_stage(
                F.col("lifecycle_stage"), F.col("lead_status"), F.col("deal_stage")
            ),
            "stage_source": stage_source(F.col("deal_id")),
            "normalization_applied": normalization_applied(F.col("company_flag"), F.col("deal_flag")),
        }
    ).drop("company_flag", "deal_flag")


def score_units(
    companies: DataFrame,
    deals: DataFrame,
    stages: DataFrame,
    mapping: DataFrame,
    as_of: Column,
    dedupe_mapping: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Scored units of every snapshot in the inputs, in one plan."""
    units = with_scores(staged_units(companies, deals, stages, heavy), mapping, dedupe_mapping)
    return units.withColumn("record_timestamp", as_of).select(*UNITS.names)


def score_history(units: DataFrame, as_of: Column) -> DataFrame:
    """Distinct companies and total score per snapshot, owner and stage."""
    return (
        units.filter("adjusted_score IS NOT NULL AND combined_stage IS NOT NULL")
        .groupBy("snapshot_id", "owner_id", F.lower("combined_stage").alias("combined_stage"))
        .agg(
            F.count_distinct("company_id").alias("num_companies"),
            F.sum("adjusted_score").alias("total_score"),
        )
        .withColumn("record_timestamp", as_of)
        .select(*SCORE_HISTORY.names)
    )


def active_units(units: DataFrame) -> DataFrame:
    """Units neither disqualified (-1) nor won (9); an unknown level is dropped."""
    return units.filter(~F.col("stage_level").isin(-1, 9))

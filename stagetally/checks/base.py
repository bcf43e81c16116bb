"""CRM-shaped tables derived from the driver's tables, in Spark and in SQL.

Each derived table is defined once, by column expressions that mean the same in
both engines.  A check pairs a Spark query with independent SQL over the same
derived tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetally.operators.scoring import score_history, score_units, stage_mapping
from stagetally.schemas import (
    COMPANIES,
    DEAL_STAGE_REFERENCE,
    DEALS,
    OWNERS,
    REGISTRY,
    STAGE_MAPPING_ROWS,
)
from stagetally.session import configure, literal_table, scratch_path
from stagetally.sources.warehouse import Warehouse, as_timestamp

FIRST_YEAR, LAST_YEAR = 1995, 2001
SNAPSHOT = "2000-01-01T00:00:00Z"
AS_OF = "2024-01-01T00:00:00Z"

_COMPANY = {
    "company_id": "CAST(c_custkey AS STRING)",
    "company_name": "CASE WHEN c_custkey % 100 = 7 THEN '' WHEN c_custkey % 100 = 8 THEN NULL ELSE c_name END",
    "lifecycle_stage": (
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'Lead' WHEN 'AUTOMOBILE' THEN 'opportunity' "
        "WHEN 'MACHINERY' THEN 'SalesQualifiedLead' WHEN 'HOUSEHOLD' THEN 'closed-won' "
        "ELSE 'Disqualified' END"
    ),
    "lead_status": (
        "CASE c_custkey % 6 WHEN 0 THEN 'NEW' WHEN 1 THEN 'Attempted to contact' "
        "WHEN 2 THEN 'connected' WHEN 3 THEN 'nurturing' WHEN 4 THEN 'restart' END"
    ),
    "owner_id": "CASE WHEN c_custkey % 90 = 4 THEN '' ELSE CAST(c_nationkey AS STRING) END",
    "company_type": (
        "CASE c_custkey % 4 WHEN 0 THEN 'Prospect' WHEN 1 THEN 'Customer' WHEN 2 THEN 'partner' END"
    ),
    "development_category": (
        "CASE c_custkey % 5 WHEN 0 THEN 'Full-stack' WHEN 1 THEN 'frontend' WHEN 2 THEN '' END"
    ),
    "hiring_developers": "CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' END",
    "inhouse_developers": "CASE c_custkey % 7 WHEN 0 THEN '1 or more' WHEN 1 THEN 'None' END",
    "proff_likviditetsgrad": "CASE c_custkey % 8 WHEN 0 THEN 'God' WHEN 1 THEN 'svak' END",
    "proff_link": (
        "CASE WHEN c_custkey % 9 > 0 THEN "
        "concat('HTTPS://Www.Example.COM/Company/', CAST(c_custkey AS STRING), '?Tab=A') END"
    ),
    "proff_lonnsomhet": "CAST(NULL AS STRING)",
    "proff_soliditet": "CASE WHEN c_custkey % 11 = 0 THEN 'tilfredsstillende' END",
    "snapshot_id": "make_timestamp(y, 1, 1, 0, 0, 0)",
    "record_timestamp": "make_timestamp(y, 1, 1, 1, 0, 0)",
}
_DEAL = {
    "deal_id": "CAST(o_orderkey AS STRING)",
    "deal_name": (
        "CASE WHEN o_orderkey % 60 = 0 THEN '' WHEN o_orderkey % 60 = 1 THEN NULL "
        "ELSE concat('Deal ', CAST(o_orderkey AS STRING)) END"
    ),
    "deal_stage": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'AppointmentScheduled' WHEN '2-HIGH' THEN 'qualifiedtobuy' "
        "WHEN '3-MEDIUM' THEN 'presentationscheduled' WHEN '4-NOT SPECIFIED' THEN 'decisionmakerboughtin' "
        "ELSE 'closedlost' END"
    ),
    "deal_type": "CASE o_orderstatus WHEN 'O' THEN 'New Business' WHEN 'P' THEN 'Existing Business' END",
    "amount": "o_totalprice",
    "owner_id": (
        "CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE CAST(o_custkey % 30 AS STRING) END"
    ),
    "associated_company_id": (
        "CASE WHEN o_orderkey % 40 = 0 THEN concat('x', CAST(o_custkey AS STRING)) "
        "WHEN o_orderkey % 40 = 1 THEN NULL ELSE CAST(o_custkey AS STRING) END"
    ),
    "snapshot_id": "date_trunc('year', o_orderdate)",
    "record_timestamp": "date_trunc('year', o_orderdate) + INTERVAL '1' HOUR",
}
_OWNER = {
    "owner_id": "CAST(n_nationkey AS STRING)",
    "email": (
        "CASE n_nationkey WHEN 0 THEN '' WHEN 1 THEN 'no-at-sign' ELSE concat(n_name, '@example.com') END"
    ),
    "first_name": "n_name",
    "last_name": "CASE WHEN n_nationkey % 2 = 1 THEN concat('Of ', CAST(n_regionkey AS STRING)) END",
    "user_id": "CAST(n_nationkey + 1000 AS STRING)",
    "active": "n_regionkey > 0",
    "record_timestamp": "make_timestamp(2024, 1, 1, 0, 0, 0)",
}
# A second owners table that grows with the data.
_REP = {
    "owner_id": "CAST(s_suppkey AS STRING)",
    "email": (
        "CASE WHEN s_suppkey % 20 = 3 THEN '' WHEN s_suppkey % 20 = 4 THEN NULL "
        "WHEN s_suppkey % 20 = 5 THEN lower(s_name) WHEN s_suppkey % 3 = 0 THEN concat('  ', 'Rep', "
        "CAST(s_suppkey % 50 AS STRING), '@Example.com ') "
        "ELSE concat('rep', CAST(s_suppkey % 50 AS STRING), '@example.com') END"
    ),
    "first_name": "s_name",
    "last_name": "CASE WHEN s_suppkey % 2 = 0 THEN 'Ray' END",
    "user_id": "CAST(s_suppkey + 5000 AS STRING)",
    "active": "s_acctbal > 0",
    "record_timestamp": "make_timestamp(2024, 1, 1, 0, 0, 0)",
}
_TRIGGER = (
    "CASE event_type WHEN 'purchase' THEN 'ingest_completion' WHEN 'signup' THEN 'manual' "
    "WHEN 'error' THEN 'scoring_failure' WHEN 'click' THEN 'scoring_start' ELSE 'scoring_completion' END"
)
_STATUS = (
    "CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'completed' "
    "WHEN 'error' THEN 'failed' ELSE 'started' END"
)
_LOG = {
    "triggered_by": _TRIGGER,
    "status": _STATUS,
    "notes": "props",
    "snapshot_id": "date_trunc('day', ts)",
    "record_timestamp": "ts",
}
# The same log with yearly snapshots: 1997 is missing, 1994, 2002 and 2003 have no data.
_YEAR_LOG = _LOG | {
    "snapshot_id": (
        "make_timestamp(CAST(CASE WHEN event_id % 9 = 3 THEN 2003 ELSE 1994 + event_id % 9 END AS INT), "
        "1, 1, 0, 0, 0)"
    ),
}
# A scoring table of any size, with capitals on purpose.
_WIDE_MAPPING = {
    "lifecycle_stage": "p_type",
    "lead_status": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE lower(p_brand) END",
    "deal_stage": "CASE WHEN p_size % 7 = 0 THEN p_name END",
    "combined_stage": "concat(lower(p_type), '/', CASE WHEN p_size % 4 = 0 THEN p_brand ELSE lower(p_brand) END)",
    "stage_level": "CAST(p_size AS BIGINT)",
    "adjusted_score": "p_size * 0.5",
    "record_timestamp": "make_timestamp(2024, 1, 1, 0, 0, 0)",
}
_STAGES = [
    ("default", "Sales", "appointmentscheduled", "Appointment", False, 0.2, 1),
    ("default", "Sales", "qualifiedtobuy", "Qualified", False, 0.4, 2),
    ("default", "Sales", "presentationscheduled", "Presentation", False, 0.6, 3),
    ("default", "Sales", "decisionmakerboughtin", "Decision maker", False, 0.8, 4),
    ("default", "Sales", "ClosedLost", "Lost", True, 0.0, 5),
]


def _columns(definition: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in definition.items()]


class Bed:
    """Lazily derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derive(self, df: DataFrame, definition: dict[str, str], schema: T.StructType) -> DataFrame:
        df = df.selectExpr(*_columns(definition))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    @cached_property
    def companies(self) -> DataFrame:
        years = F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR)))
        return self._derive(self.table("customer").withColumn("y", years), _COMPANY, COMPANIES)

    @cached_property
    def deals(self) -> DataFrame:
        return self._derive(self.table("orders"), _DEAL, DEALS)

    @cached_property
    def owners(self) -> DataFrame:
        return self._derive(self.table("nation"), _OWNER, OWNERS)

    @cached_property
    def reps(self) -> DataFrame:
        return self._derive(self.table("supplier"), _REP, OWNERS)

    @cached_property
    def registry(self) -> DataFrame:
        return self._derive(self.table("events"), _LOG, REGISTRY)

    @cached_property
    def year_registry(self) -> DataFrame:
        return self._derive(self.table("events"), _YEAR_LOG, REGISTRY)

    @cached_property
    def wide_mapping(self) -> DataFrame:
        return self.table("part").selectExpr(*_columns(_WIDE_MAPPING))

    @cached_property
    def stages(self) -> DataFrame:
        return literal_table(
            self.spark, [(*r, as_timestamp(AS_OF)) for r in _STAGES], DEAL_STAGE_REFERENCE
        )

    @cached_property
    def mapping(self) -> DataFrame:
        return stage_mapping(self.spark, as_timestamp(AS_OF))

    @cached_property
    def units(self) -> DataFrame:
        return score_units(
            self.companies, self.deals, self.stages, self.mapping,
            F.col("snapshot_id") + F.expr("INTERVAL '1' DAY"),
        )

    @cached_property
    def history(self) -> DataFrame:
        return self.scored(self.units)

    def scored(self, units: DataFrame) -> DataFrame:
        return score_history(units, F.col("snapshot_id") + F.expr("INTERVAL '2' DAY"))

    @property
    def audited(self) -> dict[str, DataFrame]:
        return {
            "companies": self.companies,
            "deals": self.deals,
            "owners": self.owners,
            "snapshot_registry": self.year_registry,
            "pipeline_units_snapshot": self.units,
            "pipeline_score_history": self.history,
            "deal_stage_reference": self.stages,
        }

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def warehouse(self, *names: str) -> Warehouse:
        """A fresh warehouse holding the named tables."""
        wh = Warehouse(self.spark, self.scratch("warehouse"))
        frames = self.audited | {"stage_mapping": self.mapping}
        for name in names:
            wh.append_table(frames[name], name)
        return wh


# -- SQL side ------------------------------------------------------------------------------------


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else str(v)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_sql_value(v) for v in r) + ")" for r in rows)


def _derived(definition: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(_columns(definition))} FROM {source}"


# What a lifecycle stands for, and which detail goes behind it.
_STAGE_RULES = [
    ("lead", "lead", "status"),
    ("opportunity", "opportunity", "deal"),
    ("salesqualifiedlead", "salesqualifiedlead", None),
    ("sales qualified lead", "salesqualifiedlead", None),
    ("closed-won", "closed-won", None),
    ("disqualified", "disqualified", None),
]

TABLES_SQL = f"""WITH
companies AS ({_derived(_COMPANY, f"customer CROSS JOIN (SELECT CAST(range AS INT) AS y FROM range({FIRST_YEAR}, {LAST_YEAR + 1})) years")}),
deals AS ({_derived(_DEAL, "orders")}),
owners AS ({_derived(_OWNER, "nation")}),
reps AS ({_derived(_REP, "supplier")}),
registry AS ({_derived(_LOG, "events")}),
year_registry AS ({_derived(_YEAR_LOG, "events")}),
wide_mapping AS ({_derived(_WIDE_MAPPING, "part")}),
stages AS (SELECT * FROM (VALUES {_values(_STAGES)}) v(pipeline_id, pipeline_label, stage_id, stage_label, is_closed, probability, display_order)),
mapping AS (SELECT * FROM (VALUES {_values(STAGE_MAPPING_ROWS)}) v(lifecycle_stage, lead_status, deal_stage, combined_stage, stage_level, adjusted_score)),
stage_rules AS (SELECT * FROM (VALUES {_values(_STAGE_RULES)}) v(lifecycle, stage, detail)),
tidy_companies AS (
  SELECT company_id, owner_id, snapshot_id, lifecycle_stage AS given_stage, lead_status AS given_status,
         ifnull(lower(lifecycle_stage), '') AS lifecycle, ifnull(lower(replace(lead_status, ' ', '_')), '') AS status
  FROM companies),
tidy_deals AS (
  SELECT deal_id, associated_company_id, snapshot_id, deal_stage AS given_stage, ifnull(lower(deal_stage), '') AS stage
  FROM deals
  WHERE NOT EXISTS (FROM stages WHERE is_closed AND lower(stage_id) = lower(deals.deal_stage))),
pairs AS (
  SELECT tc.company_id, td.deal_id, tc.owner_id, tc.snapshot_id, tc.lifecycle, tc.status, td.stage,
         (tc.given_stage <> tc.lifecycle) IS TRUE OR (tc.given_status <> tc.status) IS TRUE
         OR (td.given_stage <> td.stage) IS TRUE AS changed
  FROM tidy_companies tc LEFT JOIN tidy_deals td
    ON td.snapshot_id = tc.snapshot_id AND td.associated_company_id = tc.company_id),
staged AS (
  SELECT p.snapshot_id, p.company_id, p.deal_id, p.owner_id,
         p.lifecycle AS lifecycle_stage, p.status AS lead_status, p.stage AS deal_stage,
         ifnull(r.stage, 'unmapped') || CASE r.detail
           WHEN 'status' THEN '/' || if(p.status = '', 'unknown', p.status)
           WHEN 'deal' THEN '/' || if(ifnull(p.stage, '') = '', 'missing', p.stage)
           ELSE '' END AS combined_stage,
         if(p.deal_id IS NULL, 'company', 'deal') AS stage_source,
         CAST(p.changed AS INT) AS normalization_applied
  FROM pairs p LEFT JOIN stage_rules r ON r.lifecycle = p.lifecycle),
scores AS (SELECT lower(combined_stage) AS stage, stage_level, adjusted_score FROM mapping),
units AS (
  SELECT staged.* EXCLUDE (normalization_applied),
         CAST(ifnull(scores.stage_level, 0) AS BIGINT) AS stage_level,
         CAST(ifnull(scores.adjusted_score, 0) AS DOUBLE) AS adjusted_score,
         snapshot_id + INTERVAL 1 DAY AS record_timestamp
  FROM staged LEFT JOIN scores ON scores.stage = lower(staged.combined_stage)),
history AS (
  SELECT snapshot_id, owner_id, lower(combined_stage) AS combined_stage,
         count(DISTINCT company_id) AS num_companies, sum(adjusted_score) AS total_score,
         snapshot_id + INTERVAL 2 DAY AS record_timestamp
  FROM units WHERE adjusted_score IS NOT NULL AND combined_stage IS NOT NULL
  GROUP BY snapshot_id, owner_id, lower(combined_stage))
"""


def ts(column: str, alias: str | None = None) -> str:
    """SQL that prints a timestamp the way ``shown`` does."""
    name = alias or column.split(".")[-1]
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def shown(df: DataFrame) -> DataFrame:
    """Comparable columns: timestamps and arrays as text, integers as bigint."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


@dataclass(frozen=True)
class Check:
    survey_id: str
    name: str
    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(survey_id: str, sql: str | None, name: str | None = None):
    """Register ``fn(bed) -> DataFrame`` under its own name, with its SQL."""

    def register(fn):
        key = name or fn.__name__

        def query(spark: SparkSession, folder: str) -> DataFrame:
            return shown(fn(Bed(spark, folder)))

        query.__name__ = key
        query.__doc__ = fn.__doc__
        if key in CHECKS:
            raise ValueError(f"two checks named {key}")
        CHECKS[key] = Check(survey_id, key, query, TABLES_SQL + sql if sql else None)
        return fn

    return register

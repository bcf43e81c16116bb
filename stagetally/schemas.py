"""Fixed table schemas, field maps and rule tables.

Every table has one declared ``StructType``; nothing is ever inferred.  Fact
tables carry ``snapshot_id`` (business time) and ``record_timestamp`` (load
time) and are stored partitioned by ``snapshot_id``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE, _BOOL, _TS = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in columns.items()])


# --- fixed values: table schemas -------------------------------------------------
COMPANIES = _table(
    company_id=_STRING,
    company_name=_STRING,
    lifecycle_stage=_STRING,
    lead_status=_STRING,
    owner_id=_STRING,
    company_type=_STRING,
    development_category=_STRING,
    hiring_developers=_STRING,
    inhouse_developers=_STRING,
    proff_likviditetsgrad=_STRING,
    proff_link=_STRING,
    proff_lonnsomhet=_STRING,
    proff_soliditet=_STRING,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

OWNERS = _table(
    owner_id=_STRING,
    email=_STRING,
    first_name=_STRING,
    last_name=_STRING,
    user_id=_STRING,
    active=_BOOL,
    record_timestamp=_TS,
)

DEALS = _table(
    deal_id=_STRING,
    deal_name=_STRING,
    deal_stage=_STRING,
    deal_type=_STRING,
    amount=_DOUBLE,
    owner_id=_STRING,
    associated_company_id=_STRING,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

DEAL_STAGE_REFERENCE = _table(
    pipeline_id=_STRING,
    pipeline_label=_STRING,
    stage_id=_STRING,
    stage_label=_STRING,
    is_closed=_BOOL,
    probability=_DOUBLE,
    display_order=_LONG,
    record_timestamp=_TS,
)

STAGE_MAPPING = _table(
    lifecycle_stage=_STRING,
    lead_status=_STRING,
    deal_stage=_STRING,
    combined_stage=_STRING,
    stage_level=_LONG,
    adjusted_score=_DOUBLE,
    record_timestamp=_TS,
)

UNITS = _table(
    company_id=_STRING,
    deal_id=_STRING,
    owner_id=_STRING,
    lifecycle_stage=_STRING,
    lead_status=_STRING,
    deal_stage=_STRING,
    combined_stage=_STRING,
    stage_level=_LONG,
    adjusted_score=_DOUBLE,
    stage_source=_STRING,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

REGISTRY = _table(
    triggered_by=_STRING,
    status=_STRING,
    notes=_STRING,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

SCORE_HISTORY = _table(
    owner_id=_STRING,
    combined_stage=_STRING,
    num_companies=_LONG,
    total_score=_DOUBLE,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

# Owners' measures per snapshot, kept by scoring so that the report need not read all units again.
OWNER_ROWS = _table(
    owner_id=_STRING,
    company_types=_STRING,
    deal_types=_STRING,
    development_categories=_STRING,
    hiring_status=_STRING,
    total_companies=_LONG,
    total_deals=_LONG,
    total_score=_DOUBLE,
    scored_units=_LONG,
    total_deal_value=_DOUBLE,
    nurturing_count=_LONG,
    lead_count=_LONG,
    sql_count=_LONG,
    opportunity_count=_LONG,
    nurturing_score=_DOUBLE,
    lead_score=_DOUBLE,
    sql_score=_DOUBLE,
    opportunity_score=_DOUBLE,
    prospect_count=_LONG,
    customer_count=_LONG,
    partner_count=_LONG,
    vendor_count=_LONG,
    companies_with_deals=_LONG,
    new_business_count=_LONG,
    existing_business_count=_LONG,
    snapshot_id=_TS,
    record_timestamp=_TS,
)

TABLES: dict[str, T.StructType] = {
    "companies": COMPANIES,
    "owners": OWNERS,
    "deals": DEALS,
    "deal_stage_reference": DEAL_STAGE_REFERENCE,
    "stage_mapping": STAGE_MAPPING,
    "pipeline_units_snapshot": UNITS,
    "snapshot_registry": REGISTRY,
    "pipeline_score_history": SCORE_HISTORY,
    "pipeline_owner_rows": OWNER_ROWS,
}

# Tables stored as one directory per snapshot; the registry is a log.
PARTITIONED = frozenset(t for t, s in TABLES.items() if "snapshot_id" in s.names and t != "snapshot_registry")

ISSUES = T.StructType(
    [
        T.StructField("table", _STRING),
        T.StructField("field", _STRING),
        T.StructField("issue_type", _STRING),
        T.StructField("count", _LONG),
        T.StructField("severity", _STRING),
        T.StructField("description", _STRING),
        T.StructField("sample_values", T.ArrayType(_STRING)),
    ]
)

# --- fixed values: the 16 scoring rows ---------------------------------------------
# (lifecycle_stage, lead_status, deal_stage, combined_stage, stage_level, adjusted_score)
STAGE_MAPPING_ROWS = [
    ("lead", "new", None, "lead/new", 1, 1.0),
    ("lead", "restart", None, "lead/restart", 1, 1.0),
    ("lead", "attempted_to_contact", None, "lead/attempted_to_contact", 2, 1.5),
    ("lead", "connected", None, "lead/connected", 3, 2.0),
    ("lead", "nurturing", None, "lead/nurturing", 0, 2.0),
    ("salesqualifiedlead", None, None, "salesqualifiedlead", 4, 6.0),
    ("sales qualified lead", None, None, "salesqualifiedlead", 4, 6.0),
    ("opportunity", None, None, "opportunity/missing", 5, 7.0),
    ("opportunity", None, "appointmentscheduled", "opportunity/appointmentscheduled", 5, 8.0),
    ("opportunity", None, "qualifiedtobuy", "opportunity/qualifiedtobuy", 6, 10.0),
    ("opportunity", None, "presentationscheduled", "opportunity/presentationscheduled", 7, 12.0),
    ("opportunity", None, "decisionmakerboughtin", "opportunity/decisionmakerboughtin", 8, 14.0),
    ("closed-won", None, "contractsent", "closed-won/contractsent", 9, 30.0),
    ("disqualified", None, None, "disqualified", -1, 0.0),
    ("customer", None, None, "customer", 10, 50.0),
    ("evangelist", None, None, "evangelist", 10, 60.0),
]

# --- fixed values: source property -> column ------------------------------------------
# The owner property is named differently per CRM and has to be named by the user.
COMPANY_PROPERTIES = {
    "name": "company_name",
    "lifecyclestage": "lifecycle_stage",
    "hs_lead_status": "lead_status",
    "type": "company_type",
    "development_category": "development_category",
    "hiring_developers": "hiring_developers",
    "inhouse_developers": "inhouse_developers",
    "proff_likviditetsgrad": "proff_likviditetsgrad",
    "proff_link": "proff_link",
    "proff_lonnsomhet": "proff_lonnsomhet",
    "proff_soliditet": "proff_soliditet",
}
DEAL_PROPERTIES = {
    "dealname": "deal_name",
    "dealstage": "deal_stage",
    "dealtype": "deal_type",
    "amount": "amount",
}
# association type -> (target column, "single" or "multiple")
DEAL_ASSOCIATIONS = {"companies": ("associated_company_id", "single")}

# --- fixed values: fields that must be lower case --------------------------------------
LOWERCASE_FIELDS = {
    "companies": [
        "lifecycle_stage",
        "lead_status",
        "company_type",
        "development_category",
        "hiring_developers",
        "inhouse_developers",
        "proff_likviditetsgrad",
        "proff_lonnsomhet",
        "proff_soliditet",
    ],
    "deals": ["deal_stage", "deal_type"],
    "owners": ["email"],
}
URL_FIELDS = {"companies": ["proff_link"]}
REFERENCE_FIELDS = ["owner_id", "associated_company_id"]

# --- fixed values: export headers -> columns ---------------------------------------------
COMPANY_EXPORT_COLUMNS = {
    "Record ID": "company_id",
    "Company name": "company_name",
    "Company owner": "owner_id",
    "Lifecycle Stage": "lifecycle_stage",
    "Lead Status": "lead_status",
    "Type": "company_type",
    "Development Category": "development_category",
    "Hiring Developers": "hiring_developers",
    "Inhouse Developers": "inhouse_developers",
    "Proff Likviditetsgrad": "proff_likviditetsgrad",
    "Proff Link": "proff_link",
    "Proff Lønnsomhet": "proff_lonnsomhet",
    "Proff Soliditet": "proff_soliditet",
}
# Order matters: a later alias of the same target overrides an earlier one.
DEAL_EXPORT_COLUMNS = {
    "Record ID": "deal_id",
    "Deal Name": "deal_name",
    "Deal Stage": "deal_stage",
    "Deal Type": "deal_type",
    "Amount": "amount",
    "Deal owner": "owner_id",
    "Associated Company ID": "associated_company_id",
    "Deal name": "deal_name",
    "Dealname": "deal_name",
    "Deal stage": "deal_stage",
    "Dealstage": "deal_stage",
    "Deal type": "deal_type",
    "Dealtype": "deal_type",
    "Owner": "owner_id",
    "Company ID": "associated_company_id",
}
COMPANY_EXPORT_EVIDENCE = ["Record ID", "Company name", "Company owner", "Lifecycle Stage"]
DEAL_EXPORT_EVIDENCE = ["deal name", "dealname", "deal stage", "dealstage", "amount"]

# --- fixed values: integrity rules ---------------------------------------------------------
# table -> {field: (referenced table, referenced field)}
RELATIONSHIPS = {
    "companies": {"owner_id": ("owners", "owner_id")},
    "deals": {
        "owner_id": ("owners", "owner_id"),
        "associated_company_id": ("companies", "company_id"),
    },
    "pipeline_units_snapshot": {
        "owner_id": ("owners", "owner_id"),
        "company_id": ("companies", "company_id"),
        "deal_id": ("deals", "deal_id"),
    },
}
REQUIRED_FIELDS = {
    "companies": ["company_id", "company_name"],
    "deals": ["deal_id", "deal_name"],
    "owners": ["owner_id", "email"],
    "snapshot_registry": ["snapshot_id", "triggered_by", "status"],
}
UNIQUE_KEYS = {
    "companies": ["company_id", "snapshot_id"],
    "deals": ["deal_id", "snapshot_id"],
    "owners": ["owner_id"],
    "snapshot_registry": ["snapshot_id", "triggered_by", "record_timestamp"],
}
EMAIL_FIELDS = {"owners": ["email"]}
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
FACT_TABLES = ["companies", "deals"]
COUNTED_TABLES = [
    "companies",
    "deals",
    "owners",
    "snapshot_registry",
    "pipeline_units_snapshot",
    "pipeline_score_history",
    "deal_stage_reference",
]
SEVERITY_WEIGHTS = {"critical": 3.0, "warning": 1.0, "info": 0.1}
DEFAULT_SEVERITY_WEIGHT = 1.0

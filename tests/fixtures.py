"""Invented micro tables."""

from stagetally.schemas import TABLES
from stagetally.session import literal_table
from stagetally.sources.warehouse import as_timestamp

S1, S2 = "2025-06-01T06:00:00Z", "2025-06-08T06:00:00Z"
AS_OF = as_timestamp("2025-07-01T00:00:00Z")


def table(spark, name, rows):
    """Rows given as dicts; absent columns are NULL, times may be text."""
    schema = TABLES[name]
    times = ("snapshot_id", "record_timestamp")
    values = [
        tuple(as_timestamp(r[c]) if c in times and isinstance(r.get(c), str) else r.get(c) for c in schema.names)
        for r in rows
    ]
    return literal_table(spark, values, schema)


def company(company_id, lifecycle, snapshot=S1, **more):
    return {"company_id": company_id, "company_name": f"C {company_id}", "lifecycle_stage": lifecycle,
            "owner_id": "o1", "snapshot_id": snapshot, "record_timestamp": snapshot, **more}


def deal(deal_id, company_id, stage, snapshot=S1, **more):
    return {"deal_id": deal_id, "deal_name": f"D {deal_id}", "deal_stage": stage, "amount": 10.0, "owner_id": "o1",
            "associated_company_id": company_id, "snapshot_id": snapshot, "record_timestamp": snapshot, **more}


def stages(spark):
    rows = [("qualifiedtobuy", False), ("presentationscheduled", False), ("closedlost", True)]
    return table(spark, "deal_stage_reference", [
        {"pipeline_id": "p", "stage_id": s, "is_closed": c, "record_timestamp": S1} for s, c in rows])



def logged(snapshot, trigger, status, at, notes=None):
    return {"snapshot_id": snapshot, "triggered_by": trigger, "status": status, "record_timestamp": at, "notes": notes}

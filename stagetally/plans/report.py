"""The owner history report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stagetally.operators import history
from stagetally.operators.scoring import active_units
from stagetally.session import cut_lineage
from stagetally.sources.warehouse import Warehouse

OWNER_ROWS_TABLE = "pipeline_owner_rows"


def attributed_units(units: DataFrame, companies: DataFrame, deals: DataFrame) -> DataFrame:
    """Active units with company and deal columns."""
    return history.with_deals(history.with_companies(active_units(units), companies), deals)


def enriched_units(
    units: DataFrame, companies: DataFrame, deals: DataFrame, owners: DataFrame
) -> DataFrame:
    return history.with_owners(attributed_units(units, companies, deals), owners)


def history_of(owner_rows: DataFrame) -> DataFrame:
    """Totals, rank and change of owner rows, which should be stored: they are read more than once."""
    rows = history.with_snapshot_totals(owner_rows, history.snapshot_totals(owner_rows))
    rows = history.previous_period(history.owner_rank(rows))
    return history.period_change_percent(history.period_change(rows))


def owner_history(
    units: DataFrame, companies: DataFrame, deals: DataFrame, owners: DataFrame
) -> DataFrame:
    """Owner rows with totals, rank and change, without a final order."""
    return history_of(cut_lineage(history.owner_aggregates(enriched_units(units, companies, deals, owners))))


def stored_owner_rows_cover(warehouse: Warehouse) -> bool:
    """Whether owner rows are stored for the very snapshots that have units; a listing of both tables."""
    tables = ("pipeline_units_snapshot", OWNER_ROWS_TABLE)
    units, rows = ({s for s, _ in warehouse._folders(warehouse.path(t))} for t in tables)
    return warehouse.exists(OWNER_ROWS_TABLE) and rows <= units and _inactive(warehouse, units - rows)


def _inactive(warehouse: Warehouse, snapshots: set) -> bool:
    """Whether none of the snapshots has an active unit; those leave no owner row."""
    if not snapshots or None in snapshots:
        return not snapshots
    return active_units(warehouse.read_snapshots("pipeline_units_snapshot", snapshots)).isEmpty()


def owner_history_report(warehouse: Warehouse, stored: bool = True) -> DataFrame:
    """The report in report order.

    It is made from the owner rows that scoring keeps per snapshot, if these
    cover all units, so rescoring a snapshot costs what that snapshot holds.
    Otherwise, or with ``stored=False``, all units are read and joined with the
    companies and deals of today.  Names are always those of today.
    """
    if stored and stored_owner_rows_cover(warehouse):
        rows = history.named_owner_rows(warehouse.read(OWNER_ROWS_TABLE), warehouse.read("owners"))
        return history.report_order(history_of(rows))
    names = ("pipeline_units_snapshot", "companies", "deals", "owners")
    return history.report_order(owner_history(*[warehouse.read(n) for n in names]))


def register_report_view(warehouse: Warehouse, name: str = "vw_owner_history") -> DataFrame:
    """The report of now as a temporary view; register it again after scoring."""
    report = owner_history_report(warehouse)
    report.createOrReplaceTempView(name)
    return report

"""Analytics over the cleaned lines: the statements of other modules with ``lines`` taken from cleaning."""

from . import forecast, opportunity, pricing, spend, vendor
from .base import BRAND_LINES, CLEAN, PART_LINES, STAGING

NAMES = (
    "spend_readiness", "spend_kpis", "spend_yoy", "spend_by_category", "spend_by_department", "spend_reconciliation",
    "spend_reconciliation_check", "spend_completed_vs_open", "spend_status_lines_by_month",
    "vendor_spend_ranking", "vendor_top3_by_category", "delivery_readiness", "delivery_overall", "vendor_delivery_scorecard",
    "open_aging", "open_overdue_by_vendor", "price_coverage", "ppv_overall", "ppv_by_vendor", "price_volume_effect",
    "opp_summary", "opp_scorecard", "opp_scenarios", "fc_monthly_series", "fc_final",
)


def over_clean_lines(statement: str) -> str:
    """``statement`` with the mapped lines staged (with their defects) and cleaned first."""
    for mapped in (PART_LINES.strip(), BRAND_LINES.strip()):
        if mapped in statement:
            steps = (mapped.replace("lines AS (", "mapped AS (", 1), STAGING.strip().replace("FROM lines", "FROM mapped"),
                     CLEAN.strip(), "lines AS (SELECT * FROM clean)")
            return statement.replace(mapped, ",".join(steps))
    raise ValueError("no lines in the statement")


_all = spend.SQL | vendor.SQL | pricing.SQL | opportunity.SQL | forecast.SQL
SQL = {f"cleaned_{name}": over_clean_lines(_all[name]) for name in NAMES}

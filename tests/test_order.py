"""Sorted reports come in their order; the comparison with DuckDB looks at values only."""

import pytest

from conftest import SMALL_DIR
from starbazaar import catalog

SEVERITY = {"alta": 0, "media": 1, "baja": 2}

#: Each report's rows must be ascending by this key.
ORDERS = {
    "monthly_revenue_and_avg_ticket": lambda r: (r.year, r.month),
    "top10_categories_by_revenue": lambda r: (-r.total_revenue, r.category),
    "monthly_review_score_trend": lambda r: (r.year, r.month),
    "top10_sellers_by_revenue": lambda r: (-r.total_revenue, r.seller_id),
    "delivery_performance_by_state": lambda r: (r.on_time_rate_pct is None, r.on_time_rate_pct or 0, r.state),
    "payment_method_distribution": lambda r: (-r.num_orders, r.payment_type),
    "rfm_analysis": lambda r: (-r.monetary, r.customer_unique_id),
    "range_monthly": lambda r: (r.year, r.month),
    "range_categories": lambda r: (-r.total_revenue, r.category),
    "shown_categories": lambda r: (r.total_revenue, [-ord(c) for c in r.category]),
    "range_payments": lambda r: (-r.num_orders, r.payment_type),
    "range_sellers": lambda r: (-r.total_revenue, r.seller_id),
    "shown_sellers": lambda r: (-r.total_revenue, r.seller_id),
    "orders_per_month": lambda r: r.year_month,
    "top_states": lambda r: (-r.num_orders, r.customer_state),
    "issue_summary_damaged": lambda r: (SEVERITY[r.severity], -r["count"], r.check, r.table, r.column),
    "severity_counts_damaged": lambda r: SEVERITY[r.severity],
    "missing_months_damaged": lambda r: r.missing_month,
}


@pytest.mark.parametrize("name", list(ORDERS))
def test_order(spark, name):
    rows = catalog.queries()[name](spark, SMALL_DIR).collect()
    assert len(rows) > 1 and rows == sorted(rows, key=ORDERS[name])

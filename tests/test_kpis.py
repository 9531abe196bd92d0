from datetime import date
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from conftest import star_table
from starbazaar.plans import kpis, range_reports
from starbazaar.sources.schemas import STAR

DAYS = [date(2017, 1, 10), date(2017, 2, 20), date(2017, 3, 5)]


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


def item(order, customer=1, day=DAYS[0], price=10, **more):
    return {"order_key": 1, "order_id": order, "customer_key": customer, "product_key": 1, "seller_key": 1,
            "date_key": key(day), "order_status": "delivered", "price": price, "freight_value": 0,
            "estimated_delivery_days": 9} | more


def make_star(spark, items, products=None):
    dates = [{"date_key": key(d), "full_date": d, "year": d.year, "month": d.month,
              "month_name": d.strftime("%B")} for d in DAYS]
    people = [{"customer_key": n, "customer_id": f"c{n}", "customer_unique_id": f"u{(n + 1) // 2}", "state": "SP"}
              for n in range(1, 9)]
    return {
        "dim_date": star_table(spark, "dim_date", dates),
        "dim_customer": star_table(spark, "dim_customer", people),
        "dim_product": star_table(spark, "dim_product", products or [{"product_key": 1, "product_id": "p1"}]),
        "dim_seller": star_table(spark, "dim_seller", [{"seller_key": 1, "seller_id": "s1", "state": "RJ"}]),
        "fact_orders": star_table(spark, "fact_orders", items),
    }


def test_the_two_tickets(spark):
    """An order of two items for 30 and one of one item for 60: 45 per order, 40 per item."""
    star = make_star(spark, [item("a", price=10), item("a", price=20), item("b", price=60)])
    assert kpis.monthly_revenue_and_avg_ticket(star).first()["avg_ticket"] == 45
    assert range_reports.range_headline(star, DAYS[0], DAYS[2]).first()["avg_ticket"] == 40


def test_headline_ticket_uses_the_whole_order(spark):
    """Items outside the period still count in their order's total, not in the number of items."""
    star = make_star(spark, [item("a", price=10), item("a", price=20, day=DAYS[1])])
    row = range_reports.range_headline(star, DAYS[0], DAYS[0]).first()
    assert (row["total_orders"], row["total_revenue"], row["avg_ticket"]) == (1, 10, 30)


def test_excluded_statuses(spark):
    star = make_star(spark, [item("a"), item("b", order_status="canceled"), item("c", order_status="unavailable")])
    assert kpis.monthly_revenue_and_avg_ticket(star).first()["num_orders"] == 1
    assert kpis.last_purchase_day(star).first()["max_date"] == DAYS[0]


def test_category_fallback(spark):
    products = [
        {"product_key": 1, "product_id": "p1", "category_name_pt": "cama", "category_name_en": "bed"},
        {"product_key": 2, "product_id": "p2", "category_name_pt": "mesa"}, {"product_key": 3, "product_id": "p3"}]
    star = make_star(spark, [item("a", product_key=k, price=10 * k) for k in (1, 2, 3)], products)
    assert [r["category"] for r in kpis.top10_categories_by_revenue(star).collect()] == [
        "uncategorized", "mesa", "bed"]


def test_an_order_counts_once_per_category(spark):
    products = [{"product_key": k, "product_id": f"p{k}", "category_name_en": "bed"} for k in (1, 2)]
    star = make_star(spark, [item("a", product_key=1), item("a", product_key=2)], products)
    assert kpis.top10_categories_by_revenue(star).first()["num_orders"] == 1


def test_delivery_counts_items_of_any_status(spark):
    star = make_star(spark, [
        item("a", is_late_delivery=True, delivery_days=10), item("a", is_late_delivery=False, delivery_days=5),
        item("b", is_late_delivery=False, delivery_days=5, order_status="canceled"), item("c")])
    row = kpis.delivery_performance_by_state(star).first()
    assert (row["total_delivered"], row["on_time"], row["late"]) == (3, 2, 1)
    assert (row["on_time_rate_pct"], row["avg_delivery_days"]) == (Decimal("66.7"), Decimal("6.7"))


def test_review_trend(spark):
    star = make_star(spark, [item("a", review_score=s) for s in (5, 4, 1)] + [item("b")])
    row = kpis.monthly_review_score_trend(star).first()
    assert row["total_reviews"] == 3 and row["avg_score"] == Decimal("3.33")
    assert [row[f"score_{n}"] for n in range(1, 6)] == [1, 0, 0, 1, 1]
    assert row["positive_rate_pct"] == Decimal("66.7")


def test_seller_without_reviews_or_deliveries(spark):
    row = kpis.top10_sellers_by_revenue(make_star(spark, [item("a")])).first()
    assert row["avg_review_score"] is None and row["late_delivery_rate_pct"] is None
    assert row["seller_state"] == "RJ"


def test_payment_shares(spark):
    """A missing type and the word 'unknown' stay two groups."""
    star = make_star(spark, [
        item("a", payment_type="boleto", payment_value=30, payment_installments=2), item("b"),
        item("c", payment_type="unknown", payment_value=10, payment_installments=1),
        item("d", payment_type="boleto", payment_value=60, payment_installments=3)])
    rows = kpis.payment_method_distribution(star).collect()
    assert [r["payment_type"] for r in rows] == ["boleto", "unknown", "unknown"]
    assert sum(r["orders_share_pct"] for r in rows) == 100
    assert sorted(str(r["revenue_share_pct"]) for r in rows) == ["10.0", "90.0", "None"]


def test_payment_shares_of_nothing(spark):
    assert kpis.payment_method_distribution(make_star(spark, [item("a")])).first()["revenue_share_pct"] is None


def test_repurchase_averages_the_counts_not_the_people(spark):
    """People with 2, 2 and 3 orders: (2 + 3) / 2."""
    orders = [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 6), ("g", 5), ("h", 7)]
    row = kpis.repurchase_rate(make_star(spark, [item(o, c) for o, c in orders])).first()
    assert (row["total_unique_customers"], row["single_order_customers"], row["repeat_customers"]) == (4, 1, 3)
    assert (row["repurchase_rate_pct"], row["avg_orders_repeat_customers"]) == (75, Decimal("2.50"))


@pytest.mark.parametrize("r", [1, 2, 3])
def test_segments(spark, r):
    def expected(r, f, m):
        if (r, f, m) == (1, 1, 1):
            return "Champions"
        if f >= 2:
            return "Loyal" if r <= 2 else "At Risk"
        return {1: "Recent", 2: "Others", 3: "Lost"}[r]

    scores = [(r, f, m) for f, m in product((1, 2, 3), repeat=2)]
    df = spark.createDataFrame(scores, "r int, f int, m int")
    found = df.select("*", kpis.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert all(x["s"] == expected(x["r"], x["f"], x["m"]) for x in found)


def test_rfm(spark):
    """Today is the latest purchase of any status; thirds are by value, ties by person."""
    star = make_star(spark, [
        item("a", 1, DAYS[0], 50), item("b", 3, DAYS[1], 20), item("c", 5, DAYS[1], 10), item("d", 5, DAYS[0], 5),
        item("x", 7, DAYS[2], order_status="canceled")])
    rows = {r["customer_unique_id"]: r for r in kpis.rfm_analysis(star).collect()}
    assert set(rows) == {"u1", "u2", "u3"}
    assert [rows[u]["recency_days"] for u in ("u1", "u2", "u3")] == [54, 13, 13]
    assert [(rows[u]["r_score"], rows[u]["f_score"], rows[u]["m_score"]) for u in ("u1", "u2", "u3")] == [
        (3, 2, 1), (1, 3, 2), (2, 1, 3)]
    assert [rows[u]["rfm_segment"] for u in ("u1", "u2", "u3")] == ["At Risk", "Loyal", "Others"]


def test_period_ends_are_included(spark):
    star = make_star(spark, [item("a", day=d) for d in DAYS])
    assert range_reports.range_monthly(star, DAYS[0], DAYS[1]).count() == 2


def test_insights(spark):
    star = make_star(spark, [item("a", is_late_delivery=True, review_score=1),
                             item("b", 3, is_late_delivery=False, review_score=5), item("b", 3)])
    shares = kpis.state_share(star).collect()
    assert [(r["side"], r["state"], r["num_orders"], r["share_pct"]) for r in shares] == [
        ("customer", "SP", 2, 100), ("seller", "RJ", 2, 100)]
    assert [(r["is_late_delivery"], r["avg_score"]) for r in kpis.score_by_lateness(star).collect()] == [
        (False, 5), (True, 1)]


def test_everything_runs_on_an_empty_star(spark):
    star = {name: spark.createDataFrame([], STAR[name].schema) for name in STAR}
    for name, report in kpis.KPIS.items():
        assert report(star).count() == (1 if name == "repurchase_rate" else 0), name
    assert range_reports.whole_period(star) == (date(2016, 1, 1), date(2018, 12, 31))
    headline = range_reports.range_headline(star, *range_reports.whole_period(star))
    shown = range_reports.shown_headline(headline, date(2016, 1, 1), date(2018, 12, 31)).first()
    assert (shown["total_orders"], shown["total_revenue"], shown["avg_review_score"]) == ("0", "R$ —", "—")

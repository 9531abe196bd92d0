from decimal import Decimal

import pytest

from conftest import raw_table
from starbazaar.operators.constraints import reference_count
from starbazaar.plans import profile, quality


def table(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


@pytest.mark.parametrize("child, parent, orphans", [
    (["a", "b", None], ["a"], 2), (["a", None, None], ["a", None], 0), ([], ["a"], 0), (["a"], [], 1)])
def test_a_null_child_is_an_orphan_unless_a_parent_is_null(spark, child, parent, orphans):
    c, p = table(spark, *child), table(spark, *parent)
    row = reference_count(c, "k", p, "k").first()
    assert (row["rows"], row["orphans"]) == (len(child), orphans)
    assert quality.orphan_rows(c, "k", p).count() == orphans


def test_null_keys_count_as_duplicates(spark):
    row = quality.duplicate_count(table(spark, "a", "a", "b", None), ["k"]).first()
    assert (row["rows"], row["distinct_keys"], row["duplicates"]) == (4, 2, 2)


def test_critical_nulls(raw):
    rows = {(r["table"], r["column"]): r for r in quality.critical_nulls(raw).collect()}
    assert len(rows) == 11
    found = rows["orders", "customer_id"]
    assert (found["nulls"], found["pct"], found["status"]) == (1, Decimal("14.29"), "✗ ALERTA")
    assert rows["sellers", "seller_id"]["status"] == "✓ ok"


def test_orphan_alert(raw):
    rows = {(r["table"], r["column"]): r for r in quality.orphans(raw).collect()}
    assert rows["order_items", "seller_id"]["orphans"] == 1 and rows["order_items", "seller_id"]["alert"]
    assert not rows["payments", "order_id"]["alert"]


def test_months_and_span(spark):
    orders = raw_table(spark, "orders", [
        {"order_id": str(n), "order_purchase_timestamp": t} for n, t in enumerate(
            ["2016-11-30T10:00:00", "2017-02-01T09:00:00", None])])
    assert [r[0] for r in quality.missing_months(orders).collect()] == ["2016-12", "2017-01"]
    span = quality.date_span(orders).first()
    assert (span["span_days"], span["nulls"], span["null_pct"]) == (62, 1, Decimal("33.33"))
    nothing = orders.limit(0)
    assert quality.missing_months(nothing).count() == 0 and quality.date_span(nothing).first()["null_pct"] is None


def test_register(raw):
    register = quality.issues(raw)
    rows = [tuple(r) for r in quality.issue_summary(register).collect()]
    ranks = [quality.SEVERITIES.index(r[4]) for r in rows]
    assert ranks == sorted(ranks)
    assert ("duplicado_pk", "products", "product_id", 1, "alta") in rows
    assert ("fecha_nula", "orders", "order_purchase_timestamp", 1, "media") in rows
    counts = {r["severity"]: r["findings"] for r in quality.severity_counts(register).collect()}
    assert list(counts) == ["alta", "media", "baja"] and counts["baja"] == 1  # no purchase in February
    graver = quality.severity_counts(register.where("severity <> 'baja'")).collect()
    assert [r["findings"] for r in graver] == [counts["alta"], counts["media"], 0]
    with pytest.raises(RuntimeError, match="duplicado_pk products.product_id"):
        quality.gate(register)
    quality.gate(register.where("severity <> 'alta'"))


def test_profile(raw):
    nulls = {(r["table"], r["column"]): r["null_pct"] for r in profile.null_profile(raw).collect()}
    assert nulls["payments", "payment_value"] == 25 and ("orders", "order_id") not in nulls
    shapes = [r for r in profile.table_shapes(raw).collect() if r["table"] == "orders"]
    assert len(shapes) == 8 and shapes[0]["rows"] == 7
    assert profile.table_preview(raw["orders"], ["order_id"]).count() == 3
    months = [tuple(r) for r in profile.orders_per_month(raw["orders"]).collect()]
    assert months == [("2017-01", 5), ("2017-03", 1)]
    assert [tuple(r) for r in profile.top_states(raw["orders"], raw["customers"]).collect()] == [("SP", 5)]

"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_DIR
from starbazaar import catalog
from starbazaar.operators.constraints import reference_count
from starbazaar.plans import kpis, profile, quality, range_reports
from starbazaar.sources.given_tables import marketplace


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return catalog.star_of(spark, SMALL_DIR)


@pytest.mark.parametrize("name", list(kpis.KPIS))
def test_no_python_and_no_single_task_over_rows(star, name):
    text = plan(kpis.KPIS[name](star))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A single partition may only follow an aggregate: a partial one, or rows that are grouped already.
    for match in re.finditer(r"Exchange SinglePartition.*\n(.*\n?.*)", text):
        assert "HashAggregate" in match.group(1), text


@pytest.mark.parametrize("name", ["top10_categories_by_revenue", "top10_sellers_by_revenue"])
def test_top_k_is_taken_per_task(star, name):
    assert "TakeOrderedAndProject" in plan(kpis.KPIS[name](star))


def test_reports_read_only_their_columns(star):
    text = plan(kpis.monthly_review_score_trend(star))
    fact = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "review_score" in s)
    assert {c.split(":")[0] for c in fact.split(",")} == {"date_key", "review_score"}
    assert "PushedFilters: [IsNotNull(review_score)" in text


def test_unused_order_facts_are_not_computed(spark):
    """The delivery date needs the items; a report that does not ask for it does not read them."""
    raw = marketplace(spark, SMALL_DIR)
    assert "l_shipdate" not in plan(profile.orders_per_month(raw["orders"]))
    assert "l_shipdate" in plan(raw["orders"].select(F.max("order_delivered_customer_date")))


def test_keys_combine_before_the_shuffle(spark):
    raw = marketplace(spark, SMALL_DIR)
    text = plan(reference_count(raw["order_items"], "product_id", raw["products"], "product_id"))
    assert "partial_count" in text and "Join" not in text and "Sort" not in text


def test_the_register_reads_every_table_once(spark, raw, tmp_path):
    landed = {}
    for name, df in raw.items():
        df.write.parquet(f"{tmp_path}/{name}")
        landed[name] = spark.read.parquet(f"{tmp_path}/{name}")
    text = plan(quality.issues(landed))
    assert text.count("FileScan parquet") == len(quality.CRITICAL_COLUMNS)
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text and "Sort" not in text


def test_register_columns_agree_with_the_single_audits(raw):
    """What one pass finds is what the audits find on their own."""
    found = {(r["check"], r["table"], r["column"]): r["count"] for r in quality.issues(raw).collect()}
    expected = {("nulo_critico", r["table"], r["column"]): r["nulls"] for r in quality.critical_nulls(raw).collect()}
    expected |= {("duplicado_pk", r["table"], r["column"]): r["duplicates"] for r in quality.duplicate_keys(raw).collect()}
    expected |= {("integridad_referencial", r["table"], r["column"]): r["orphans"] for r in quality.orphans(raw).collect()}
    expected[("fecha_nula", "orders", quality.PURCHASE)] = quality.date_span(raw["orders"]).first()["nulls"]
    expected[("brecha_temporal", "orders", quality.PURCHASE)] = quality.missing_months(raw["orders"]).count()
    assert found == {k: n for k, n in expected.items() if n}


def test_bounds_read_the_first_and_the_last_month_only(star):
    months = sorted(r[0] for r in star["fact_orders"].select("purchase_month").distinct().collect())
    bounds = range_reports.range_bounds(star)
    assert re.search(rf"PartitionFilters: .*purchase_month#\d+ IN \({months[0]},{months[-1]}\)\]", plan(bounds))
    assert "Join" not in plan(bounds) and len(months) > 2
    assert bounds.first() == range_reports.range_bounds({k: df for k, df in star.items() if k != "fact_ends"}).first()

from datetime import datetime, timedelta

import pytest

from starbazaar import catalog
from starbazaar.operators.constraints import validate
from starbazaar.plans.pipeline import run_pipeline
from starbazaar.sources import warehouse

RULE = ("dim_seller", "max_length", "zip_code_prefix")


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Given tables whose sellers have numbers of five and of six digits."""
    folder, day = str(tmp_path_factory.mktemp("many")), datetime(1997, 1, 5)
    sellers, orders = (99_998, 99_999, 100_000, 359_999), range(1, 41)
    tables = {
        "customer": ([(i, f"c{i}", i % 25, i * 100.0, "BUILDING") for i in range(1, 6)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(s, f"s{s}", 3, 10.0) for s in sellers], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(1, "p", "b", "SMALL", 3, 1.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        # An estimate counts from the order's number, so small ones would lie before the purchase.
        "orders": ([(i + 100, i % 5 + 1, "F", 50_000.0, day + timedelta(days=i), "5-LOW") for i in orders],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i + 100, 1, sellers[(i + n) % 4], n + 1, 5.0, 100.0 + i, 0.0, 0.1, "A", "O" if n else "F", day + timedelta(days=i + 3))
                      for i in orders for n in range(2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                     " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_reports_run_with_sellers_of_six_digits(spark, many):
    found = {name: catalog.queries()[name](spark, many).collect() for name in ("monthly_review_score_trend", "shown_sellers", "ntile_scalable")}
    assert sum(r["total_reviews"] for r in found["monthly_review_score_trend"]) == 80
    assert sorted(r["seller_id"] for r in found["shown_sellers"]) == ["100000", "359999", "99998", "99999"]
    assert len(found["ntile_scalable"]) == 40


def test_their_zips_stay_whole_and_counted(spark, many):
    zips = {r["seller_id"]: r["zip_code_prefix"] for r in catalog.queries()["seller_dim"](spark, many).collect()}
    assert zips == {"99998": "99998", "99999": "99999", "100000": "100000", "359999": "359999"}
    broken = {tuple(r)[:3]: r["violations"] for r in catalog.queries()["constraint_report"](spark, many).where("violations > 0").collect()}
    assert broken == {RULE: 2}


def test_jobs_run_with_sellers_of_six_digits(spark, many):
    queries = catalog.queries()
    assert queries["job_from_csv"](spark, many).count() == queries["order_item_fact"](spark, many).count() > 0
    assert queries["load_metrics"](spark, many).where("problems > 0").count() == 0
    assert {r["table"]: r["rows"] for r in queries["ready_made_load"](spark, many).collect()}["dim_seller"] == 4


def test_only_the_tolerated_rule_is_tolerated(spark, raw, tmp_path):
    long_zip = raw["customers"].where("customer_id <> 'c2'")
    sellers = raw["sellers"].replace("7", "123456", "seller_zip_code_prefix")
    tables = raw | {"customers": long_zip, "sellers": sellers}
    with pytest.raises(warehouse.ConstraintViolation) as refused:
        run_pipeline(spark, lambda: tables, str(tmp_path / "strict"))
    assert refused.value.violations == [(*RULE, 1)]
    star, _ = run_pipeline(spark, lambda: tables, str(tmp_path / "told"), tolerated=[RULE])
    assert {tuple(r) for r in validate(star).where("violations > 0").collect()} == {(*RULE, 1)}
    noted = warehouse.load_metrics(spark, str(tmp_path / "told"))
    assert {r["table"]: (r["problems"], r["tolerated"]) for r in noted.where("problems + tolerated > 0").collect()} == {"dim_seller": (0, 1)}
    costly = tables | {"order_items": tables["order_items"].withColumn("price", -tables["order_items"]["price"])}
    with pytest.raises(warehouse.ConstraintViolation) as refused:
        run_pipeline(spark, lambda: costly, str(tmp_path / "told"), tolerated=[RULE])
    assert {v[:3] for v in refused.value.violations} == {("fact_orders", "price_not_negative", "price")}

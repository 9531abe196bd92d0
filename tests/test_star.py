from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import raw_table
from starbazaar.operators.constraints import validate
from starbazaar.plans import dimensions as dims
from starbazaar.plans.fact import classified_items, fact_rows, order_headers
from starbazaar.plans.star import transform
from starbazaar.session import app_dir
from starbazaar.sources.warehouse import StarWriter, read_rejects


@pytest.fixture(scope="module")
def writer(spark, tmp_path_factory):
    return StarWriter(spark, str(tmp_path_factory.mktemp("star")), own_keys=True)


@pytest.fixture(scope="module")
def star(spark, raw, writer):
    return transform(spark, raw, writer)


def test_fact_rows(star):
    rows = star["fact_orders"].orderBy("order_id", "price").collect()
    assert [r["order_id"] for r in rows] == ["o1", "o1", "o2", "o3"]  # the same product twice stays two rows
    first, second, late, canceled = rows
    assert first.asDict() | {"order_key": 0} == second.asDict() | {"order_key": 0}
    assert first["date_key"] == 20170110 and first["purchase_month"] == 201701
    assert (first["delivery_days"], first["estimated_delivery_days"], first["is_late_delivery"]) == (0, 21, False)
    assert (first["payment_value"], first["payment_type"], first["review_score"]) == (30, "credit_card", 5)
    assert late["is_late_delivery"] is True and late["delivery_days"] == 12
    assert late["payment_value"] is None and late["review_score"] is None
    assert canceled["delivery_days"] is None and canceled["is_late_delivery"] is None  # delivered before purchase


def test_rejected_rows(spark, star, writer):
    found = sorted(((r["source_table"], r["reason"], r["order_id"], r["product_id"], r["seller_id"])
                    for r in read_rejects(spark, writer.path).collect()), key=str)
    assert found == sorted([
        ("orders", "missing_key", "no-customer", None, None),
        ("order_items", "missing_key", "o1", None, "s1"),
        ("order_items", "no_purchase_time", "no-time", "p1", "s1"),
        ("order_items", "no_valid_estimate", "early-promise", "p1", "s1"),
        ("order_items", "unknown_customer", "stranger", "p1", "s1"),
        ("order_items", "unknown_order", "no-customer", "p1", "s1"),
        ("order_items", "unknown_product", "o1", "p9", "s1"),
        ("order_items", "unknown_seller", "o1", "p1", "s9"),
        ("products", "duplicate_key", None, "p1", None),
    ], key=str)


def test_every_item_is_kept_or_rejected(spark, raw, star, writer):
    rejected = read_rejects(spark, writer.path).where("source_table = 'order_items'").count()
    assert star["fact_orders"].count() + rejected == raw["order_items"].count()


def test_dimensions(star):
    customers = {r["customer_id"]: r for r in star["dim_customer"].collect()}
    assert [customers[c]["zip_code_prefix"] for c in ("c1", "c2", "c3")] == ["00123", "123456", None]
    assert [customers[c]["customer_key"] for c in ("c1", "c2", "c3")] == [1, 2, 3]
    products = {r["product_id"]: (r["category_name_pt"], r["category_name_en"]) for r in star["dim_product"].collect()}
    assert products == {"p1": ("cama", "bed"), "p2": ("sem_nome", None), "p3": (None, None)}
    places = {r["zip_code_prefix"]: r for r in star["dim_location"].collect()}
    assert set(places) == {"01037", "00005"}
    assert (places["01037"]["lat"], places["01037"]["lng"]) == (Decimal("2.5"), Decimal("-2.5"))
    assert places["01037"]["city"] == "a" and places["00005"]["lat"] is None
    assert star["dim_seller"].first()["zip_code_prefix"] == "00007"


def test_dates_come_from_orders_with_their_keys(star):
    days = {r["full_date"]: r for r in star["dim_date"].collect()}
    assert date(2017, 1, 5) in days  # an order without items counts
    ordinary = days[date(2017, 2, 1)]
    assert (ordinary["date_key"], ordinary["month_name"], ordinary["day_name"]) == (20170201, "February", "Wednesday")
    assert (ordinary["week"], ordinary["day_of_week"], ordinary["quarter"], ordinary["is_weekend"]) == (5, 3, 1, False)


def test_null_category_matches_a_null_translation(spark, raw):
    xlat = raw_table(spark, "category_xlat", [{"product_category_name_english": "none at all"}])
    names = {r["product_id"]: r["category_name_en"] for r in dims.product_dimension(raw["products"], xlat).collect()}
    assert names == {"p1": None, "p2": None, "p3": "none at all"}


def test_star_obeys_its_rules_but_for_the_long_zip(star):
    broken = {(r["table"], r["constraint"], r["column"]): r["violations"]
              for r in validate(star).where("violations > 0").collect()}
    assert broken == {("dim_customer", "max_length", "zip_code_prefix"): 1}


def test_empty_input(spark, raw, tmp_path):
    writer = StarWriter(spark, str(tmp_path), own_keys=True)
    star = transform(spark, {name: df.limit(0) for name, df in raw.items()}, writer)
    assert all(df.count() == 0 for df in star.values())
    assert validate(star).agg(F.sum("violations")).first()[0] == 0


def test_a_hot_order_is_split(spark):
    """One order holds a third of the items. The written headers let adaptive execution split its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        number = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id").cast("string")))
        items = spark.range(0, 90_000, 1, 8).select(
            number.alias("order_id"), F.concat(F.lit("p"), (F.col("id") % 5000).cast("string")).alias("product_id"),
            F.concat(F.lit("s"), (F.col("id") % 700).cast("string")).alias("seller_id"),
            (F.rand(1) * 1000000).cast("decimal(18,2)").alias("price"), F.lit(1).cast("decimal(18,2)").alias("freight_value"))
        folder = f"{app_dir(spark)}/hot-order"
        bought = F.lit("2017-01-01").cast("timestamp_ntz")
        orders = items.select("order_id").distinct().select(
            "order_id", F.col("order_id").alias("customer_id"), F.lit("delivered").alias("order_status"),
            bought.alias("order_purchase_timestamp"), bought.alias("order_delivered_customer_date"),
            bought.alias("order_estimated_delivery_date"))
        customers = orders.select("customer_id", F.monotonically_increasing_id().alias("customer_key"))
        payments = raw_table(spark, "payments", [])
        reviews = raw_table(spark, "reviews", [])
        for name, df in {
            "items": items, "headers": order_headers(orders, customers, payments, reviews),
            "products": items.select("product_id").distinct().withColumn("product_key", F.lit(1)),
            "sellers": items.select("seller_id").distinct().withColumn("seller_key", F.lit(1)),
        }.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
        read = {n: spark.read.parquet(f"{folder}/{n}") for n in ("items", "headers", "products", "sellers")}
        fact = fact_rows(classified_items(read["items"], read["headers"], read["products"], read["sellers"]))
        plan = fact.select("order_id", "product_key", "seller_key", "price")
        assert len(plan.collect()) == 90_000
        assert "SortMergeJoin(skew=true) [order_id" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_the_work_folder_does_not_grow(spark, raw, tmp_path):
    import os

    from starbazaar.plans.kpis import KPIS
    from starbazaar.session import app_dir
    from starbazaar.sources.warehouse import StarWriter

    def tables():
        return sorted(f"{d}/{n}" for d, names, _ in os.walk(f"{app_dir(spark)}/work") for n in names if d.count("-") or n)

    before = tables()
    built = transform(spark, raw, StarWriter(spark, str(tmp_path), own_keys=True))
    assert tables() == before
    sizes = []
    for _ in range(3):
        for name in ("rfm_analysis", "payment_method_distribution"):
            KPIS[name](built).collect()
        sizes.append(len(tables()))
    assert sizes[0] <= len(before) + 1 and len(set(sizes)) == 1

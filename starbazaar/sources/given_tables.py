"""Marketplace raw tables derived from the given parquet tables (customer, orders, lineitem, part, supplier).

Every raw row comes from a given row, so the work grows with the input. Keys are turned into text before any
grouping, so that a grouping by order leaves the data partitioned the way the later joins on order_id need it.

``damaged=True`` keeps every row but spoils some values (missing and dangling keys, repeated keys, scores and
prices out of range, a month without purchases), so that the audits have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.functions.scalars import zero_pad
from starbazaar.sources.schemas import RAW

DAY_SECONDS = 86400
# How the given codes read as marketplace codes.
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_TYPE = {"A": "credit_card", "N": "boleto", "R": "voucher"}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def marketplace(spark: SparkSession, sf_dir: str, damaged: bool = False) -> dict[str, DataFrame]:
    """The nine raw tables."""
    lines = _lines(given(spark, sf_dir, "lineitem"))
    headers = given(spark, sf_dir, "orders")
    people = given(spark, sf_dir, "customer")
    parts = given(spark, sf_dir, "part")

    tables = {
        "orders": _orders(headers, lines),
        "customers": _customers(headers, people),
        "order_items": _order_items(lines),
        "payments": _payments(lines),
        "reviews": _reviews(lines),
        "products": _products(parts),
        "sellers": _sellers(given(spark, sf_dir, "supplier")),
        "geolocation": _geolocation(people),
        "category_xlat": _translations(parts),
    }
    if damaged:
        tables = _spoil(tables)
    return {name: df.select(RAW[name].names) for name, df in tables.items()}


def _code(column: str, mapping: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))[F.col(column)]


def _plus_seconds(day: Column, key: Column, factor: int) -> Column:
    return F.timestamp_add("SECOND", key * factor % DAY_SECONDS, day)


def _state(nation: str) -> Column:
    return zero_pad(F.col(nation).cast("string"), 2)


def _lines(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    return lineitem.withColumns({
        "order_id": F.col("l_orderkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "seller_id": F.col("l_suppkey").cast("string"),
        "price": price,
    })


def _orders(headers: DataFrame, lines: DataFrame) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shipped = lines.groupBy("order_id").agg(F.max("l_shipdate").alias("last_ship"))
    purchase = F.when(key % 1000 != 999, _plus_seconds(day, key, 7919))
    orders = headers.select(
        "*",
        key.cast("string").alias("order_id"),
        purchase.alias("order_purchase_timestamp"),
    ).join(shipped, "order_id", "left")
    return orders.select(
        "order_id",
        F.col("order_id").alias("customer_id"),
        F.when(key % 97 == 0, "unavailable").otherwise(_code("o_orderstatus", ORDER_STATUS)).alias("order_status"),
        "order_purchase_timestamp",
        F.timestamp_add("DAY", F.lit(1), "order_purchase_timestamp").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        _plus_seconds(F.col("last_ship"), key, 104729).alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", key % 2400 - 20, day).alias("order_estimated_delivery_date"),
        # Helper columns for the damaged variant; ``marketplace`` drops them.
        "o_orderpriority", "o_totalprice", "o_custkey", "o_orderdate",
    )


def _customers(headers: DataFrame, people: DataFrame) -> DataFrame:
    joined = headers.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("customer_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), (F.col("o_orderkey") % 8).cast("string"))
        .alias("customer_unique_id"),
        _zip().alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
        "o_orderpriority", "c_acctbal",
    )


def _zip() -> Column:
    return (F.col("c_custkey") % 500).cast("string")


def _order_items(lines: DataFrame) -> DataFrame:
    freight = F.round(F.col("price") * F.col("l_tax").cast("decimal(4,2)"), 2)
    return lines.select(
        "order_id", F.col("l_linenumber").alias("order_item_id"), "product_id", "seller_id",
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("price").cast("decimal(18,2)").alias("price"),
        freight.cast("decimal(18,2)").alias("freight_value"),
        "l_quantity",
    )


def _payments(lines: DataFrame) -> DataFrame:
    paid = F.round(F.col("price") * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
    return lines.where("l_linestatus = 'F'").select(
        "order_id", F.col("l_linenumber").alias("payment_sequential"),
        _code("l_returnflag", PAYMENT_TYPE).alias("payment_type"),
        (F.col("l_quantity").cast("int") % 12 + 1).alias("payment_installments"),
        paid.cast("decimal(18,2)").alias("payment_value"),
        "l_quantity",
    )


def _reviews(lines: DataFrame) -> DataFrame:
    # Whatever is not a payment is a review, so that no line is left out.
    return lines.where("l_linestatus IS DISTINCT FROM 'F'").select(
        F.concat_ws("-", "order_id", "product_id", "seller_id", F.col("l_linenumber").cast("string"))
        .alias("review_id"),
        "order_id",
        ((F.col("l_linenumber") - 1) % 5 + 1).alias("review_score"),
        F.col("l_shipdate").alias("review_creation_date"),
        F.col("l_shipdate").alias("review_answer_timestamp"),
        "l_quantity",
    )


def _products(parts: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    side = F.when(F.col("p_size") % 7 != 0, size)
    return parts.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"),
        (size * 100).alias("product_weight_g"), size.alias("product_length_cm"),
        side.alias("product_height_cm"), side.alias("product_width_cm"),
        "p_size",
    )


def _sellers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_suppkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"), _state("s_nationkey").alias("seller_state"),
        "s_acctbal",
    )


def _geolocation(people: DataFrame) -> DataFrame:
    return people.select(
        _zip().alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 1000).alias("geolocation_lat"),
        (-F.col("c_acctbal") / 2000).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"), _state("c_nationkey").alias("geolocation_state"),
    )


def _translations(parts: DataFrame) -> DataFrame:
    # PROMO stays untranslated, which exercises the fallback to the original name.
    return parts.where("p_type <> 'PROMO'").select(
        F.col("p_type").alias("product_category_name"), F.lower("p_type").alias("product_category_name_english"),
    ).distinct()


def _spoil(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Damage values by ordinary attributes. All rows stay; one translation is added."""
    priority, quantity = F.col("o_orderpriority"), F.col("l_quantity")
    canceled = F.col("order_status") == "canceled"
    dangling = F.concat(F.lit("lost-"), F.col("order_id"))
    spoiled = dict(tables)
    spoiled["orders"] = tables["orders"].withColumns({
        "customer_id": F.when(canceled & (priority == "5-LOW"), F.lit(None))
        .when(canceled & (priority == "1-URGENT"), F.concat(F.lit("lost-"), F.col("customer_id")))
        .otherwise(F.col("customer_id")),
        # A low total makes the order reuse the number of another order.
        "order_id": F.when(F.col("o_totalprice") < 20000, F.col("o_custkey").cast("string"))
        .otherwise(F.col("order_id")),
        "order_purchase_timestamp": F.when(F.month("o_orderdate") != 2, F.col("order_purchase_timestamp")),
    })
    spoiled["customers"] = tables["customers"].withColumns({
        "customer_id": F.when((priority == "2-HIGH") & (F.col("c_acctbal") < 0), F.lit(None))
        .otherwise(F.col("customer_id")),
        "customer_state": F.when(priority != "3-MEDIUM", F.col("customer_state")),
        "customer_city": F.when(F.col("c_acctbal") < 9000, F.col("customer_city"))
        .otherwise(F.repeat("customer_city", 20)),
    })
    spoiled["order_items"] = tables["order_items"].withColumns({
        "order_id": F.when(quantity == 1, dangling).otherwise(F.col("order_id")),
        "product_id": F.when(quantity == 2, F.lit(None)).when(quantity == 3, F.lit("lost"))
        .otherwise(F.col("product_id")),
        "seller_id": F.when(quantity == 4, F.lit(None)).when(quantity == 5, F.lit("lost"))
        .otherwise(F.col("seller_id")),
        "price": F.when(quantity == 6, -F.col("price")).otherwise(F.col("price")),
        "freight_value": F.when(quantity != 7, F.col("freight_value")),
    })
    spoiled["payments"] = tables["payments"].withColumns({
        "order_id": F.when(quantity == 8, F.lit(None)).when(quantity == 9, dangling).otherwise(F.col("order_id")),
        "payment_installments": F.when(quantity == 10, -1).otherwise(F.col("payment_installments")),
        "payment_value": F.when(quantity == 11, F.col("payment_value") + 100000000)
        .otherwise(F.col("payment_value")),
    })
    spoiled["reviews"] = tables["reviews"].withColumns({
        "review_id": F.when(quantity != 12, F.col("review_id")),
        "order_id": F.when(quantity == 13, dangling).otherwise(F.col("order_id")),
        "review_score": F.when(quantity == 14, 6).otherwise(F.col("review_score")),
    })
    spoiled["products"] = tables["products"].withColumn(
        "product_id", F.when(F.col("p_size") == 50, F.lit(None)).otherwise(F.col("product_id")))
    spoiled["sellers"] = tables["sellers"].withColumn(
        "seller_id", F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.col("seller_id")))
    # One category gets a second translation, which fans its products out.
    xlat = tables["category_xlat"]
    again = xlat.where("product_category_name = 'SMALL'").withColumn(
        "product_category_name_english", F.lit("tiny"))
    spoiled["category_xlat"] = xlat.unionByName(again)
    return spoiled

"""The order-item fact and the rows it turns away."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbazaar.functions.scalars import UNKNOWN_DATE_KEY, date_key, is_late, month_number, revenue, whole_days
from starbazaar.operators.dedupe import dominant_payment, latest_review
from starbazaar.sources.schemas import KEPT, REJECT_KEYS

ITEM_KEYS = ["order_id", "product_id", "seller_id"]
ORDER_KEYS = ["order_id", "customer_id"]


def order_headers(
    orders: DataFrame, customer_keys: DataFrame, payments: DataFrame, reviews: DataFrame, days: tuple[str, ...] = (),
) -> DataFrame:
    """Everything the fact needs at order level, one row per raw order that has its keys; the days of the times in ``days`` besides.

    Payments and reviews are reduced to one row per order before they meet the orders, so nothing fans out.
    Orders that cannot enter the fact stay in, marked with the reason, for the reject report.
    """
    purchase = F.col("order_purchase_timestamp")
    promised, delivered = F.col("order_estimated_delivery_date"), F.col("order_delivered_customer_date")
    headers = orders.dropna(subset=ORDER_KEYS).select(
        "order_id", "customer_id", "order_status",
        date_key(purchase).alias("date_key"),
        month_number(purchase).alias("purchase_month"),
        whole_days(delivered, purchase).alias("delivery_days"),
        whole_days(promised, purchase).alias("estimated_delivery_days"),
        is_late(whole_days(delivered, purchase), delivered, promised).alias("is_late_delivery"),
        *(F.to_date(c).alias(c) for c in days),
    )
    # The two joins on order_id share one partitioning; the customers come after them.
    joined = (
        headers
        .join(dominant_payment(payments.where("order_id IS NOT NULL")), "order_id", "left")
        .join(latest_review(reviews.where("order_id IS NOT NULL")), "order_id", "left")
        .join(customer_keys.select("customer_id", "customer_key"), "customer_id", "left")
    )
    reason = (
        F.when(F.col("date_key") == UNKNOWN_DATE_KEY, "no_purchase_time")
        .when(F.col("customer_key").isNull(), "unknown_customer")
        .when(F.col("estimated_delivery_days").isNull(), "no_valid_estimate")
    )
    return joined.withColumn("order_reason", reason)


def classified_items(
    items: DataFrame, headers: DataFrame, product_keys: DataFrame, seller_keys: DataFrame,
) -> DataFrame:
    """Order items with their fact columns and the reason for a reject (``none`` for fact rows); product_id and seller_id of unknown ones only.

    ``headers`` should come from a written table: then the join on order_id shuffles both sides itself and
    adaptive skew handling can split an order that holds a large share of all items. Items have no NULL keys
    here, so the outer joins collect no NULL group either.
    """
    complete = items.dropna(subset=ITEM_KEYS).select(*ITEM_KEYS, "price", "freight_value")
    looked_up = (
        complete
        .join(product_keys.select("product_id", "product_key"), "product_id", "left")
        .join(seller_keys.select("seller_id", "seller_key"), "seller_id", "left")
    )
    # A key that was found need not move with its row any further: the surrogate key stands for it.
    unknown = {f"{kind}_id": F.when(F.col(f"{kind}_key").isNull(), F.col(f"{kind}_id")) for kind in ("product", "seller")}
    joined = looked_up.withColumns(unknown).join(headers.withColumn("_known", F.lit(True)), "order_id", "left")
    reason = (
        F.when(F.col("_known").isNull(), "unknown_order")
        .when(F.col("order_reason") == "no_purchase_time", F.col("order_reason"))
        .when(F.col("order_reason") == "unknown_customer", F.col("order_reason"))
        .when(F.col("product_key").isNull(), "unknown_product")
        .when(F.col("seller_key").isNull(), "unknown_seller")
        .when(F.col("order_reason").isNotNull(), F.col("order_reason"))
        .otherwise(KEPT)
    )
    return joined.withColumn("reject_reason", reason).withColumn(
        "purchase_month", F.when(F.col("reject_reason") == KEPT, F.col("purchase_month")))


def fact_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason") == KEPT)


def turned_away(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw rows that never reach the star, beside the items that the fact build itself rejects: rows without a key, repeats of a
    dimension's key, payments and reviews of no order. ``rows`` tells for how many raw rows a line stands.

    Repeats and strangers come from one grouping of all keys: every table is read once for it, and a key with very many rows is one
    row per task.
    """
    keys = {"customers": "customer_id", "products": "product_id", "sellers": "seller_id", "orders": "order_id"}
    children = ("payments", "reviews")

    def line(table: str, reason: Column, key: str, value: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(table).alias("source_table"), reason.alias("reason"),
            *((value if k == key else F.lit(None)).cast("string").alias(k) for k in REJECT_KEYS), rows.cast("bigint").alias("rows"))

    def missing(table: str, own: list[str]) -> DataFrame:
        absent = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in own))
        columns = ((F.col(k) if k in own else F.lit(None)).cast("string").alias(k) for k in REJECT_KEYS)
        return raw[table].where(absent).select(
            F.lit(table).alias("source_table"), F.lit("missing_key").alias("reason"), *columns, F.lit(1).cast("bigint").alias("rows"))

    def of_role(table: str, column: str, key: int, role: int) -> DataFrame:
        # Small numbers in place of names; they are part of every row.
        return raw[table].select(F.lit(key).cast("byte").alias("key"), F.col(column).alias("value"), F.lit(role).cast("byte").alias("role"))

    order_key = list(keys).index("orders")
    seen = reduce(DataFrame.unionByName, [
        *(of_role(table, column, i, -1) for i, (table, column) in enumerate(keys.items())),
        *(of_role(table, "order_id", order_key, i) for i, table in enumerate(children))])
    counted = seen.groupBy("key", "value").agg(
        F.count_if(F.col("role") == -1).alias("parents"), *(F.count_if(F.col("role") == i).alias(c) for i, c in enumerate(children)))
    value, known = F.col("value"), F.col("value").isNotNull() & (F.col("parents") > 0)
    found = [F.when((F.col("key") == i) & (F.col("parents") > 1), line(table, F.lit("duplicate_key"), column, value, F.col("parents") - 1))
             for i, (table, column) in enumerate(keys.items()) if i != order_key]
    found += [F.when((F.col(c) > 0) & ~known, line(
        c, F.when(value.isNull(), "missing_key").otherwise("unknown_order"), "order_id", value, F.col(c))) for c in children]
    strange = counted.select(F.explode(F.array(*found)).alias("line")).where("line IS NOT NULL").select("line.*")
    return missing("orders", ORDER_KEYS).unionByName(missing("order_items", ITEM_KEYS)).unionByName(strange)


def order_spans(fact: DataFrame) -> DataFrame:
    """Each order's whole revenue, a month it has items in, and whether all its items are in that month."""
    month = F.expr("date_key div 100").cast("int")
    return fact.groupBy("order_id").agg(
        F.sum(revenue()).cast("decimal(32,2)").alias("order_total"), F.min(month).alias("purchase_month"),
        (F.coalesce(F.min(month) == F.max(month), F.lit(False)) & (F.count(month) == F.count("*"))).alias("one_month"))


def order_totals(fact: DataFrame) -> DataFrame:
    """Each order's whole revenue, a row for every month it has items in: a period then needs only its own months."""
    months = fact.groupBy("order_id", F.expr("date_key div 100").cast("int").alias("purchase_month")).agg(F.sum(revenue()).alias("part"))
    whole = Window.partitionBy("order_id")  # as many rows as an order has months
    return months.select("order_id", F.sum("part").over(whole).cast("decimal(32,2)").alias("order_total"), "purchase_month")

"""The five dimensions, before and after numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbazaar.functions.scalars import date_key, iso_weekday, zero_pad
from starbazaar.operators.dedupe import first_per_key
from starbazaar.operators.numbering import group_medians

# The carrier date is not among them.
CALENDAR_COLUMNS = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def clean_orders(orders: DataFrame) -> DataFrame:
    return orders.dropna(subset=["order_id", "customer_id"])


def date_dimension(orders: DataFrame) -> DataFrame:
    """Calendar days seen in the orders; one scan, and only distinct days are shuffled."""
    day = F.explode(F.array(*(F.to_date(c) for c in CALENDAR_COLUMNS))).alias("full_date")
    days = clean_orders(orders).select(day).where("full_date IS NOT NULL").distinct()
    full, weekday = F.col("full_date"), iso_weekday(F.col("full_date"))
    return days.select(
        date_key(full).alias("date_key"),
        full,
        F.year(full).alias("year"),
        F.quarter(full).alias("quarter"),
        F.month(full).alias("month"),
        F.date_format(full, "MMMM").alias("month_name"),
        F.weekofyear(full).alias("week"),
        F.dayofmonth(full).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(full, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def _with_plain_address(df: DataFrame, prefix: str) -> DataFrame:
    renamed = df.withColumnsRenamed({
        f"{prefix}_city": "city", f"{prefix}_state": "state", f"{prefix}_zip_code_prefix": "zip_code_prefix",
    })
    return renamed.withColumn("zip_code_prefix", zero_pad(F.col("zip_code_prefix")))


def customer_dimension(customers: DataFrame) -> DataFrame:
    chosen = customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix")
    return _with_plain_address(first_per_key(chosen, "customer_id"), "customer")


def seller_dimension(sellers: DataFrame) -> DataFrame:
    chosen = sellers.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")
    return _with_plain_address(first_per_key(chosen, "seller_id"), "seller")


def product_dimension(products: DataFrame, translations: DataFrame) -> DataFrame:
    """A category without translation keeps its original name only. NULL matches NULL here."""
    chosen = products.select(
        "product_id", "product_category_name", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm")
    english = translations.select(
        F.col("product_category_name").alias("_category"),
        F.col("product_category_name_english").alias("category_name_en"))
    matched = F.col("product_category_name").eqNullSafe(F.col("_category"))
    return first_per_key(chosen, "product_id").join(english, matched, "left").select(
        "product_id",
        F.col("product_category_name").alias("category_name_pt"),
        "category_name_en",
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def location_dimension(geolocation: DataFrame) -> DataFrame:
    """One row per padded zip: the first known city and state, the median coordinates."""
    points = geolocation.select(
        zero_pad(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        F.col("geolocation_city").alias("city"), F.col("geolocation_state").alias("state"),
        F.col("geolocation_lat").alias("lat"), F.col("geolocation_lng").alias("lng"),
    ).where("zip_code_prefix IS NOT NULL")

    def first_known(column: str):
        order = F.struct("city", "lat", "lng", "state")
        return F.min_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)

    names = points.groupBy("zip_code_prefix").agg(first_known("city"), first_known("state"))
    return names.join(group_medians(points, "zip_code_prefix", ["lat", "lng"]), "zip_code_prefix", "left")

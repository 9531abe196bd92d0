"""Reports for a period, and their presentation columns.

A period is two dates, both included. It becomes a range of the fact's own day key and of its month partitions,
so only the months asked for are read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbazaar.functions import presentation as show
from starbazaar.functions.scalars import counted_sale, exact_avg, revenue
from starbazaar.plans.fact import order_totals
from starbazaar.plans.kpis import Star, category_sales, money, month_start, order_month_totals

# The period offered while the fact is empty.
DEFAULT_START, DEFAULT_END = date(2016, 1, 1), date(2018, 12, 31)
# The period advised for analyses of the published data set, whose first and last months are only partly covered.
ANALYSIS_PERIOD = (date(2017, 1, 1), date(2018, 8, 31))


def _day_number(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def in_period(rows: DataFrame, start: date, end: date) -> DataFrame:
    first, last = _day_number(start), _day_number(end)
    inside = F.col("date_key").between(first, last)
    if "purchase_month" in rows.columns:
        inside &= F.col("purchase_month").between(first // 100, last // 100)
    return rows.where(inside)


def period_sales(star: Star, start: date, end: date) -> DataFrame:
    return in_period(star["fact_orders"], start, end).where(counted_sale())


def range_bounds(star: Star) -> DataFrame:
    """First and last purchase date in the fact. Of a stored star only the first and the last month are read."""
    days = star["fact_ends"] if "fact_ends" in star else star["fact_orders"]

    def day(number: Column) -> Column:
        return F.make_date(F.floor(number / 10000).cast("int"), F.floor(number / 100).cast("int") % 100, number % 100)

    return days.agg(F.min("date_key").alias("first"), F.max("date_key").alias("last")).select(
        F.coalesce(day(F.col("first")), F.lit(DEFAULT_START)).alias("min_date"),
        F.coalesce(day(F.col("last")), F.lit(DEFAULT_END)).alias("max_date"))


def whole_period(star: Star) -> tuple[date, date]:
    """The period a report covers when none is chosen."""
    row = range_bounds(star).first()
    return row["min_date"], row["max_date"]


def _totals(star: Star, start: date, end: date) -> DataFrame:
    totals = star["order_totals"] if "order_totals" in star else order_totals(star["fact_orders"])
    return totals.where(F.col("purchase_month").between(_day_number(start) // 100, _day_number(end) // 100))


def range_headline(star: Star, start: date, end: date) -> DataFrame:
    """Orders, revenue, ticket and review score of a period.

    The ticket is an average over items of the item's whole order, and the order's total includes items outside
    the period. The totals are stored by month with the star, so only the period's months are read of either table.
    """
    per_order = period_sales(star, start, end).groupBy("order_id").agg(
        F.count("*").alias("items"), F.sum(revenue()).alias("revenue"), F.sum("review_score").alias("points"),
        F.count("review_score").alias("scores"), F.expr("min(date_key) div 100").cast("int").alias("purchase_month"),
    ).join(_totals(star, start, end), ["order_id", "purchase_month"])
    return per_order.agg(
        F.count("*").alias("total_orders"),
        money(F.sum("revenue")).alias("total_revenue"),
        F.round(F.try_divide(
            F.sum(F.col("order_total") * F.col("items")).cast("decimal(31,2)"),
            F.sum("items").cast("decimal(13,0)")), 2).alias("avg_ticket"),
        F.round(F.try_divide(F.sum("points").cast("decimal(20,0)"), F.sum("scores").cast("decimal(20,0)")), 2)
        .alias("avg_review_score"),
    )


def range_monthly(star: Star, start: date, end: date) -> DataFrame:
    return (
        order_month_totals(period_sales(star, start, end), star["dim_date"])
        .groupBy("year", "month")
        .agg(F.count("*").alias("num_orders"), money(F.sum("order_total")).alias("total_revenue"))
        .select("year", "month", month_start().alias("period"), "num_orders", "total_revenue")
        .orderBy("year", "month")
    )


def range_categories(star: Star, start: date, end: date) -> DataFrame:
    return (
        category_sales(period_sales(star, start, end), star["dim_product"])
        .withColumn("total_revenue", money(F.col("total_revenue")))
        .orderBy(F.desc("total_revenue"), "category")
        .limit(10)
    )


def range_payments(star: Star, start: date, end: date) -> DataFrame:
    per_type = period_sales(star, start, end).groupBy("payment_type").agg(
        F.count_distinct("order_id").alias("num_orders"), money(F.sum("payment_value")).alias("total_value"))
    return per_type.withColumn(
        "payment_type", F.coalesce("payment_type", F.lit("unknown"))
    ).orderBy(F.desc("num_orders"), "payment_type")


def range_sellers(star: Star, start: date, end: date) -> DataFrame:
    per_seller = period_sales(star, start, end).groupBy("seller_key").agg(
        F.count_distinct("order_id").alias("total_orders"), money(F.sum(revenue())).alias("total_revenue"))
    return (
        per_seller.join(star["dim_seller"].select("seller_key", "seller_id", "state"), "seller_key")
        .select("seller_id", "state", "total_orders", "total_revenue")
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(10)
    )


def shown_headline(headline: DataFrame, start: date, end: date) -> DataFrame:
    """The four cards and the period's caption as text."""
    first, last = F.lit(start), F.lit(end)
    return headline.select(
        show.count_text(F.col("total_orders")).alias("total_orders"),
        show.money_text(F.col("total_revenue")).alias("total_revenue"),
        show.money_text(F.col("avg_ticket")).alias("avg_ticket"),
        show.score_text(F.col("avg_review_score")).alias("avg_review_score"),
        show.day_label(first).alias("period_start"),
        show.day_label(last).alias("period_end"),
        show.period_days(first, last).alias("period_days"),
    )


def shown_monthly(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("period_label", show.month_label(F.col("period")))


def shown_categories(categories: DataFrame) -> DataFrame:
    """Smallest first, the order a horizontal bar chart wants."""
    return categories.orderBy("total_revenue", F.desc("category"))


def shown_payments(payments: DataFrame) -> DataFrame:
    return payments.withColumn("payment_label", show.payment_label(F.col("payment_type")))


def shown_sellers(sellers: DataFrame) -> DataFrame:
    """Order counts as text, revenue as a number beside the largest revenue for the progress bar."""
    largest = F.max("total_revenue").over(Window.partitionBy())  # over the ten rows of the report
    return sellers.select(
        "seller_id", "state", show.count_text(F.col("total_orders")).alias("total_orders"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        largest.cast("double").alias("max_revenue"),
    ).orderBy(F.desc("total_revenue"), "seller_id")


RANGE_REPORTS = {f.__name__: f for f in (
    range_headline, range_monthly, range_categories, range_payments, range_sellers,
)}

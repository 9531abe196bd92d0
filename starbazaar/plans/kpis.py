"""The eight fixed business reports on the star.

Each takes the star's tables and returns a DataFrame. Where a report needs an attribute of a large dimension,
the fact is first reduced to one row per surrogate key, so a key with a large share of the rows is combined
before it is shuffled or joined. No report gathers rows in one task; totals of totals run over grouped rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbazaar.functions.scalars import category_name, counted_sale, exact_avg, percent, percent_rows, revenue
from starbazaar.operators.numbering import tile
from starbazaar.session import work_table

Star = dict[str, DataFrame]
MONTH = ["year", "month", "month_name"]


def sales(star: Star) -> DataFrame:
    """Fact rows that count as sales."""
    return star["fact_orders"].where(counted_sale())


def money(value: Column) -> Column:
    return F.round(value, 2)


def month_start() -> Column:
    return F.make_date("year", "month", F.lit(1))


#: The star keeps this table beside its own once a report has needed it.
METRICS = "customer_metrics"


def order_month_totals(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per order and month with what its items cost together."""
    months = calendar.select("date_key", *MONTH)
    return rows.join(months, "date_key").groupBy("order_id", *MONTH).agg(F.sum(revenue()).alias("order_total"))


def monthly_revenue_and_avg_ticket(star: Star) -> DataFrame:
    """Per month: orders, revenue and the average order total.

    Grouping by order first leaves each order once per month, so counting rows counts distinct orders.
    """
    return (
        order_month_totals(sales(star), star["dim_date"])
        .groupBy(*MONTH)
        .agg(
            F.count("*").alias("num_orders"),
            money(F.sum("order_total")).alias("total_revenue"),
            exact_avg(F.col("order_total"), 2).alias("avg_ticket"),
        )
        .select(*MONTH, month_start().alias("period_start"), "num_orders", "total_revenue", "avg_ticket")
        .orderBy("year", "month")
    )


def category_sales(rows: DataFrame, products: DataFrame, *more: Column) -> DataFrame:
    """Orders and revenue per category, other aggregates on request."""
    names = products.select("product_key", category_name().alias("category"))
    return rows.join(names, "product_key").groupBy("category").agg(
        F.count_distinct("order_id").alias("num_orders"), F.sum(revenue()).alias("total_revenue"), *more)


def top10_categories_by_revenue(star: Star) -> DataFrame:
    return (
        category_sales(sales(star), star["dim_product"], exact_avg(F.col("price"), 2).alias("avg_item_price"))
        .orderBy(F.desc("total_revenue"), "category")
        .limit(10)
    )


def delivery_performance_by_state(star: Star) -> DataFrame:
    """Delivered items per customer state, worst punctuality first. Counts items of every status."""
    late = F.col("is_late_delivery")
    per_customer = star["fact_orders"].where(late.isNotNull()).groupBy("customer_key").agg(
        F.count("*").alias("items"),
        F.count_if(late).alias("late_items"),
        F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("days_known"),
        F.sum("estimated_delivery_days").alias("promised"),
        F.count("estimated_delivery_days").alias("promised_known"),
    )

    def average(total: str, known: str) -> Column:
        return F.round(F.try_divide(F.sum(total).cast("decimal(20,0)"), F.sum(known).cast("decimal(20,0)")), 1)

    total, missed = F.sum("items"), F.sum("late_items")
    return (
        per_customer.join(star["dim_customer"].select("customer_key", "state"), "customer_key")
        .groupBy("state")
        .agg(
            total.alias("total_delivered"),
            (total - missed).alias("on_time"),
            missed.alias("late"),
            percent_rows(total - missed, total, 1).alias("on_time_rate_pct"),
            average("days", "days_known").alias("avg_delivery_days"),
            average("promised", "promised_known").alias("avg_estimated_days"),
        )
        .orderBy(F.asc_nulls_last("on_time_rate_pct"), "state")
    )


def monthly_review_score_trend(star: Star) -> DataFrame:
    """Review scores per month of purchase, weighted by items as the fact repeats them. Every status counts."""
    score = F.col("review_score")
    per_day = star["fact_orders"].where(score.isNotNull()).groupBy("date_key").agg(
        F.count("*").alias("reviews"), F.sum(score).alias("points"),
        *(F.count_if(score == n).alias(f"score_{n}") for n in range(5, 0, -1)),
        F.count_if(score >= 4).alias("positive"),
    )
    reviews = F.sum("reviews")
    return (
        per_day.join(star["dim_date"].select("date_key", *MONTH), "date_key")
        .groupBy(*MONTH)
        .agg(
            reviews.alias("total_reviews"),
            F.round(F.sum("points").cast("decimal(20,0)") / reviews.cast("decimal(20,0)"), 2).alias("avg_score"),
            *(F.sum(f"score_{n}").alias(f"score_{n}") for n in range(5, 0, -1)),
            percent_rows(F.sum("positive"), reviews, 1).alias("positive_rate_pct"),
        )
        .orderBy("year", "month")
    )


def top10_sellers_by_revenue(star: Star) -> DataFrame:
    """Best sellers with their quality figures. Grouped on the fact's own key; only sellers meet the dimension."""
    late = F.col("is_late_delivery")
    per_seller = sales(star).groupBy("seller_key").agg(
        F.count_distinct("order_id").alias("num_orders"),
        money(F.sum(revenue())).alias("total_revenue"),
        exact_avg(F.col("price"), 2).alias("avg_item_price"),
        exact_avg(F.col("review_score"), 2).alias("avg_review_score"),
        percent_rows(F.count_if(late), F.count(late), 1).alias("late_delivery_rate_pct"),
    )
    sellers = star["dim_seller"].select(
        "seller_key", "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state"))
    return (
        per_seller.join(sellers, "seller_key")
        .select("seller_id", "seller_city", "seller_state", "num_orders", "total_revenue", "avg_item_price",
                "avg_review_score", "late_delivery_rate_pct")
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(10)
    )


def payment_method_distribution(star: Star) -> DataFrame:
    """Payment types with their shares. The payment value is an order's, repeated on each of its items.

    The totals are a window over the grouped rows, one for each payment type.
    """
    per_type = sales(star).groupBy("payment_type").agg(
        F.count_distinct("order_id").alias("num_orders"),
        F.sum("payment_value").alias("paid"),
        exact_avg(F.col("payment_installments"), 1).alias("avg_installments"),
    )
    everything = Window.partitionBy()
    orders, paid = (F.sum(c).over(everything) for c in ("num_orders", "paid"))
    return per_type.select(
        F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"),
        "num_orders",
        percent_rows(F.col("num_orders"), orders, 1).alias("orders_share_pct"),
        money(F.col("paid")).alias("total_payment_value"),
        percent(F.col("paid"), paid, 1).alias("revenue_share_pct"),
        "avg_installments",
    ).orderBy(F.desc("num_orders"), "payment_type")


def last_purchase_day(star: Star) -> DataFrame:
    """The latest purchase date in the fact, of any status: one row, ``max_date``."""
    used = star["dim_date"].join(star["fact_orders"].select("date_key").distinct(), "date_key", "left_semi")
    return used.agg(F.max("full_date").alias("max_date"))


def person_orders(star: Star, *more: Column) -> DataFrame:
    """Distinct orders per person, other aggregates of the person's sales on request.

    The distinct count combines (person, order) pairs first and spreads them by both, so a person with very
    many orders does not land in one task.
    """
    people = star["dim_customer"].select("customer_key", "customer_unique_id")
    return sales(star).join(people, "customer_key").groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("num_orders"), *more)


def customer_metrics(star: Star) -> DataFrame:
    """Recency, frequency and money per person. Day keys sort like days, so the latest day is the largest key."""
    metrics = person_orders(
        star, F.max("date_key").alias("date_key"), money(F.sum(revenue())).alias("monetary"))
    days = star["dim_date"].select("date_key", "full_date")
    latest = last_purchase_day(star).scalar()
    return metrics.join(days, "date_key").select(
        "customer_unique_id",
        F.datediff(latest, "full_date").alias("recency_days"),
        F.col("num_orders").alias("frequency"),
        "monetary",
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple; 1 is the best third. The first match wins."""
    return (
        F.when((r == 1) & (f == 1) & (m == 1), "Champions")
        .when((r <= 2) & (f >= 2), "Loyal")
        .when((r == 1) & (f == 1), "Recent")
        .when((r >= 3) & (f >= 2), "At Risk")
        .when((r == 3) & (f == 1), "Lost")
        .otherwise("Others")
    )


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Thirds by recency, frequency and money; equal values are told apart by the person's id.

    The three sorts do not depend on each other and are submitted together.
    """
    leading = {"r_score": F.col("recency_days"), "f_score": -F.col("frequency"), "m_score": -F.col("monetary")}

    def thirds(score: str) -> Column:
        return tile(metrics, 3, {"value": leading[score], "person": F.col("customer_unique_id")}, score)

    with ThreadPoolExecutor(len(leading)) as pool:
        scores = pool.map(inheritable_thread_target(metrics.sparkSession)(thirds), leading)
        return metrics.withColumns(dict(zip(leading, scores)))


def rfm_analysis(star: Star) -> DataFrame:
    """Scores and segment of every person. The metrics are written once for a star, then sorted by three narrow keys."""
    if METRICS not in star:
        star[METRICS] = work_table(customer_metrics(star), METRICS)
    scored = rfm_scores(star[METRICS])
    segment = rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return scored.withColumn("rfm_segment", segment).orderBy(F.desc("monetary"), "customer_unique_id")


def repurchase_rate(star: Star) -> DataFrame:
    """How many people came back. The average of repeat customers runs over the distinct order counts, each
    count once, however many people share it."""
    buckets = person_orders(star).groupBy("num_orders").agg(F.count("*").alias("people"))
    again = F.col("num_orders") >= 2
    everyone, returning = F.sum("people"), F.sum(F.when(again, F.col("people")).otherwise(0))
    return buckets.agg(
        everyone.alias("total_unique_customers"),
        F.sum(F.when(F.col("num_orders") == 1, F.col("people")).otherwise(0)).alias("single_order_customers"),
        returning.alias("repeat_customers"),
        percent_rows(returning, everyone, 2).alias("repurchase_rate_pct"),
        exact_avg(F.when(again, F.col("num_orders")), 2).alias("avg_orders_repeat_customers"),
    )


def state_share(star: Star) -> DataFrame:
    """Share of orders per customer state and per seller state."""
    def per_state(side: str) -> DataFrame:
        states = star[f"dim_{side}"].select(f"{side}_key", "state")
        rows = star["fact_orders"].select("order_id", f"{side}_key").join(states, f"{side}_key")
        return rows.groupBy(F.lit(side).alias("side"), "state").agg(F.count_distinct("order_id").alias("num_orders"))

    of_side = Window.partitionBy("side")  # over the states
    return per_state("customer").unionByName(per_state("seller")).withColumn(
        "share_pct", percent_rows(F.col("num_orders"), F.sum("num_orders").over(of_side), 1)
    ).orderBy("side", F.desc("num_orders"), "state")


def score_by_lateness(star: Star) -> DataFrame:
    """Average review score of late and punctual deliveries."""
    return star["fact_orders"].where("review_score IS NOT NULL").groupBy("is_late_delivery").agg(
        F.count("*").alias("reviews"), exact_avg(F.col("review_score"), 2).alias("avg_score"),
    ).orderBy(F.asc_nulls_last("is_late_delivery"))


KPIS = {f.__name__: f for f in (
    monthly_revenue_and_avg_ticket, top10_categories_by_revenue, delivery_performance_by_state,
    monthly_review_score_trend, top10_sellers_by_revenue, payment_method_distribution, rfm_analysis,
    repurchase_rate,
)}

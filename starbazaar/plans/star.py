"""Raw tables to star tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from starbazaar.plans import dimensions as dims
from starbazaar.plans.fact import classified_items, order_headers, turned_away
from starbazaar.session import app_dir, short_shuffles, work_scope, work_table
from starbazaar.sources.warehouse import StarWriter


def transform(spark: SparkSession, raw: dict[str, DataFrame], writer: StarWriter | None = None) -> dict[str, DataFrame]:
    """Build the six star tables from the nine raw ones.

    Every table is written as soon as it is ready (to the writer's version folder, or to a working folder) and
    read back, so keys are assigned once and the planner knows the sizes of the tables it joins. Intermediate tables are
    gone when it returns.
    """
    writer = writer or StarWriter(spark, f"{app_dir(spark)}/work", own_keys=True)
    orders, items = raw["orders"], raw["order_items"]
    builders = {
        "dim_customer": lambda: dims.customer_dimension(raw["customers"]),
        "dim_product": lambda: dims.product_dimension(raw["products"], raw["category_xlat"]),
        "dim_seller": lambda: dims.seller_dimension(raw["sellers"]),
        "dim_location": lambda: dims.location_dimension(raw["geolocation"]),
    }
    with work_scope(spark), short_shuffles(spark):
        # The dimensions do not depend on each other: submitted together, one's last tasks overlap another's first.
        with ThreadPoolExecutor(len(builders) + 1) as pool:
            build = inheritable_thread_target(spark)(lambda name: writer.write(name, builders[name]()))
            pending = {name: pool.submit(build, name) for name in builders}
            early = pool.submit(
                inheritable_thread_target(spark)(writer.write_rejects), turned_away(raw))
            headers = work_table(order_headers(
                orders, pending["dim_customer"].result(), raw["payments"], raw["reviews"], dims.CALENDAR_COLUMNS), "order-headers")
            # The headers are all orders that have their keys: with their days in them, orders are put together once.
            builders["dim_date"] = lambda: dims.date_dimension(headers)
            pending["dim_date"] = pool.submit(inheritable_thread_target(spark)(lambda: writer.write("dim_date", builders["dim_date"]())))
            classified = classified_items(items, headers, pending["dim_product"].result(), pending["dim_seller"].result())
            writer.write("fact_orders", classified)
            early.result()
            for result in pending.values():
                result.result()
    return writer.stored()

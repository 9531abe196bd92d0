"""First look at the raw tables: shapes, types, missing values, previews, orders over time and place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.functions.scalars import percent_rows

Raw = dict[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _column_rows(df: DataFrame, table: str, measure: str, per_column) -> DataFrame:
    """One aggregate over the table, turned into one row per column."""
    counts = df.agg(F.count("*").alias("rows"), *(per_column(c).alias(f"c{i}") for i, c in enumerate(df.columns)))
    lines = F.explode(F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                 F.col(f"c{i}").alias(measure))
        for i, c in enumerate(df.columns)
    )))
    return counts.select(F.lit(table).alias("table"), "rows", lines.alias("line")).select("table", "rows", "line.*")


def table_shapes(raw: Raw) -> DataFrame:
    """Rows of each table beside its columns and their types."""
    shapes = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.explode(F.array(*(
                F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
                for f in df.schema))).alias("line"),
        ).select("table", "rows", "columns", "line.*")
        for name, df in raw.items()
    ]
    return _union(shapes).orderBy("table", "column")


def null_profile(raw: Raw) -> DataFrame:
    """Share of missing values per column, only columns that miss some. One pass per table."""
    profile = _union([
        _column_rows(df, name, "nulls", lambda c: F.count_if(F.col(c).isNull())) for name, df in raw.items()
    ])
    return profile.where("nulls > 0").select(
        "table", "column", percent_rows(F.col("nulls"), F.col("rows"), 2).alias("null_pct")
    ).where("null_pct > 0").orderBy("table", "column")


def table_preview(df: DataFrame, order: list[str], rows: int = 3) -> DataFrame:
    """The first rows by key: a top-k per task, nothing is fully sorted."""
    return df.orderBy(*order).limit(rows)


def table_previews(raw: Raw, rows: int = 3) -> DataFrame:
    """The first rows of every table by all its columns, in long form: table, line, column, whether filled, and the value as text
    (money and other fractions in hundredths)."""
    def shown(field) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        if isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            return F.round(value * 100).cast("bigint").cast("string")
        return value.cast("string")

    parts = []
    for name, df in raw.items():
        first = df.orderBy(*(F.asc_nulls_last(c) for c in df.columns)).limit(rows)
        place = Window.orderBy(*(F.asc_nulls_last(c) for c in df.columns))  # over the few rows of the preview
        lines = F.explode(F.array(*(F.struct(
            F.lit(f.name).alias("column"), F.col(f.name).isNotNull().alias("filled"), shown(f).alias("value")) for f in df.schema)))
        parts.append(first.withColumn("line", F.row_number().over(place)).select(
            F.lit(name).alias("table"), "line", lines.alias("l")).select("table", "line", "l.*"))
    return _union(parts)


def orders_per_month(orders: DataFrame) -> DataFrame:
    month = F.date_format(F.trunc("order_purchase_timestamp", "month"), "yyyy-MM")
    return (
        orders.where("order_purchase_timestamp IS NOT NULL")
        .groupBy(month.alias("year_month")).agg(F.count("*").alias("num_orders"))
        .orderBy("year_month")
    )


def top_states(orders: DataFrame, customers: DataFrame, rows: int = 10) -> DataFrame:
    """States by number of orders. Orders without a known customer have no state and drop out of the ranking."""
    placed = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_state"), "customer_id", "left")
    return (
        placed.where("customer_state IS NOT NULL")
        .groupBy("customer_state").agg(F.count("*").alias("num_orders"))
        .orderBy(F.desc("num_orders"), "customer_state")
        .limit(rows)
    )

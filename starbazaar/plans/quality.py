"""Audits of the raw tables, and the register of what they found."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbazaar.functions.scalars import percent_rows, severity_rank, status_label
from starbazaar.operators.dedupe import duplicated_rows

Raw = dict[str, DataFrame]

# The audited keys, relations and severities.
CRITICAL_COLUMNS = {
    "orders": ["order_id", "customer_id"],
    "customers": ["customer_id"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "payments": ["order_id"],
    "reviews": ["order_id", "review_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}
PRIMARY_KEYS = {"orders": "order_id", "customers": "customer_id", "products": "product_id", "sellers": "seller_id"}
RELATIONS = [  # child, column, parent, severity
    ("orders", "customer_id", "customers", "alta"),
    ("order_items", "order_id", "orders", "alta"),
    ("order_items", "product_id", "products", "alta"),
    ("order_items", "seller_id", "sellers", "alta"),
    ("payments", "order_id", "orders", "media"),
    ("reviews", "order_id", "orders", "media"),
]
SEVERITIES = ("alta", "media", "baja")
PARENT = "parent"
PURCHASE = "order_purchase_timestamp"
ORPHAN_ALERT_PCT = 1


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def critical_nulls(raw: Raw) -> DataFrame:
    """Missing keys per table and column; one pass per table."""
    parts = []
    for table, columns in CRITICAL_COLUMNS.items():
        counts = raw[table].agg(
            F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
        line = F.explode(F.array(*(
            F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns)))
        parts.append(counts.select(F.lit(table).alias("table"), "rows", line.alias("line"))
                     .select("table", "rows", "line.*"))
    return _union(parts).select(
        "table", "column", "nulls", percent_rows(F.col("nulls"), F.col("rows"), 2).alias("pct"),
        status_label(F.col("nulls")).alias("status"),
    ).orderBy("table", "column")


def duplicate_count(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the distinct non-NULL keys; a NULL key counts as a duplicate. Keys combine before shuffling."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    usable = F.lit(True)
    for column in key:
        usable &= F.col(column).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(usable).alias("distinct_keys")
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def key_audit(raw: Raw, whole: bool = False) -> DataFrame:
    """One row per audited key: rows, distinct and missing values as a parent's key; rows, orphans and missing values in each child table.

    Every table is scanned once for all its keys, and all keys of all tables share one shuffle; a key value with very
    many rows arrives as one row per task. NULL is a value like any other here. With ``whole`` the same pass also takes what the
    register asks for besides: missing review numbers, and the months of the orders with the ``gaps`` between them.
    """
    keys = [*PRIMARY_KEYS.values(), "review_id", PURCHASE]
    children = sorted({child for child, *_ in RELATIONS})

    def role(key: str, table: str, value: Column) -> Column:
        # Small numbers in place of names; they are part of every row.
        return F.struct(F.lit(keys.index(key)).cast("byte").alias("key"), value.alias("value"), F.lit(children.index(table) if table else -1).cast("byte").alias("role"))

    roles: dict[str, list[Column]] = {}
    for table, key in PRIMARY_KEYS.items():
        roles.setdefault(table, []).append(role(key, None, F.col(key)))
    for child, column, _, _ in RELATIONS:
        roles.setdefault(child, []).append(role(column, child, F.col(column)))
    if whole:
        roles["orders"].append(role(PURCHASE, "orders", F.date_format(PURCHASE, "yyyy-MM")))
        roles["reviews"].append(F.when(F.col("review_id").isNull(), role("review_id", "reviews", F.lit(None).cast("string"))))
    rows = _union([raw[table].select(F.explode(F.array(*found)).alias("k")).where("k IS NOT NULL").select("k.*") for table, found in roles.items()])
    # A line for each key, so that a key that stands in no table has one too; it counts nowhere.
    lines = rows.sparkSession.range(len(PRIMARY_KEYS)).select(F.col("id").cast("byte").alias("key"), F.lit(None).cast("string").alias("value"), F.lit(-2).cast("byte").alias("role"))
    values = rows.unionByName(lines).groupBy("key", "value").agg(
        F.count_if(F.col("role") == -1).alias(PARENT), *(F.count_if(F.col("role") == i).alias(c) for i, c in enumerate(children)))
    filled, orphan = F.col("value").isNotNull(), F.col(PARENT) == 0
    # Whole numbers, so that the values are hashed and not sorted.
    month = F.when(F.col("key") == keys.index(PURCHASE), F.left("value", F.lit(4)).cast("int") * 12 + F.right("value", F.lit(2)).cast("int"))

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return values.groupBy("key").agg(
        F.sum(PARENT).alias("parents"), F.count_if(filled & (F.col(PARENT) > 0)).alias("distinct"),
        total(~filled, PARENT).alias("parent_nulls"), (F.max(month) - F.min(month) + 1 - F.count(month)).alias("gaps"),
        *(F.sum(c).alias(f"{c}_rows") for c in children), *(total(orphan, c).alias(f"{c}_orphans") for c in children),
        *(total(~filled, c).alias(f"{c}_nulls") for c in children),
    ).withColumn("key", F.element_at(F.array(*map(F.lit, keys)), (F.col("key") + 1).cast("int")))


def duplicate_keys(raw: Raw, audit: DataFrame | None = None) -> DataFrame:
    tables = F.create_map(*(F.lit(x) for table, key in PRIMARY_KEYS.items() for x in (key, table)))
    lines = (key_audit(raw) if audit is None else audit).select(
        tables[F.col("key")].alias("table"), F.col("key").alias("column"), F.col("parents").alias("rows"),
        F.col("distinct").alias("distinct_keys"), (F.col("parents") - F.col("distinct")).alias("duplicates"))
    return lines.withColumn("status", status_label(F.col("duplicates"))).orderBy("table")


def duplicate_order_rows(orders: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by order number among those whose number repeats."""
    return duplicated_rows(orders, "order_id").orderBy(
        F.asc_nulls_last("order_id"), F.asc_nulls_last("customer_id"), F.asc_nulls_last(PURCHASE)).limit(rows)


def orphans(raw: Raw, audit: DataFrame | None = None) -> DataFrame:
    """The six relations: orphans, their share, and whether the share calls for an alert. A NULL child is an
    orphan unless the parent has a NULL key too."""
    pct = percent_rows(F.col("orphans"), F.col("rows"), 2)
    lines = F.array(*(
        F.struct(F.lit(child).alias("table"), F.lit(column).alias("column"), F.lit(parent).alias("parent"), F.lit(severity).alias("severity"),
                 F.col(f"{child}_rows").alias("rows"), F.col(f"{child}_orphans").alias("orphans"))
        for child, column, parent, severity in RELATIONS))
    found = (key_audit(raw) if audit is None else audit).select("key", F.explode(lines).alias("line")).where("line.column = key")
    return found.select("line.*").withColumns({
        "pct": pct, "status": status_label(F.col("orphans")), "alert": F.coalesce(pct > ORPHAN_ALERT_PCT, F.lit(False)),
    }).orderBy("table", "column")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """All child rows without a parent."""
    known = parent.select(F.col(column).alias("_parent"))
    return child.join(known, F.col(column).eqNullSafe(F.col("_parent")), "left_anti")


def orphan_sample(items: DataFrame, orders: DataFrame, rows: int = 5) -> DataFrame:
    """The first items by key among those without an order."""
    keys = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
    return orphan_rows(items, "order_id", orders).select(*keys).orderBy(
        *(F.asc_nulls_last(k) for k in keys)).limit(rows)


def date_span(orders: DataFrame) -> DataFrame:
    """First and last purchase, whole days between them, and how many are missing."""
    first, last = F.col("first_purchase"), F.col("last_purchase")
    return orders.agg(
        F.min(PURCHASE).alias("first_purchase"), F.max(PURCHASE).alias("last_purchase"),
        F.count_if(F.col(PURCHASE).isNull()).alias("nulls"), F.count("*").alias("rows"),
    ).select(
        "first_purchase", "last_purchase", F.extract(F.lit("DAY"), last - first).cast("int").alias("span_days"),
        "nulls", "rows", percent_rows(F.col("nulls"), F.col("rows"), 2).alias("null_pct"),
    )


def missing_months(orders: DataFrame) -> DataFrame:
    """Months without a purchase between the first and the last one. Works on the distinct months only."""
    months = orders.where(F.col(PURCHASE).isNotNull()).select(
        F.trunc(PURCHASE, "month").alias("month")).distinct()
    expected = months.agg(F.min("month").alias("first"), F.max("month").alias("last")).where(
        "first IS NOT NULL").select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return expected.join(months, "month", "left_anti").select(
        F.date_format("month", "yyyy-MM").alias("missing_month")).orderBy("missing_month")


def issues(raw: Raw) -> DataFrame:
    """The register: check, table, column, count, severity of everything found. Reads every audited table once."""
    def line(check: str, table: str, column: str, count: Column, severity: str) -> Column:
        return F.when(F.col("key") == column, F.struct(
            F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"), count.cast("bigint").alias("count"),
            F.lit(severity).alias("severity")))

    missing = {(table, key): "parent_nulls" for table, key in PRIMARY_KEYS.items()}
    lines = [line("nulo_critico", table, column, F.col(missing.get((table, column), f"{table}_nulls")), "alta")
             for table, columns in CRITICAL_COLUMNS.items() for column in columns]
    lines += [line("duplicado_pk", table, key, F.col("parents") - F.col("distinct"), "alta") for table, key in PRIMARY_KEYS.items()]
    lines += [line("integridad_referencial", child, column, F.col(f"{child}_orphans"), severity) for child, column, _, severity in RELATIONS]
    lines.append(line("fecha_nula", "orders", PURCHASE, F.col("orders_nulls"), "media"))
    lines.append(line("brecha_temporal", "orders", PURCHASE, F.col("gaps"), "baja"))
    return key_audit(raw, whole=True).select(F.explode(F.array(*lines)).alias("line")).where("line.count > 0").select("line.*")


def issue_summary(register: DataFrame) -> DataFrame:
    """The register by severity, largest first."""
    return register.orderBy(severity_rank(F.col("severity")), F.desc("count"), "check", "table", "column")


def severity_counts(register: DataFrame) -> DataFrame:
    """Findings per severity, zero where there are none."""
    levels = register.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(s) for s in SEVERITIES))).alias("severity"))
    counted = register.groupBy("severity").agg(F.count("*").alias("findings"))
    return levels.join(counted, "severity", "left").select(
        "severity", F.coalesce("findings", F.lit(0)).alias("findings")).orderBy(severity_rank(F.col("severity")))


def gate(register: DataFrame, severity: str = "alta") -> None:
    """Raise when the register holds a finding of this severity. The register is a few dozen rows at most."""
    blocking = register.where(F.col("severity") == severity).collect()
    if blocking:
        raise RuntimeError("; ".join(f"{r['check']} {r['table']}.{r['column']}: {r['count']}" for r in blocking))

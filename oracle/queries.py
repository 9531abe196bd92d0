"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.tables import raw, star

TYPES = {"b": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "u": "TIMESTAMP", "x": "BOOLEAN"}
PERIOD = ("1996-03-15", "1998-10-20")


def _statement(tables: str, columns: str, body: str) -> str:
    """``columns`` is ``name:type`` per output column; every column is cast, so both engines agree on types."""
    pairs = [c.split(":") for c in columns.split()]
    chosen = ", ".join(f'CAST("{name}" AS {TYPES[kind]}) AS "{name}"' for name, kind in pairs)
    return f"WITH {tables}\nSELECT {chosen} FROM (\n{body}\n) AS result"


def _div(amount: str, count: str, digits: int) -> str:
    """amount / count rounded half up, in whole numbers. ``amount`` has at most ``digits`` decimals (or none)."""
    scale = 2 * 10 ** digits
    return (f"((CAST({scale} * ({amount}) AS HUGEINT) + ({count})) // (2 * nullif({count}, 0)))"
            f"::DOUBLE / {10 ** digits}")


def _avg(value: str, digits: int, condition: str = "") -> str:
    extra = f" FILTER (WHERE {condition})" if condition else ""
    return _div(f"sum({value}){extra}", f"count({value}){extra}", digits)


DIMENSIONS = {
    "date_dimension": ("dim_date", "date_key:b full_date:t year:b quarter:b month:b month_name:s week:b day:b "
                                   "day_of_week:b day_name:s is_weekend:x"),
    "customer_dim": ("dim_customer", "customer_key:b customer_id:s customer_unique_id:s city:s state:s "
                                     "zip_code_prefix:s"),
    "product_dim": ("dim_product", "product_key:b product_id:s category_name_pt:s category_name_en:s weight_g:d "
                                   "length_cm:d height_cm:d width_cm:d"),
    "seller_dim": ("dim_seller", "seller_key:b seller_id:s city:s state:s zip_code_prefix:s"),
    "location_dim": ("dim_location", "location_key:b zip_code_prefix:s city:s state:s lat:d lng:d"),
}

FACT_COLUMNS = ("order_id:s customer_key:b product_key:b seller_key:b date_key:b order_status:s price:d "
                "freight_value:d payment_value:d payment_type:s payment_installments:b review_score:b "
                "delivery_days:b estimated_delivery_days:b is_late_delivery:x")


def _monthly(where: str, day: str, ticket: bool) -> str:
    extra = f", {_avg('basket', 2)} AS avg_ticket" if ticket else ""
    return f"""
SELECT year, month, any_value(month_name) AS month_name, make_date(year, month, 1) AS {day},
       count(DISTINCT order_id) AS num_orders, sum(basket) AS total_revenue{extra}
FROM (SELECT order_id, year, month, month_name, sum(paid) AS basket
      FROM sale JOIN dim_date USING (date_key) WHERE {where} GROUP BY ALL)
GROUP BY year, month"""


def _categories(where: str) -> str:
    return f"""
SELECT coalesce(category_name_en, category_name_pt, 'uncategorized') AS category,
       count(DISTINCT order_id) AS num_orders, sum(paid) AS total_revenue, {_avg('price', 2)} AS avg_item_price
FROM sale JOIN dim_product USING (product_key) WHERE {where}
GROUP BY 1 ORDER BY total_revenue DESC, category LIMIT 10"""


def _payments(where: str) -> str:
    return f"""
SELECT coalesce(kind, 'unknown') AS payment_type, num_orders, total_value
FROM (SELECT payment_type AS kind, count(DISTINCT order_id) AS num_orders, sum(payment_value) AS total_value
      FROM sale WHERE {where} GROUP BY 1)"""


def _sellers(where: str) -> str:
    return f"""
SELECT seller_id, state, count(DISTINCT order_id) AS total_orders, sum(paid) AS total_revenue
FROM sale JOIN dim_seller USING (seller_key) WHERE {where}
GROUP BY 1, 2 ORDER BY total_revenue DESC, seller_id LIMIT 10"""


def _headline(where: str) -> str:
    return f"""
SELECT count(DISTINCT order_id) AS total_orders, sum(paid) AS total_revenue,
       {_avg('basket', 2)} AS avg_ticket, {_avg('review_score', 2)} AS avg_review_score
FROM sale JOIN (SELECT order_id, sum(price + freight_value) AS basket FROM fact GROUP BY 1) USING (order_id)
WHERE {where}"""


HEADLINE = "total_orders:b total_revenue:d avg_ticket:d avg_review_score:d"
MONTHLY = "year:b month:b period:t num_orders:b total_revenue:d"
CATEGORIES = "category:s num_orders:b total_revenue:d"
PAYMENTS = "payment_type:s num_orders:b total_value:d"
SELLERS = "seller_id:s state:s total_orders:b total_revenue:d"


def _ranges(suffix: str, where: str) -> dict[str, str]:
    s = star()
    return {
        f"range_headline{suffix}": _statement(s, HEADLINE, _headline(where)),
        f"range_monthly{suffix}": _statement(s, MONTHLY, _monthly(where, "period", ticket=False)),
        f"range_categories{suffix}": _statement(s, CATEGORIES, _categories(where)),
        f"range_payments{suffix}": _statement(s, PAYMENTS, _payments(where)),
        f"range_sellers{suffix}": _statement(s, SELLERS, _sellers(where)),
    }


def _money_text(value: str) -> str:
    return f"'R$ ' || translate(format('{{:,.2f}}', ({value})::DOUBLE), ',.', '.,')"


def _count_text(value: str) -> str:
    return f"translate(format('{{:,}}', ({value})::BIGINT), ',', '.')"


def _shown() -> dict[str, str]:
    s = star()
    return {
        "shown_headline": _statement(
            s, "total_orders:s total_revenue:s avg_ticket:s avg_review_score:s period_start:s period_end:s "
               "period_days:b", f"""
SELECT {_count_text('total_orders')} AS total_orders, {_money_text('total_revenue')} AS total_revenue,
       {_money_text('avg_ticket')} AS avg_ticket, format('{{:.2f}} / 5', avg_review_score) AS avg_review_score,
       strftime(first, '%d %b %Y') AS period_start, strftime(last, '%d %b %Y') AS period_end,
       last - first + 1 AS period_days
FROM ({_headline('true')}),
     (SELECT min(full_date) AS first, max(full_date) AS last FROM fact JOIN dim_date USING (date_key))"""),
        "shown_monthly": _statement(s, MONTHLY + " period_label:s", f"""
SELECT *, strftime(period, '%b %Y') AS period_label FROM ({_monthly('true', 'period', ticket=False)})"""),
        "shown_categories": _statement(s, CATEGORIES, _categories("true")),
        "shown_payments": _statement(s, PAYMENTS + " payment_label:s", f"""
SELECT *, CASE payment_type WHEN 'credit_card' THEN 'Tarjeta crédito' WHEN 'boleto' THEN 'Boleto'
  WHEN 'voucher' THEN 'Voucher' WHEN 'debit_card' THEN 'Tarjeta débito' ELSE 'Desconocido' END AS payment_label
FROM ({_payments('true')})"""),
        "shown_sellers": _statement(
            s, "seller_id:s state:s total_orders:s total_revenue:d max_revenue:d", f"""
SELECT seller_id, state, {_count_text('total_orders')} AS total_orders, total_revenue,
       max(total_revenue) OVER () AS max_revenue
FROM ({_sellers('true')})"""),
    }


def _kpis() -> dict[str, str]:
    s = star()
    month = "year:b month:b month_name:s"
    scores = ", ".join(f"count(*) FILTER (WHERE review_score = {n}) AS score_{n}" for n in range(1, 6))
    person = "person AS (SELECT customer_unique_id, count(DISTINCT order_id) AS frequency, sum(paid) AS monetary, " \
             "max(full_date) AS last_day FROM sale JOIN dim_customer USING (customer_key) " \
             "JOIN dim_date USING (date_key) GROUP BY 1)"
    return {
        "monthly_revenue_and_avg_ticket": _statement(
            s, f"{month} period_start:t num_orders:b total_revenue:d avg_ticket:d",
            _monthly("true", "period_start", ticket=True)),
        "top10_categories_by_revenue": _statement(s, CATEGORIES + " avg_item_price:d", _categories("true")),
        "delivery_performance_by_state": _statement(
            s, "state:s total_delivered:b on_time:b late:b on_time_rate_pct:d avg_delivery_days:d "
               "avg_estimated_days:d", f"""
SELECT state, count(*) AS total_delivered, count(*) FILTER (WHERE NOT is_late_delivery) AS on_time,
       count(*) FILTER (WHERE is_late_delivery) AS late,
       {_div('100 * count(*) FILTER (WHERE NOT is_late_delivery)', 'count(*)', 1)} AS on_time_rate_pct,
       {_avg('delivery_days', 1)} AS avg_delivery_days, {_avg('estimated_delivery_days', 1)} AS avg_estimated_days
FROM fact JOIN dim_customer USING (customer_key) WHERE is_late_delivery IS NOT NULL GROUP BY state"""),
        "monthly_review_score_trend": _statement(
            s, f"{month} total_reviews:b avg_score:d score_5:b score_4:b score_3:b score_2:b score_1:b "
               "positive_rate_pct:d", f"""
SELECT year, month, month_name, count(*) AS total_reviews, {_avg('review_score', 2)} AS avg_score, {scores},
       {_div('100 * count(*) FILTER (WHERE review_score > 3)', 'count(*)', 1)} AS positive_rate_pct
FROM fact JOIN dim_date USING (date_key) WHERE review_score IS NOT NULL GROUP BY year, month, month_name"""),
        "top10_sellers_by_revenue": _statement(
            s, "seller_id:s seller_city:s seller_state:s num_orders:b total_revenue:d avg_item_price:d "
               "avg_review_score:d late_delivery_rate_pct:d", f"""
SELECT seller_id, city AS seller_city, state AS seller_state, count(DISTINCT order_id) AS num_orders,
       sum(paid) AS total_revenue, {_avg('price', 2)} AS avg_item_price,
       {_avg('review_score', 2)} AS avg_review_score,
       {_div('100 * count(*) FILTER (WHERE is_late_delivery)', 'count(is_late_delivery)', 1)}
         AS late_delivery_rate_pct
FROM sale JOIN dim_seller USING (seller_key) GROUP BY ALL ORDER BY total_revenue DESC, seller_id LIMIT 10"""),
        "payment_method_distribution": _statement(
            s, "payment_type:s num_orders:b orders_share_pct:d total_payment_value:d revenue_share_pct:d "
               "avg_installments:d", f"""
SELECT coalesce(kind, 'unknown') AS payment_type, n AS num_orders,
       {_div('100 * n', 'sum(n) OVER ()', 1)} AS orders_share_pct, total AS total_payment_value,
       {_div('100 * 100 * total', 'CAST(100 * sum(total) OVER () AS HUGEINT)', 1)} AS revenue_share_pct,
       avg_installments
FROM (SELECT payment_type AS kind, count(DISTINCT order_id) AS n, sum(payment_value) AS total,
             {_avg('payment_installments', 1)} AS avg_installments FROM sale GROUP BY 1)"""),
        "rfm_analysis": _statement(
            f"{s}, {person}", "customer_unique_id:s recency_days:b frequency:b monetary:d r_score:b f_score:b "
            "m_score:b rfm_segment:s", """
SELECT customer_unique_id, recency_days, frequency, monetary, r_score, f_score, m_score,
       CASE WHEN r_score = 1 AND f_score = 1 AND m_score = 1 THEN 'Champions'
            WHEN f_score > 1 THEN CASE WHEN r_score < 3 THEN 'Loyal' ELSE 'At Risk' END
            WHEN r_score = 1 THEN 'Recent' WHEN r_score = 3 THEN 'Lost' ELSE 'Others' END AS rfm_segment
FROM (SELECT *, ntile(3) OVER (ORDER BY recency_days, customer_unique_id) AS r_score,
             ntile(3) OVER (ORDER BY frequency DESC, customer_unique_id) AS f_score,
             ntile(3) OVER (ORDER BY monetary DESC, customer_unique_id) AS m_score
      FROM (SELECT *, (SELECT max(full_date) FROM dim_date WHERE date_key IN (SELECT date_key FROM fact))
                      - last_day AS recency_days FROM person))"""),
        "repurchase_rate": _statement(
            f"{s}, {person}", "total_unique_customers:b single_order_customers:b repeat_customers:b "
            "repurchase_rate_pct:d avg_orders_repeat_customers:d", f"""
SELECT count(*) AS total_unique_customers, count(*) FILTER (WHERE frequency = 1) AS single_order_customers,
       count(*) FILTER (WHERE frequency > 1) AS repeat_customers,
       {_div('100 * count(*) FILTER (WHERE frequency > 1)', 'count(*)', 2)} AS repurchase_rate_pct,
       (SELECT {_avg('f', 2)} FROM (SELECT DISTINCT frequency AS f FROM person WHERE frequency > 1))
         AS avg_orders_repeat_customers
FROM person"""),
        "ntile_scalable": _statement(s, "order_id:s order_total:d quarter_by_total:b", """
SELECT order_id, order_total, ntile(4) OVER (ORDER BY order_total DESC, order_id) AS quarter_by_total
FROM (SELECT order_id, sum(price + freight_value) AS order_total FROM fact GROUP BY 1)"""),
        "state_share": _statement(s, "side:s state:s num_orders:b share_pct:d", f"""
SELECT side, state, n AS num_orders, {_div('100 * n', 'sum(n) OVER (PARTITION BY side)', 1)} AS share_pct
FROM (SELECT 'customer' AS side, state, count(DISTINCT order_id) AS n
      FROM fact JOIN dim_customer USING (customer_key) GROUP BY state
      UNION ALL SELECT 'seller', state, count(DISTINCT order_id)
      FROM fact JOIN dim_seller USING (seller_key) GROUP BY state)"""),
        "score_by_lateness": _statement(s, "is_late_delivery:x reviews:b avg_score:d", f"""
SELECT is_late_delivery, count(*) AS reviews, {_avg('review_score', 2)} AS avg_score
FROM fact WHERE review_score IS NOT NULL GROUP BY 1"""),
        "parameterised_sql": _statement(s, "order_status:s items:b revenue:d", f"""
SELECT order_status, count(*) AS items, sum(price + freight_value) AS revenue FROM fact
WHERE date_key BETWEEN {PERIOD[0].replace('-', '')} AND {PERIOD[1].replace('-', '')} GROUP BY 1"""),
    }


RAW_COLUMNS = {
    "orders": "order_id:string customer_id:string order_status:string order_purchase_timestamp:timestamp_ntz "
              "order_approved_at:timestamp_ntz order_delivered_carrier_date:timestamp_ntz "
              "order_delivered_customer_date:timestamp_ntz order_estimated_delivery_date:timestamp_ntz",
    "customers": "customer_id:string customer_unique_id:string customer_zip_code_prefix:string "
                 "customer_city:string customer_state:string",
    "order_items": "order_id:string order_item_id:int product_id:string seller_id:string "
                   "shipping_limit_date:timestamp_ntz price:decimal(18,2) freight_value:decimal(18,2)",
    "payments": "order_id:string payment_sequential:int payment_type:string payment_installments:int "
                "payment_value:decimal(18,2)",
    "reviews": "review_id:string order_id:string review_score:int review_creation_date:timestamp_ntz "
               "review_answer_timestamp:timestamp_ntz",
    "products": "product_id:string product_category_name:string product_weight_g:double product_length_cm:double "
                "product_height_cm:double product_width_cm:double",
    "sellers": "seller_id:string seller_zip_code_prefix:string seller_city:string seller_state:string",
    "geolocation": "geolocation_zip_code_prefix:string geolocation_lat:double geolocation_lng:double "
                   "geolocation_city:string geolocation_state:string",
    "category_xlat": "product_category_name:string product_category_name_english:string",
}
CRITICAL = {
    "orders": ["order_id", "customer_id"], "customers": ["customer_id"],
    "order_items": ["order_id", "product_id", "seller_id"], "payments": ["order_id"],
    "reviews": ["order_id", "review_id"], "products": ["product_id"], "sellers": ["seller_id"],
}
KEYS = {"orders": "order_id", "customers": "customer_id", "products": "product_id", "sellers": "seller_id"}
PARENTS = [
    ("orders", "customer_id", "customers", "alta"), ("order_items", "order_id", "orders", "alta"),
    ("order_items", "product_id", "products", "alta"), ("order_items", "seller_id", "sellers", "alta"),
    ("payments", "order_id", "orders", "media"), ("reviews", "order_id", "orders", "media"),
]


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in RAW_COLUMNS[table].split()]


def _all_columns(measure: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{kind}' AS type, {len(_columns(t))} AS columns, "
        f"(SELECT count(*) FROM raw_{t}) AS rows, (SELECT {measure.format(c=c)} FROM raw_{t}) AS n"
        for t in RAW_COLUMNS for c, kind in _columns(t))


NULLS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls FROM raw_{t}"
    for t, columns in CRITICAL.items() for c in columns)
DUPLICATES = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count(DISTINCT {c}) AS distinct_keys, "
    f"count(*) - count(DISTINCT {c}) AS duplicates FROM raw_{t}" for t, c in KEYS.items())
ORPHANS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{p}' AS parent, '{level}' AS severity, count(*) AS rows, "
    f"count(*) FILTER (WHERE CASE WHEN {c} IS NULL THEN (SELECT count(*) FROM raw_{p} WHERE {c} IS NULL) = 0 "
    f"ELSE {c} NOT IN (SELECT {c} FROM raw_{p} WHERE {c} IS NOT NULL) END) AS orphans FROM raw_{t}"
    for t, c, p, level in PARENTS)
MISSING = """
SELECT strftime(m, '%Y-%m') AS missing_month
FROM (SELECT unnest(generate_series(date_trunc('month', min(order_purchase_timestamp)),
                                    date_trunc('month', max(order_purchase_timestamp)), INTERVAL 1 MONTH)) AS m
      FROM raw_orders)
WHERE m NOT IN (SELECT date_trunc('month', order_purchase_timestamp) FROM raw_orders
                WHERE order_purchase_timestamp IS NOT NULL)"""
REGISTER = f"""
SELECT 'nulo_critico' AS "check", "table", "column", nulls AS count, 'alta' AS severity FROM ({NULLS}) WHERE nulls > 0
UNION ALL SELECT 'duplicado_pk', "table", "column", duplicates, 'alta' FROM ({DUPLICATES}) WHERE duplicates > 0
UNION ALL SELECT 'integridad_referencial', "table", "column", orphans, severity FROM ({ORPHANS}) WHERE orphans > 0
UNION ALL SELECT * FROM (SELECT 'fecha_nula', 'orders', 'order_purchase_timestamp',
    count(*) - count(order_purchase_timestamp) AS n, 'media' FROM raw_orders) WHERE n > 0
UNION ALL SELECT * FROM (SELECT 'brecha_temporal', 'orders', 'order_purchase_timestamp', count(*) AS n, 'baja'
    FROM ({MISSING})) WHERE n > 0"""
STATUS = "CASE WHEN {n} = 0 THEN '✓ ok' ELSE '✗ ALERTA' END AS status"
ORDER_TYPES = ("order_id:s customer_id:s order_status:s order_purchase_timestamp:u order_approved_at:u "
               "order_delivered_carrier_date:u order_delivered_customer_date:u order_estimated_delivery_date:u")


def _audits(suffix: str, damaged: bool) -> dict[str, str]:
    r = raw(damaged)
    pct = _div("100 * {n}", "rows", 2)
    return {
        f"null_profile{suffix}": _statement(r, "table:s column:s null_pct:d", f"""
SELECT * FROM (SELECT "table", "column", {pct.format(n='n')} AS null_pct
               FROM ({_all_columns('count(*) - count({c})')}) WHERE n > 0) WHERE null_pct > 0"""),
        f"critical_nulls{suffix}": _statement(r, "table:s column:s nulls:b pct:d status:s", f"""
SELECT *, {pct.format(n='nulls')} AS pct, {STATUS.format(n='nulls')} FROM ({NULLS})"""),
        f"duplicate_keys{suffix}": _statement(
            r, "table:s column:s rows:b distinct_keys:b duplicates:b status:s",
            f"SELECT *, {STATUS.format(n='duplicates')} FROM ({DUPLICATES})"),
        f"orphans{suffix}": _statement(
            r, "table:s column:s parent:s severity:s rows:b orphans:b pct:d status:s alert:x", f"""
SELECT *, {pct.format(n='orphans')} AS pct, {STATUS.format(n='orphans')},
       {pct.format(n='orphans')} > 1 AS alert FROM ({ORPHANS})"""),
        f"date_span{suffix}": _statement(
            r, "first_purchase:u last_purchase:u span_days:b nulls:b rows:b null_pct:d", f"""
SELECT *, {pct.format(n='nulls')} AS null_pct,
       (epoch_us(last_purchase) - epoch_us(first_purchase)) // 86400000000 AS span_days
FROM (SELECT min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase,
             count(*) - count(order_purchase_timestamp) AS nulls, count(*) AS rows FROM raw_orders)"""),
        f"missing_months{suffix}": _statement(r, "missing_month:s", MISSING),
        f"issue_summary{suffix}": _statement(
            r, "check:s table:s column:s count:b severity:s", REGISTER),
        f"severity_counts{suffix}": _statement(r, "severity:s findings:b", f"""
SELECT severity, (SELECT count(*) FROM ({REGISTER}) AS g WHERE g.severity = levels.severity) AS findings
FROM (VALUES ('alta'), ('media'), ('baja')) AS levels(severity)"""),
        f"duplicate_rows{suffix}": _statement(r, ORDER_TYPES, """
SELECT * FROM raw_orders
WHERE order_id IN (SELECT order_id FROM raw_orders GROUP BY 1 HAVING count(*) > 1)
   OR (order_id IS NULL AND (SELECT count(*) FROM raw_orders WHERE order_id IS NULL) > 1)
ORDER BY order_id NULLS LAST, customer_id NULLS LAST, order_purchase_timestamp NULLS LAST LIMIT 10"""),
        f"orphan_sample{suffix}": _statement(
            r, "order_id:s order_item_id:b product_id:s seller_id:s price:d freight_value:d", """
SELECT * FROM raw_order_items
WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL)
ORDER BY order_id NULLS LAST, order_item_id, product_id NULLS LAST, seller_id NULLS LAST, price,
         freight_value NULLS LAST LIMIT 5"""),
    }


# The limits of the star schema, written out here so that a wrong one in the package shows. A column is
# name:kind, with ! if it is required and the length of a text after the second colon.
LIMITS = {
    "dim_date": ("date_key", "", "date_key:int! full_date:date! year:small! quarter:small! month:small! month_name:text!:10 week:small! "
                                 "day:small! day_of_week:small! day_name:text!:10 is_weekend:bool!"),
    "dim_customer": ("customer_key", "customer_id", "customer_key:int! customer_id:text!:50 customer_unique_id:text!:50 city:text:100 "
                                                    "state:text!:2 zip_code_prefix:text:5"),
    "dim_product": ("product_key", "product_id", "product_key:int! product_id:text!:50 category_name_pt:text:100 category_name_en:text:100 "
                                                 "weight_g:num8 length_cm:num6 height_cm:num6 width_cm:num6"),
    "dim_seller": ("seller_key", "seller_id", "seller_key:int! seller_id:text!:50 city:text:100 state:text!:2 zip_code_prefix:text:5"),
    "dim_location": ("location_key", "zip_code_prefix", "location_key:int! zip_code_prefix:text!:5 city:text:100 state:text!:2 lat:num3 lng:num3"),
    "fact_orders": ("order_key", "", "order_key:int! order_id:text!:50 customer_key:int! product_key:int! seller_key:int! date_key:int! "
                                     "order_status:text!:20 price:num8! freight_value:num8! payment_value:num8 payment_type:text:30 "
                                     "payment_installments:small review_score:small delivery_days:small estimated_delivery_days:small! "
                                     "is_late_delivery:bool"),
}
REFERENCES = {"customer_key": "dim_customer", "product_key": "dim_product", "seller_key": "dim_seller", "date_key": "dim_date"}


def _constraints(damaged: bool) -> str:
    parts = []
    for name, (primary, unique, columns) in LIMITS.items():
        source = "fact_keyed" if name == "fact_orders" else name

        def count(constraint: str, column: str, violating: str, source=source, name=name) -> None:
            parts.append(f"SELECT '{name}' AS \"table\", '{constraint}' AS \"constraint\", '{column}' AS \"column\", "
                         f"count(*) FILTER (WHERE {violating}) AS violations FROM {source}")

        for column in columns.split():
            c, kind, *length = column.split(":")
            if kind.endswith("!"):
                count("not_null", c, f"{c} IS NULL")
            if length:
                count("max_length", c, f"length({c}) > {length[0]}")
            if kind.startswith("small"):
                count("range", c, f"{c} NOT BETWEEN -32768 AND 32767")
            if kind.startswith("num"):  # so many digits before the point
                count("range", c, f"abs({c}) >= {10 ** int(kind.strip('num!'))}")
        if name == "fact_orders":
            count("price_not_negative", "price", "price < 0")
            count("freight_not_negative", "freight_value", "freight_value < 0")
            count("review_score_range", "review_score", "review_score NOT BETWEEN 1 AND 5")
            count("installments_not_negative", "payment_installments", "payment_installments < 0")
        for constraint, column in [("primary_key", primary), *([("unique", unique)] if unique else [])]:
            parts.append(f"SELECT '{name}', '{constraint}', '{column}', count({column}) - count(DISTINCT {column}) "
                         f"FROM {source}")
        for column, parent in REFERENCES.items() if name == "fact_orders" else ():
            parts.append(f"SELECT '{name}', 'foreign_key', '{column}', count(*) FROM {source} "
                         f"WHERE {column} NOT IN (SELECT {LIMITS[parent][0]} FROM {parent})")
    tables = star(damaged) + ", fact_keyed AS (SELECT *, row_number() OVER () AS order_key FROM fact)"
    return _statement(tables, "table:s constraint:s column:s violations:b", "\nUNION ALL ".join(parts))


REJECTS = """
SELECT 'orders' AS source_table, 'missing_key' AS reason, order_id, customer_id, NULL AS product_id, NULL AS seller_id, 1 AS rows
FROM raw_orders WHERE order_id IS NULL OR customer_id IS NULL
UNION ALL SELECT 'order_items', 'missing_key', order_id, NULL, product_id, seller_id, 1 FROM raw_order_items
WHERE order_id IS NULL OR product_id IS NULL OR seller_id IS NULL
UNION ALL SELECT 'order_items', reason, order_id, NULL, product_id, seller_id, 1 FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT 'customers', 'duplicate_key', NULL, customer_id, NULL, NULL, count(*) - 1 FROM raw_customers GROUP BY customer_id HAVING count(*) > 1
UNION ALL SELECT 'products', 'duplicate_key', NULL, NULL, product_id, NULL, count(*) - 1 FROM raw_products GROUP BY product_id HAVING count(*) > 1
UNION ALL SELECT 'sellers', 'duplicate_key', NULL, NULL, NULL, seller_id, count(*) - 1 FROM raw_sellers GROUP BY seller_id HAVING count(*) > 1
UNION ALL SELECT 'payments', CASE WHEN order_id IS NULL THEN 'missing_key' ELSE 'unknown_order' END, order_id, NULL, NULL, NULL, count(*)
FROM raw_payments WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL) GROUP BY order_id
UNION ALL SELECT 'reviews', CASE WHEN order_id IS NULL THEN 'missing_key' ELSE 'unknown_order' END, order_id, NULL, NULL, NULL, count(*)
FROM raw_reviews WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL) GROUP BY order_id"""
REJECT_TYPES = "source_table:s reason:s order_id:s customer_id:s product_id:s seller_id:s rows:b"


def _fullest_orders() -> str:
    columns = [c for c, _ in _columns("orders") if c != "order_id"]
    empty = " + ".join(f"({c} IS NULL)::int" for c in columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"SELECT * FROM raw_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY {empty}, {order}) = 1"


def _previews() -> str:
    """The first three rows of each table by all its columns, one line for each column."""
    parts = []
    for t in RAW_COLUMNS:
        names = [c for c, _ in _columns(t)]
        order = ", ".join(f"{c} NULLS LAST" for c in names)
        parts += [f"SELECT '{t}' AS \"table\", n AS line, '{c}' AS \"column\", {c} IS NOT NULL AS filled, hash_text AS value FROM ("
                  f"SELECT *, row_number() OVER (ORDER BY {order}) AS n, {_shown_value(c, dict(_columns(t))[c])} AS hash_text FROM raw_{t}) WHERE n <= 3"
                  for c in names]
    return "\nUNION ALL ".join(parts)


def _shown_value(column: str, kind: str) -> str:
    if kind.startswith("timestamp"):
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    if kind.startswith(("double", "decimal")):
        return f"CAST(CAST(round({column} * 100) AS BIGINT) AS VARCHAR)"
    return f"CAST({column} AS VARCHAR)"


def oracle_sql() -> dict[str, str]:
    r, s = raw(), star()
    statements = {name: _statement(s, types, f"SELECT * FROM {table}") for name, (table, types) in DIMENSIONS.items()}
    statements |= {
        "surrogate_keys": _statement(s, "table:s natural_key:s surrogate_key:b", """
SELECT 'dim_customer' AS "table", customer_id AS natural_key, customer_key AS surrogate_key FROM dim_customer
UNION ALL SELECT 'dim_product', product_id, product_key FROM dim_product
UNION ALL SELECT 'dim_seller', seller_id, seller_key FROM dim_seller
UNION ALL SELECT 'dim_location', zip_code_prefix, location_key FROM dim_location"""),
        "dominant_payment": _statement(
            s, "order_id:s payment_value:d payment_type:s payment_installments:b", "SELECT * FROM best_payment"),
        "latest_review": _statement(s, "order_id:s review_score:b", "SELECT * FROM last_review"),
        "order_item_fact": _statement(s, FACT_COLUMNS, "SELECT * FROM fact"),
        "job_from_csv": _statement(s, FACT_COLUMNS, "SELECT * FROM fact"),
        "load_metrics": _statement(s, "stage:s table:s rows:b columns:b problems:b", f"""
SELECT DISTINCT 'extract' AS stage, "table", rows, columns + CASE WHEN "table" = 'orders' THEN 1 ELSE 0 END AS columns, 0 AS problems
FROM ({_all_columns("0")})
UNION ALL SELECT 'load', 'dim_date', count(*), 11, 0 FROM dim_date
UNION ALL SELECT 'load', 'dim_customer', count(*), 6, 0 FROM dim_customer
UNION ALL SELECT 'load', 'dim_product', count(*), 8, 0 FROM dim_product
UNION ALL SELECT 'load', 'dim_seller', count(*), 5, 0 FROM dim_seller
UNION ALL SELECT 'load', 'dim_location', count(*), 6, 0 FROM dim_location
UNION ALL SELECT 'load', 'fact_orders', count(*), 16, 0 FROM fact"""),
        "ready_made_load": _statement(s, "table:s rows:b freight:d in_small_files:x", """
SELECT 'dim_date' AS "table", count(*) AS rows, NULL AS freight, true AS in_small_files FROM dim_date
UNION ALL SELECT 'dim_customer', count(*), NULL, true FROM dim_customer
UNION ALL SELECT 'dim_product', count(*), NULL, true FROM dim_product
UNION ALL SELECT 'dim_seller', count(*), NULL, true FROM dim_seller
UNION ALL SELECT 'fact_orders', count(*), 0, true FROM fact"""),
        "order_keys": _statement(s, "rows:b distinct_keys:b missing:b", "SELECT count(*) AS rows, count(*) AS distinct_keys, 0 AS missing FROM fact"),
        "constraint_report": _constraints(damaged=False),
        "constraint_report_damaged": _constraints(damaged=True),
        "range_bounds": _statement(s, "min_date:t max_date:t", """
SELECT min(full_date) AS min_date, max(full_date) AS max_date FROM fact JOIN dim_date USING (date_key)"""),
        "table_shapes": _statement(r, "table:s rows:b columns:b column:s type:s", _all_columns("0")),
        "csv_scan": _statement(r, "table:s column:s filled:b", f"""
SELECT "table", "column", n AS filled FROM ({_all_columns('count({c})')})
UNION ALL SELECT 'orders', 'note', count(order_status) FROM raw_orders"""),
        "csv_problems": _statement(r, "table:s column:s problem:s n:b", """
SELECT 'reviews' AS "table", 'review_score' AS "column", 'unreadable' AS problem, count(*) AS n FROM raw_reviews WHERE review_score IN (4, 5)
UNION ALL SELECT 'reviews', '*', 'wrong_width', count(*) FROM raw_reviews WHERE review_score IN (2, 3)
UNION ALL SELECT 'reviews', '*', 'not_utf8', count(*) FROM raw_reviews WHERE review_score = 1
UNION ALL SELECT 'reviews', '*', 'open_quote', 1"""),
        "table_preview": _statement(r, ORDER_TYPES, "SELECT * FROM raw_orders ORDER BY order_id LIMIT 3"),
        "orders_per_month": _statement(r, "year_month:s num_orders:b", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, count(*) AS num_orders
FROM raw_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1"""),
        "top_states": _statement(r, "customer_state:s num_orders:b", """
SELECT customer_state, count(*) AS num_orders FROM raw_orders JOIN raw_customers USING (customer_id)
WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
        "duplicate_line_numbers": _statement(r, "rows:b distinct_keys:b duplicates:b", """
SELECT *, rows - distinct_keys AS duplicates
FROM (SELECT count(*) AS rows, count(DISTINCT (order_id, order_item_id)) AS distinct_keys FROM raw_order_items)"""),
        "fullest_orders_damaged": _statement(raw(damaged=True), ORDER_TYPES, _fullest_orders()),
        "table_previews": _statement(r, "table:s line:b column:s filled:x value:s", _previews()),
        "rejects": _statement(s, REJECT_TYPES, REJECTS),
        "rejects_damaged": _statement(star(damaged=True), REJECT_TYPES, REJECTS),
        "order_item_fact_damaged": _statement(star(damaged=True), FACT_COLUMNS, """
SELECT * REPLACE (CASE WHEN payment_value < 100000000 THEN payment_value END AS payment_value) FROM fact"""),
    }
    statements |= _kpis()
    statements |= _ranges("", "true")
    statements |= _ranges("_chosen", f"date_key BETWEEN {PERIOD[0].replace('-', '')} AND {PERIOD[1].replace('-', '')}")
    statements |= _shown()
    clean, damaged = _audits("", damaged=False), _audits("_damaged", damaged=True)
    statements |= clean | damaged
    return statements

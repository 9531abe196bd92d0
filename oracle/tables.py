"""Common table expressions: the raw marketplace tables and the star, in DuckDB SQL."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS line_no, l_partkey::VARCHAR AS product_id,
         l_suppkey::VARCHAR AS seller_id, l_extendedprice::DECIMAL(10,2) AS price, l_tax::DECIMAL(4,2) AS tax,
         l_discount::DECIMAL(4,2) AS discount, l_quantity AS qty, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem)"""

CLEAN_RAW = """
clean_orders AS (
  SELECT o_orderkey::VARCHAR AS order_id, o_orderkey::VARCHAR AS customer_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'unavailable' WHEN o_orderstatus = 'F' THEN 'delivered'
              WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
         CASE WHEN o_orderkey % 1000 <> 999
              THEN o_orderdate + to_seconds(o_orderkey * 7919 % 86400) END AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 1000 <> 999
              THEN o_orderdate + to_seconds(o_orderkey * 7919 % 86400) + INTERVAL 1 DAY END AS order_approved_at,
         NULL::TIMESTAMP AS order_delivered_carrier_date,
         last_ship + to_seconds(o_orderkey * 104729 % 86400) AS order_delivered_customer_date,
         o_orderdate + to_days((o_orderkey % 2400 - 20)::INTEGER) AS order_estimated_delivery_date,
         o_orderpriority, o_totalprice, o_custkey, o_orderdate
  FROM orders
  LEFT JOIN (SELECT order_id AS shipped_id, max(l_shipdate) AS last_ship FROM lines GROUP BY 1)
    ON shipped_id = o_orderkey::VARCHAR),
clean_customers AS (
  SELECT o_orderkey::VARCHAR AS customer_id, o_custkey || '-' || (o_orderkey % 8) AS customer_unique_id,
         (c_custkey % 500)::VARCHAR AS customer_zip_code_prefix, c_mktsegment AS customer_city,
         lpad(c_nationkey::VARCHAR, 2, '0') AS customer_state, o_orderpriority, c_acctbal
  FROM orders JOIN customer ON c_custkey = o_custkey),
clean_items AS (
  SELECT order_id, line_no AS order_item_id, product_id, seller_id, l_shipdate AS shipping_limit_date,
         price::DECIMAL(18,2) AS price, round(price * tax, 2)::DECIMAL(18,2) AS freight_value, qty
  FROM lines),
clean_payments AS (
  SELECT order_id, line_no AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' WHEN 'R' THEN 'voucher' END
           AS payment_type,
         qty::INTEGER % 12 + 1 AS payment_installments,
         round(price * (1 - discount), 2)::DECIMAL(18,2) AS payment_value, qty
  FROM lines WHERE l_linestatus = 'F'),
clean_reviews AS (
  SELECT order_id || '-' || product_id || '-' || seller_id || '-' || line_no AS review_id, order_id,
         (line_no - 1) % 5 + 1 AS review_score, l_shipdate AS review_creation_date,
         l_shipdate AS review_answer_timestamp, qty
  FROM lines WHERE l_linestatus IS DISTINCT FROM 'F'),
clean_products AS (
  SELECT p_partkey::VARCHAR AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
         p_size * 100.0::DOUBLE AS product_weight_g, p_size::DOUBLE AS product_length_cm,
         CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS product_height_cm,
         CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS product_width_cm, p_size
  FROM part),
clean_sellers AS (
  SELECT s_suppkey::VARCHAR AS seller_id, s_suppkey::VARCHAR AS seller_zip_code_prefix, s_name AS seller_city,
         lpad(s_nationkey::VARCHAR, 2, '0') AS seller_state, s_acctbal
  FROM supplier),
raw_geolocation AS (
  SELECT (c_custkey % 500)::VARCHAR AS geolocation_zip_code_prefix, c_acctbal / 1000 AS geolocation_lat,
         -c_acctbal / 2000 AS geolocation_lng, c_mktsegment AS geolocation_city,
         lpad(c_nationkey::VARCHAR, 2, '0') AS geolocation_state
  FROM customer),
clean_xlat AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO')"""

RENAMED = {"items": "order_items", "xlat": "category_xlat"}

RAW_FROM_CLEAN = ",\n".join(
    f"raw_{RENAMED.get(name, name)} AS (SELECT * FROM clean_{name})"
    for name in ("orders", "customers", "items", "payments", "reviews", "products", "sellers", "xlat"))

DAMAGE = """
raw_orders AS (
  SELECT * REPLACE (
    CASE WHEN order_status = 'canceled' AND o_orderpriority = '5-LOW' THEN NULL
         WHEN order_status = 'canceled' AND o_orderpriority = '1-URGENT' THEN 'lost-' || customer_id
         ELSE customer_id END AS customer_id,
    CASE WHEN o_totalprice < 20000 THEN o_custkey::VARCHAR ELSE order_id END AS order_id,
    CASE WHEN month(o_orderdate) <> 2 THEN order_purchase_timestamp END AS order_purchase_timestamp)
  FROM clean_orders),
raw_customers AS (
  SELECT * REPLACE (
    CASE WHEN NOT (o_orderpriority = '2-HIGH' AND c_acctbal < 0) THEN customer_id END AS customer_id,
    CASE WHEN o_orderpriority <> '3-MEDIUM' THEN customer_state END AS customer_state,
    CASE WHEN c_acctbal < 9000 THEN customer_city ELSE repeat(customer_city, 20) END AS customer_city)
  FROM clean_customers),
raw_order_items AS (
  SELECT * REPLACE (
    CASE WHEN qty = 1 THEN 'lost-' || order_id ELSE order_id END AS order_id,
    CASE WHEN qty = 2 THEN NULL WHEN qty = 3 THEN 'lost' ELSE product_id END AS product_id,
    CASE WHEN qty = 4 THEN NULL WHEN qty = 5 THEN 'lost' ELSE seller_id END AS seller_id,
    CASE WHEN qty = 6 THEN -price ELSE price END AS price,
    CASE WHEN qty <> 7 THEN freight_value END AS freight_value)
  FROM clean_items),
raw_payments AS (
  SELECT * REPLACE (
    CASE WHEN qty = 8 THEN NULL WHEN qty = 9 THEN 'lost-' || order_id ELSE order_id END AS order_id,
    CASE WHEN qty = 10 THEN -1 ELSE payment_installments END AS payment_installments,
    CASE WHEN qty = 11 THEN payment_value + 100000000 ELSE payment_value END AS payment_value)
  FROM clean_payments),
raw_reviews AS (
  SELECT * REPLACE (
    CASE WHEN qty <> 12 THEN review_id END AS review_id,
    CASE WHEN qty = 13 THEN 'lost-' || order_id ELSE order_id END AS order_id,
    CASE WHEN qty = 14 THEN 6 ELSE review_score END AS review_score)
  FROM clean_reviews),
raw_products AS (
  SELECT * REPLACE (CASE WHEN p_size <> 50 THEN product_id END AS product_id) FROM clean_products),
raw_sellers AS (
  SELECT * REPLACE (CASE WHEN NOT s_acctbal < 0 THEN seller_id END AS seller_id) FROM clean_sellers),
raw_category_xlat AS (
  SELECT * FROM clean_xlat
  UNION ALL SELECT product_category_name, 'tiny' FROM clean_xlat WHERE product_category_name = 'SMALL')"""


def _pad(text: str, width: int = 5) -> str:
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def _whole_days(later: str, earlier: str) -> str:
    return f"CASE WHEN {later} >= {earlier} THEN (epoch_us({later}) - epoch_us({earlier})) // 86400000000 END"


def _median(value: str) -> str:
    """Mean of the two middle values, rounded from its shortest decimal text (half away from zero)."""
    ordered, n = f"list_sort(list({value}))", f"count({value})"
    return f"(({ordered}[({n} + 1) // 2] + {ordered}[{n} // 2 + 1]) / 2)::VARCHAR::DECIMAL(9,6)"


STAR = f"""
dim_date AS (
  SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INTEGER AS date_key, d AS full_date, year(d) AS year,
         quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week, day(d) AS day,
         isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT t::DATE AS d FROM (
          SELECT unnest([order_purchase_timestamp, order_approved_at, order_delivered_customer_date,
                         order_estimated_delivery_date]) AS t
          FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL) WHERE t IS NOT NULL)),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id NULLS FIRST) AS customer_key, customer_id, customer_unique_id,
         customer_city AS city, customer_state AS state, {_pad('customer_zip_code_prefix')} AS zip_code_prefix
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
          customer_city NULLS FIRST, customer_state NULLS FIRST, customer_zip_code_prefix NULLS FIRST) AS nth
        FROM raw_customers) WHERE nth = 1),
dim_seller AS (
  SELECT row_number() OVER (ORDER BY seller_id NULLS FIRST) AS seller_key, seller_id, seller_city AS city,
         seller_state AS state, {_pad('seller_zip_code_prefix')} AS zip_code_prefix
  FROM (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY seller_city NULLS FIRST,
          seller_state NULLS FIRST, seller_zip_code_prefix NULLS FIRST) AS nth FROM raw_sellers) WHERE nth = 1),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id NULLS FIRST, product_category_name_english NULLS FIRST)
           AS product_key, product_id, p.product_category_name AS category_name_pt,
         product_category_name_english AS category_name_en, product_weight_g::DECIMAL(10,2) AS weight_g,
         product_length_cm::DECIMAL(8,2) AS length_cm, product_height_cm::DECIMAL(8,2) AS height_cm,
         product_width_cm::DECIMAL(8,2) AS width_cm
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS FIRST,
          product_weight_g NULLS FIRST, product_length_cm NULLS FIRST, product_height_cm NULLS FIRST,
          product_width_cm NULLS FIRST) AS nth FROM raw_products) p
  LEFT JOIN raw_category_xlat x ON p.product_category_name IS NOT DISTINCT FROM x.product_category_name
  WHERE nth = 1),
dim_location AS (
  SELECT row_number() OVER (ORDER BY zip) AS location_key, zip AS zip_code_prefix,
         arg_min(city, (city, lat, lng, state)) AS city, arg_min(state, (city, lat, lng, state)) AS state,
         {_median('lat')} AS lat, {_median('lng')} AS lng
  FROM (SELECT {_pad('geolocation_zip_code_prefix')} AS zip, geolocation_city AS city, geolocation_state AS state,
               geolocation_lat AS lat, geolocation_lng AS lng FROM raw_geolocation)
  GROUP BY zip),
best_payment AS (
  SELECT order_id, payment_value, payment_type, payment_installments FROM raw_payments WHERE order_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type, payment_installments) = 1),
last_review AS (
  SELECT order_id, review_score FROM raw_reviews WHERE order_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY review_answer_timestamp DESC NULLS LAST, review_id NULLS FIRST, review_score) = 1),
judged AS (
  SELECT i.order_id, i.product_id, i.seller_id, i.price, i.freight_value, c.customer_key, p.product_key, s.seller_key,
         o.order_status, o.order_purchase_timestamp AS bought, b.payment_value, b.payment_type,
         b.payment_installments, r.review_score,
         {_whole_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS delivery_days,
         {_whole_days('o.order_estimated_delivery_date', 'o.order_purchase_timestamp')} AS estimated_delivery_days,
         CASE WHEN o.order_delivered_customer_date >= o.order_purchase_timestamp
              THEN o.order_delivered_customer_date > o.order_estimated_delivery_date END AS is_late_delivery,
         CASE WHEN o.order_id IS NULL THEN 'unknown_order'
              WHEN o.order_purchase_timestamp IS NULL THEN 'no_purchase_time'
              WHEN c.customer_key IS NULL THEN 'unknown_customer'
              WHEN p.product_key IS NULL THEN 'unknown_product'
              WHEN s.seller_key IS NULL THEN 'unknown_seller'
              WHEN coalesce(o.order_estimated_delivery_date < o.order_purchase_timestamp, true)
              THEN 'no_valid_estimate' END AS reason
  FROM (SELECT * FROM raw_order_items
        WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL) i
  LEFT JOIN (SELECT * FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL) o
         ON o.order_id = i.order_id
  LEFT JOIN dim_customer c ON c.customer_id = o.customer_id
  LEFT JOIN dim_product p ON p.product_id = i.product_id
  LEFT JOIN dim_seller s ON s.seller_id = i.seller_id
  LEFT JOIN best_payment b ON b.order_id = o.order_id
  LEFT JOIN last_review r ON r.order_id = o.order_id),
fact AS (
  SELECT order_id, customer_key, product_key, seller_key,
         (year(bought) * 10000 + month(bought) * 100 + day(bought))::INTEGER AS date_key, order_status,
         price, freight_value, payment_value, payment_type, payment_installments, review_score, delivery_days,
         estimated_delivery_days, is_late_delivery
  FROM judged WHERE reason IS NULL),
sale AS (
  SELECT *, price + freight_value AS paid FROM fact WHERE order_status NOT IN ('canceled', 'unavailable'))"""


def raw(damaged: bool = False) -> str:
    return ",".join([LINES, CLEAN_RAW, DAMAGE if damaged else "\n" + RAW_FROM_CLEAN])


def star(damaged: bool = False) -> str:
    return raw(damaged) + "," + STAR

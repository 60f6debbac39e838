"""SQL twins of the registered queries, for the DuckDB oracle.

Each query is a ``WITH`` chain over the raw test tables: the adapter views
(the same integer arithmetic as ``sources.testbed``), then staging,
intermediate, dimension, fact and mart relations, and the final question.  The
relations are stated from what their rows mean, in forms of their own: one
stream of order events, sums per measure, positions turned into tiles by
arithmetic, percentiles from counts per value, and shares from ladders.  Only the CTEs a query needs are emitted, in
dependency order.

The SQL follows the same numeric conventions as the Spark side: money is
DECIMAL(18,2), percentages are ``100.0 * CAST(a AS DOUBLE) / CAST(b AS
DOUBLE)``, ties in rankings are broken by the business key, and nulls sort
last where the original engine puts them last.
"""

from __future__ import annotations

import re

from marketlens.functions import bands as B


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pct_sql(a: str, b: str) -> str:
    return f"100.0 * CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)"


def exact_avg_sql(x: str, scale: int) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(30,{scale}))) AS DOUBLE) / CAST(count({x}) AS DOUBLE)"


def tile_sql(tiles: int, place: str, n: str) -> str:
    """Number of the tile of row ``place`` of ``n``: the first ``n % tiles``
    tiles have one row more than the others."""
    small, more = f"({n} // {tiles})", f"({n} % {tiles})"
    wide = f"({more} * ({small} + 1))"
    return f"CASE WHEN {place} <= {wide} THEN ({place} - 1) // ({small} + 1) + 1 ELSE {more} + ({place} - 1 - {wide}) // {small} + 1 END"


def _case(rules: list[tuple[str, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {cond} THEN {_q(label)}" for cond, label in rules)
    return f"CASE {whens} ELSE {_q(otherwise)} END"


def delivery_bucket_sql(d: str) -> str:
    b = B.DELIVERY_BUCKETS
    return _case([(f"{d} < 0", b[0]), (f"{d} = 0", b[1]), (f"{d} <= 5", b[2]), (f"{d} <= 15", b[3])], b[4])


def late_bucket_sql(d: str) -> str:
    b = B.LATE_BUCKETS
    return _case([(f"{d} <= 0", b[0]), (f"{d} <= 5", b[1])], b[2])


def weight3_sql(g: str) -> str:
    b = B.WEIGHT_BANDS_3
    return _case([(f"{g} < 500", b[0]), (f"{g} < 2000", b[1])], b[2])


def weight4_sql(g: str) -> str:
    b = B.WEIGHT_BANDS_4
    return _case([(f"{g} < 500", b[0]), (f"{g} < 2000", b[1]), (f"{g} < 10000", b[2])], b[3])


def distance_sql(k: str) -> str:
    b = B.DISTANCE_BANDS
    return _case([(f"{k} < 100", b[0]), (f"{k} < 500", b[1]), (f"{k} < 1000", b[2])], b[3])


def seller_late_sql(r: str) -> str:
    b = B.SELLER_LATE_BANDS
    return _case([(f"{r} = 0", b[0]), (f"{r} < 0.05", b[1]), (f"{r} < 0.10", b[2]), (f"{r} < 0.25", b[3])], b[4])


def volume_sql(n: str) -> str:
    b = B.VOLUME_BANDS
    return _case([(f"{n} < 10", b[0]), (f"{n} < 50", b[1]), (f"{n} < 200", b[2])], b[3])


# ---------------------------------------------------------------------------
# CTE catalogue: name -> body.  Dependencies are discovered from the text.
# ---------------------------------------------------------------------------
CTES: dict[str, str] = {}

CTES["items_n"] = """
SELECT l_orderkey AS order_no,
       row_number() OVER (PARTITION BY l_orderkey
                          ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate) AS order_item_id,
       l_partkey AS product_no,
       l_suppkey * 1000 + CASE WHEN l_partkey % 2 = 0 THEN 0
                               WHEN l_partkey % 8 = 1 THEN 1
                               WHEN l_partkey % 8 = 5 THEN 2 + l_partkey % 40
                               ELSE 100 + l_partkey % 400 END AS seller_no,
       l_shipdate AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) / 100 AS DECIMAL(18,2)) AS freight_value
FROM lineitem"""

CTES["raw_orders"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_orderkey AS VARCHAR) AS customer_id,
       CASE WHEN o_orderkey % 50 = 0 THEN 'canceled' WHEN o_orderkey % 33 = 0 THEN 'shipped' ELSE 'delivered' END AS order_status,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_purchase_timestamp,
       o_orderdate + to_hours(CAST(o_orderkey % 24 + 1 AS INTEGER)) AS order_approved_at,
       o_orderdate + to_hours(CAST(o_orderkey % 24 + 30 AS INTEGER)) AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 33 = 0 THEN NULL
            ELSE o_orderdate + to_hours(CAST((o_orderkey * 7) % 24
                 + 24 * (2 + (o_orderkey * 7919) % 41 + CASE WHEN o_orderkey % 97 = 0 THEN 25 ELSE 0 END) AS INTEGER))
       END AS order_delivered_customer_date,
       o_orderdate + to_days(CAST(32 + (o_orderkey * 31) % 14 AS INTEGER)) AS order_estimated_delivery_date
FROM orders"""

CTES["raw_customers"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS customer_id,
       CAST(CASE WHEN o_orderkey % 30 <> 0 THEN 1000000 + o_orderkey ELSE o_custkey END AS VARCHAR) AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       c_mktsegment AS customer_city,
       n_name AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

CTES["raw_order_items"] = """
SELECT CAST(order_no AS VARCHAR) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
       CAST(product_no AS VARCHAR) AS product_id, CAST(seller_no AS VARCHAR) AS seller_id,
       shipping_limit_date, price, freight_value
FROM items_n"""

CTES["raw_sellers"] = """
SELECT CAST(s.seller_no AS VARCHAR) AS seller_id,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       n_name AS seller_city,
       r_name AS seller_state
FROM (SELECT DISTINCT seller_no FROM items_n) s
JOIN supplier ON s.seller_no // 1000 = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

CTES["raw_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_type ELSE p_type || '_' || (p_size % 5) END AS product_category_name,
       length(p_name) AS product_name_lenght,
       200 + p_partkey % 1801 AS product_description_lenght,
       1 + p_partkey % 6 AS product_photos_qty,
       CAST(CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_size * 250 END AS BIGINT) AS product_weight_g,
       10 + p_partkey % 91 AS product_length_cm,
       2 + p_partkey % 53 AS product_height_cm,
       CASE WHEN p_partkey % 89 <> 0 THEN 6 + p_partkey % 71 END AS product_width_cm
FROM part"""

CTES["raw_translation"] = """
SELECT DISTINCT name AS product_category_name, lower(name) AS product_category_name_english
FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_type || '_' || (p_size % 5) END AS name FROM part WHERE p_type <> 'SMALL')"""

CTES["raw_reviews"] = """
SELECT CAST(order_no * 10 + k AS VARCHAR) AS review_id,
       CAST(order_no AS VARCHAR) AS order_id,
       CAST(1 + (order_no * 31 + k * 3) % 5 AS BIGINT) AS review_score,
       CASE WHEN order_no % 3 = 0 THEN 'title ' || (order_no % 17) END AS review_comment_title,
       CASE WHEN order_no % 4 <> 0 THEN 'first line' || chr(10) || '"second", ' || order_no END AS review_comment_message,
       o_orderdate + to_days(CAST(20 + order_no % 9 AS INTEGER)) AS review_creation_date,
       o_orderdate + to_days(CAST(30 + k AS INTEGER)) + to_hours(CAST(order_no % 24 AS INTEGER)) AS review_answer_timestamp
FROM (SELECT o_orderkey AS order_no, o_orderdate, unnest([0, 1]) AS k FROM orders WHERE o_orderkey % 10 <> 0) r
WHERE k = 0 OR order_no % 13 = 0"""

CTES["pay_cents"] = """
SELECT order_no,
       CAST(round(sum(price + freight_value) * 100) AS BIGINT)
         + CASE WHEN order_no % 250 = 3 THEN 1044 WHEN order_no % 1000 = 5 THEN -215 ELSE 0 END AS cents
FROM items_n WHERE order_no % 400 <> 1 GROUP BY order_no"""

CTES["raw_payments"] = """
SELECT CAST(order_no AS VARCHAR) AS order_id,
       CAST(k AS BIGINT) AS payment_sequential,
       CASE WHEN k = 1 THEN 'credit_card' ELSE 'voucher' END AS payment_type,
       CAST(1 AS BIGINT) AS payment_installments,
       CAST((CASE WHEN order_no % 7 <> 0 THEN cents WHEN k = 1 THEN cents * 6 // 10
                  ELSE cents - cents * 6 // 10 END) / 100 AS DECIMAL(18,2)) AS payment_value
FROM (SELECT order_no, cents, unnest([1, 2]) AS k FROM pay_cents) p
WHERE k = 1 OR order_no % 7 = 0"""

CTES["raw_geolocation"] = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       -30.0::DOUBLE + n_nationkey * 0.3::DOUBLE + k * 0.02::DOUBLE AS geolocation_lat,
       -65.0::DOUBLE + ((n_nationkey * 7) % 25) * 0.5::DOUBLE + k * 0.03::DOUBLE AS geolocation_lng,
       CAST(NULL AS VARCHAR) AS geolocation_city,
       CAST(NULL AS VARCHAR) AS geolocation_state
FROM (SELECT n_nationkey, unnest([0, 1, 2]) AS k FROM nation WHERE n_nationkey <> 24) g"""

# -- staging --------------------------------------------------------------
CTES["stg_customers"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM raw_customers"""

CTES["stg_orders"] = """
SELECT order_id, customer_id, order_status, order_purchase_timestamp,
       order_approved_at AS order_approved_timestamp,
       order_delivered_carrier_date AS order_delivered_carrier_timestamp,
       order_delivered_customer_date AS order_delivered_customer_timestamp,
       CAST(order_estimated_delivery_date AS DATE) AS order_estimated_delivery_date
FROM raw_orders"""

CTES["stg_order_items"] = """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date AS shipping_limit_timestamp, price, freight_value
FROM raw_order_items"""

CTES["stg_order_payments"] = """
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM raw_payments"""

CTES["stg_order_reviews"] = """
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
       review_creation_date AS review_creation_timestamp, review_answer_timestamp
FROM raw_reviews"""

CTES["stg_products"] = """
SELECT product_id, product_category_name,
       product_name_lenght AS product_name_length,
       product_description_lenght AS product_description_length,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
FROM raw_products"""

CTES["stg_sellers"] = """
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM raw_sellers"""

CTES["stg_geolocation"] = """
SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
FROM raw_geolocation"""

CTES["stg_category_translation"] = """
SELECT product_category_name, product_category_name_english FROM raw_translation"""

# -- intermediate --------------------------------------------------------------
CTES["int_order_items_aggregated"] = """
SELECT order_id, count(*) AS item_count,
       CAST(sum(price) AS DECIMAL(18,2)) AS total_item_price,
       CAST(sum(freight_value) AS DECIMAL(18,2)) AS total_freight_value
FROM stg_order_items GROUP BY order_id"""

CTES["int_order_payments_aggregated"] = """
SELECT order_id, CAST(sum(payment_value) AS DECIMAL(18,2)) AS total_payment_value, count(*) AS payment_count
FROM stg_order_payments GROUP BY order_id"""

CTES["int_order_reviews_aggregated"] = """
SELECT order_id, avg(CAST(review_score AS DOUBLE)) AS avg_review_score, count(*) AS review_count
FROM stg_order_reviews GROUP BY order_id"""

CTES["int_geolocation_deduped"] = """
SELECT geolocation_zip_code_prefix AS zip_code_prefix,
       CAST(sum(CAST(geolocation_lat AS DECIMAL(28,12))) AS DOUBLE) / count(geolocation_lat) AS latitude,
       CAST(sum(CAST(geolocation_lng AS DECIMAL(28,12))) AS DOUBLE) / count(geolocation_lng) AS longitude
FROM stg_geolocation GROUP BY geolocation_zip_code_prefix"""

# -- dimensions ------------------------------------------------------------------
CTES["dim_customers"] = """
SELECT md5(coalesce(CAST(customer_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS customer_key,
       customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state
FROM stg_customers"""

CTES["dim_products"] = """
SELECT md5(coalesce(CAST(p.product_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS product_key,
       p.product_id, p.product_category_name, c.product_category_name_english,
       p.product_name_length, p.product_description_length, p.product_photos_qty, p.product_weight_g,
       p.product_length_cm, p.product_height_cm, p.product_width_cm
FROM stg_products p LEFT JOIN stg_category_translation c ON p.product_category_name = c.product_category_name"""

CTES["dim_sellers"] = """
SELECT md5(coalesce(CAST(seller_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS seller_key,
       seller_id, seller_zip_code_prefix, seller_city, seller_state
FROM stg_sellers"""

# -- facts ---------------------------------------------------------------------------
CTES["order_events"] = """
SELECT order_id, 'item' AS event, CAST(price AS DECIMAL(18,2)) AS amount, CAST(freight_value AS DECIMAL(18,2)) AS extra FROM stg_order_items
UNION ALL SELECT order_id, 'payment', CAST(payment_value AS DECIMAL(18,2)), NULL FROM stg_order_payments
UNION ALL SELECT order_id, 'review', CAST(review_score AS DECIMAL(18,2)), NULL FROM stg_order_reviews"""

CTES["order_sums"] = """
SELECT order_id,
       nullif(count(*) FILTER (event = 'item'), 0) AS item_count,
       CAST(sum(amount) FILTER (event = 'item') AS DECIMAL(18,2)) AS total_item_price,
       CAST(sum(extra) AS DECIMAL(18,2)) AS total_freight_value,
       CAST(sum(amount) FILTER (event = 'payment') AS DECIMAL(18,2)) AS total_payment_value,
       nullif(count(*) FILTER (event = 'payment'), 0) AS payment_count,
       avg(CAST(amount AS DOUBLE)) FILTER (event = 'review') AS avg_review_score,
       nullif(count(*) FILTER (event = 'review'), 0) AS review_count
FROM order_events GROUP BY order_id"""

CTES["fct_orders"] = """
SELECT md5(coalesce(order_id, '_dbt_utils_surrogate_key_null_')) AS order_key, * EXCLUDE (customer_id, bought, arrived),
       arrived - bought AS delivery_days,
       arrived - order_estimated_delivery_date AS delivery_vs_estimate_days
FROM (SELECT *, CAST(order_purchase_timestamp AS DATE) AS bought, CAST(order_delivered_customer_timestamp AS DATE) AS arrived FROM stg_orders)
LEFT JOIN (SELECT customer_id, customer_key FROM dim_customers) USING (customer_id)
LEFT JOIN order_sums USING (order_id)"""

CTES["places"] = """
SELECT 'order' AS kind, order_id AS id, latitude AS lat, longitude AS lng
FROM stg_orders JOIN stg_customers USING (customer_id)
JOIN int_geolocation_deduped ON zip_code_prefix = customer_zip_code_prefix
UNION ALL
SELECT 'seller', seller_id, latitude, longitude
FROM stg_sellers JOIN int_geolocation_deduped ON zip_code_prefix = seller_zip_code_prefix"""

CTES["routes"] = """
WITH ends AS (
  SELECT order_id, seller_id, radians(a.lat) AS lat_a, radians(b.lat) AS lat_b,
         sin(radians(b.lat - a.lat) / 2) AS half_lat, sin(radians(b.lng - a.lng) / 2) AS half_lng
  FROM (SELECT DISTINCT order_id, seller_id FROM stg_order_items)
  JOIN places a ON a.kind = 'order' AND a.id = order_id
  JOIN places b ON b.kind = 'seller' AND b.id = seller_id)
SELECT order_id, seller_id, 2 * 6371 * asin(sqrt(pow(half_lat, 2) + cos(lat_a) * cos(lat_b) * pow(half_lng, 2))) AS km FROM ends"""

CTES["fct_order_items"] = """
SELECT md5(concat_ws('-', coalesce(order_id, '_dbt_utils_surrogate_key_null_'),
                     coalesce(CAST(order_item_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS order_item_key,
       order_id, order_item_id, product_key, seller_key, shipping_limit_timestamp, price, freight_value,
       km AS customer_seller_distance_km
FROM stg_order_items
LEFT JOIN (SELECT product_id, product_key FROM dim_products) USING (product_id)
LEFT JOIN (SELECT seller_id, seller_key FROM dim_sellers) USING (seller_id)
LEFT JOIN routes USING (order_id, seller_id)"""

# -- marts -----------------------------------------------------------------------------
CTES["person_orders"] = """
SELECT customer_unique_id, customer_state, customer_city, fct_orders.*
FROM fct_orders JOIN dim_customers USING (customer_key)"""

CTES["person_payments"] = """
SELECT customer_unique_id, CAST(max(order_purchase_timestamp) AS DATE) AS last_day, count(*) AS frequency,
       CAST(round(sum(total_payment_value), 2) AS DOUBLE) AS monetary
FROM person_orders WHERE total_payment_value IS NOT NULL GROUP BY customer_unique_id"""

CTES["customer_rfm"] = f"""
WITH placed AS (
  SELECT customer_unique_id, frequency, monetary, (SELECT max(last_day) FROM person_payments) - last_day AS recency_days,
         row_number() OVER (ORDER BY last_day, customer_unique_id) AS by_day,
         row_number() OVER (ORDER BY monetary, customer_unique_id) AS by_money,
         (SELECT count(*) FROM person_payments) AS n
  FROM person_payments),
graded AS (
  SELECT customer_unique_id, recency_days, frequency, monetary,
         {tile_sql(5, 'by_day', 'n')} AS r_score, {tile_sql(5, 'by_money', 'n')} AS m_score,
         [1, 3, 5][least(frequency, 3)] AS f_score
  FROM placed)
SELECT *, {_case([('f_score = 5', B.SEG_LOYAL), ('least(r_score, m_score) >= 4', B.SEG_CHAMPIONS), ('m_score >= 4 AND r_score <= 2', B.SEG_AT_RISK),
                  ('r_score >= 4 AND m_score <= 2', B.SEG_NEW_LOW), ('greatest(r_score, m_score) <= 2', B.SEG_LOST)], B.SEG_REGULAR)} AS segment
FROM graded"""

CTES["person_summary"] = """
SELECT customer_unique_id, max(customer_state) AS customer_state, max(customer_city) AS customer_city,
       count(*) AS order_count, round(CAST(sum(total_payment_value) AS DOUBLE), 2) AS total_spent,
       round(avg(avg_review_score), 2) AS avg_review_score, max(order_purchase_timestamp) AS last_order
FROM person_orders GROUP BY customer_unique_id"""

CTES["customer_satisfaction"] = """
WITH per_value AS (SELECT total_spent, count(*) AS n FROM person_summary GROUP BY total_spent),
standing AS (
  SELECT total_spent, sum(n) OVER (ORDER BY total_spent NULLS LAST) - n AS below, greatest(sum(n) OVER () - 1, 1) AS others FROM per_value)
SELECT customer_unique_id, customer_state, customer_city, order_count, p.total_spent, avg_review_score,
       round(CAST(below AS DOUBLE) / CAST(others AS DOUBLE), 4) AS spending_percentile,
       year(last_order) AS order_year, monthname(last_order) AS order_month
FROM person_summary p JOIN standing s ON p.total_spent IS NOT DISTINCT FROM s.total_spent"""

CTES["category_satisfaction"] = """
WITH marks AS (
  SELECT order_id, CAST(round(avg_review_score) AS INTEGER) AS review_score FROM fct_orders WHERE avg_review_score IS NOT NULL),
sold AS (SELECT product_key, review_score, sum(lines) AS lines FROM baskets JOIN marks USING (order_id) GROUP BY ALL)
SELECT coalesce(product_category_name_english, product_category_name, '(uncategorised)') AS product_category,
       review_score, CAST(sum(lines) AS BIGINT) AS item_count
FROM sold JOIN dim_products USING (product_key) GROUP BY ALL"""

CTES["seller_performance"] = """
WITH volume AS (
  SELECT seller_key, count(*) AS item_count, round(CAST(sum(price) AS DOUBLE), 2) AS total_revenue,
         round(CAST(sum(freight_value) AS DOUBLE), 2) AS total_freight, round(avg(customer_seller_distance_km), 1) AS avg_distance_km
  FROM fct_order_items GROUP BY seller_key),
per_order AS (SELECT seller_key, order_id, count(*) AS lines FROM fct_order_items GROUP BY ALL),
outcome AS (
  SELECT seller_key, count(*) AS order_count,
         CAST(coalesce(sum(lines) FILTER (delivery_vs_estimate_days IS NOT NULL), 0) AS BIGINT) AS delivered_item_count,
         coalesce(sum(lines) FILTER (delivery_vs_estimate_days > 0), 0) AS late_lines,
         round(sum(lines * avg_review_score) / sum(lines) FILTER (avg_review_score IS NOT NULL), 2) AS avg_review_score
  FROM per_order LEFT JOIN fct_orders USING (order_id) GROUP BY seller_key),
variety AS (SELECT seller_key, count(product_key) AS product_count FROM (SELECT DISTINCT seller_key, product_key FROM fct_order_items) GROUP BY seller_key)
SELECT seller_key, seller_id, seller_state, item_count, delivered_item_count, order_count, product_count, total_revenue, total_freight,
       avg_review_score,
       round(CAST(late_lines AS DOUBLE) / nullif(delivered_item_count, 0), 4) AS late_rate,
       avg_distance_km
FROM volume JOIN outcome USING (seller_key) JOIN variety USING (seller_key) LEFT JOIN dim_sellers USING (seller_key)"""

CTES["category_totals"] = """
SELECT coalesce(product_category_name_english, '(uncategorised)') AS category, sum(sold) AS revenue
FROM (SELECT product_key, sum(price) AS sold FROM fct_order_items GROUP BY product_key) JOIN dim_products USING (product_key)
GROUP BY ALL"""

CTES["category_ladder"] = """
SELECT own.category, own.revenue, count(*) AS step, sum(up.revenue) AS reached
FROM category_totals own JOIN category_totals up
  ON up.revenue > own.revenue OR (up.revenue = own.revenue AND up.category <= own.category)
GROUP BY own.category, own.revenue"""

CTES["seller_places"] = """
SELECT CAST(total_revenue AS DECIMAL(18,2)) AS sold, row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, seller_key) AS place,
       (SELECT count(*) FROM seller_performance) AS n
FROM seller_performance"""

CTES["seller_tenths"] = f"""
SELECT {tile_sql(10, 'place', 'n')} AS decile, count(*) AS sellers, sum(sold) AS sold FROM seller_places GROUP BY 1"""

# ---------------------------------------------------------------------------
# Final SELECTs per query key.
# ---------------------------------------------------------------------------
FINAL: dict[str, str] = {}

_MODEL_KEYS = [
    "stg_customers", "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
    "stg_products", "stg_sellers", "stg_geolocation", "stg_category_translation",
    "int_order_items_aggregated", "int_order_payments_aggregated", "int_order_reviews_aggregated",
    "int_geolocation_deduped", "dim_customers", "dim_products", "dim_sellers", "fct_orders",
    "fct_order_items", "customer_rfm", "customer_satisfaction", "category_satisfaction", "seller_performance",
]
for _k in _MODEL_KEYS:
    FINAL[_k] = f"SELECT * FROM {_k}"

FINAL["frequency_distribution"] = f"""
SELECT frequency, count(*) AS customers, round({pct_sql('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct
FROM customer_rfm GROUP BY frequency ORDER BY frequency"""

FINAL["segment_sizes"] = f"""
SELECT segment, count(*) AS customers, round({pct_sql('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct_customers
FROM customer_rfm GROUP BY segment ORDER BY customers DESC"""

FINAL["segment_revenue"] = f"""
SELECT segment, count(*) AS customers,
       round({pct_sql('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct_customers,
       round(CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE)) AS revenue,
       round({pct_sql('sum(CAST(monetary AS DECIMAL(18,2)))', 'sum(sum(CAST(monetary AS DECIMAL(18,2)))) OVER ()')}, 1) AS pct_revenue
FROM customer_rfm GROUP BY segment ORDER BY revenue DESC"""

# What became of each delivered order, and each order's lines by product and route.
CTES["outcomes"] = """
  SELECT order_id, delivery_vs_estimate_days AS days, avg_review_score AS score FROM fct_orders
  WHERE delivery_vs_estimate_days IS NOT NULL"""

CTES["baskets"] = """
  SELECT order_id, product_key, customer_seller_distance_km AS km, count(*) AS lines FROM fct_order_items GROUP BY ALL"""

CTES["product_outcomes"] = """
  SELECT product_key, days, score, sum(lines) AS lines FROM baskets JOIN outcomes USING (order_id) GROUP BY ALL"""


def _late_share(weight: str) -> str:
    return f"round(100.0 * (CAST(coalesce(sum({weight}) FILTER (days > 0), 0) AS DOUBLE) / sum({weight})), 1)"


def _scores_by(key: str, name: str, source: str, condition: str = "TRUE") -> str:
    """Lines and their mean score by a key and lateness, of reviewed orders."""
    return f"""
SELECT {key} AS {name}, {late_bucket_sql('days')} AS bucket,
       CAST(sum(lines) AS BIGINT) AS items, round(sum(score * lines) / sum(lines), 2) AS avg_score
FROM {source} WHERE score IS NOT NULL AND {condition}
GROUP BY ALL ORDER BY ALL"""


def _late_by(key: str, name: str, source: str, condition: str, more: str = "") -> str:
    return f"""
SELECT {key} AS {name}, CAST(sum(lines) AS BIGINT) AS items, {more}{_late_share('lines')} AS pct_late
FROM {source} WHERE {condition} GROUP BY 1"""


_PRODUCTS = "product_outcomes JOIN dim_products USING (product_key)"
_ROUTES = "baskets JOIN outcomes USING (order_id)"

FINAL["review_by_delivery_bucket"] = f"""
SELECT {delivery_bucket_sql('days')} AS delivery_bucket, count(score) AS orders, round(sum(score) / count(score), 2) AS avg_score
FROM outcomes WHERE score IS NOT NULL GROUP BY ALL ORDER BY ALL"""


def _review_by_category_sql(categories) -> str:
    listed = ", ".join(_q(c) for c in categories)
    return _scores_by("product_category_name_english", "category", _PRODUCTS, f"product_category_name_english IN ({listed})")


FINAL["review_by_weight_and_lateness"] = _scores_by(weight3_sql("product_weight_g"), "weight_band", _PRODUCTS, "product_weight_g IS NOT NULL")
FINAL["review_by_distance_and_lateness"] = _scores_by(distance_sql("km"), "distance_band", _ROUTES, "km IS NOT NULL")
FINAL["late_rate_by_distance"] = (
    _late_by(distance_sql("km"), "distance_band", _ROUTES, "km IS NOT NULL", "round(sum(km * lines) / sum(lines)) AS avg_km, ") + " ORDER BY 1"
)
FINAL["late_rate_by_weight"] = _late_by(weight4_sql("product_weight_g"), "weight_band", _PRODUCTS, "product_weight_g IS NOT NULL") + " ORDER BY 1"
FINAL["late_rate_by_category"] = (
    _late_by("product_category_name_english", "category", _PRODUCTS, "product_category_name_english IS NOT NULL")
    + " HAVING sum(lines) >= 1000 ORDER BY pct_late DESC"
)

FINAL["seller_late_bands_from_facts"] = f"""
WITH per_order AS (SELECT seller_key, order_id, count(*) AS lines FROM fct_order_items GROUP BY ALL),
judged AS (
  SELECT seller_key, sum(lines) AS items, CAST(coalesce(sum(lines) FILTER (delivery_vs_estimate_days > 0), 0) AS DOUBLE) / sum(lines) AS share_late
  FROM per_order JOIN fct_orders USING (order_id) WHERE delivery_vs_estimate_days IS NOT NULL GROUP BY seller_key)
SELECT {seller_late_sql('share_late')} AS seller_late_band, count(*) AS sellers, CAST(sum(items) AS BIGINT) AS items
FROM judged WHERE items >= 20 GROUP BY 1 ORDER BY 1"""

FINAL["late_rate_by_month"] = f"""
SELECT month, CAST(sum(orders) AS BIGINT) AS orders, {_late_share('orders')} AS pct_late
FROM (
  SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, days, count(*) AS orders
  FROM outcomes JOIN fct_orders USING (order_id) GROUP BY ALL)
GROUP BY month ORDER BY month"""

FINAL["category_revenue_top15"] = f"""
SELECT step AS category_rank, category, round(CAST(revenue AS DOUBLE)) AS revenue,
       round({pct_sql('revenue', '(SELECT sum(revenue) FROM category_totals)')}, 1) AS pct_revenue,
       round({pct_sql('reached', '(SELECT sum(revenue) FROM category_totals)')}, 1) AS cum_pct_revenue
FROM category_ladder ORDER BY step LIMIT 15"""

FINAL["seller_revenue_deciles"] = f"""
SELECT decile, sellers, round(CAST(sold AS DOUBLE)) AS revenue,
       round({pct_sql('sold', '(SELECT sum(sold) FROM seller_tenths)')}, 1) AS pct_revenue,
       round({pct_sql('(SELECT sum(up.sold) FROM seller_tenths up WHERE up.decile <= own.decile)', '(SELECT sum(sold) FROM seller_tenths)')}, 1) AS cum_pct_revenue
FROM seller_tenths own ORDER BY decile"""

FINAL["seller_pareto_bands"] = f"""
WITH limits(seller_band, share) AS (VALUES ('1 top 1%', 0.01), ('2 top 5%', 0.05), ('3 top 10%', 0.10), ('4 top 20%', 0.20), ('5 rest', 1.00)),
banded AS (
  SELECT place, sold, min(seller_band) AS seller_band FROM seller_places JOIN limits ON place <= share * n GROUP BY place, sold)
SELECT seller_band, count(*) AS sellers, round(CAST(sum(sold) AS DOUBLE)) AS revenue,
       round({pct_sql('sum(sold)', '(SELECT sum(sold) FROM seller_places)')}, 1) AS pct_revenue
FROM banded GROUP BY seller_band ORDER BY seller_band"""

FINAL["seller_quality_by_volume"] = f"""
SELECT {volume_sql('item_count')} AS volume_band,
       count(*) AS sellers,
       CAST(sum(item_count) AS BIGINT) AS items,
       round({exact_avg_sql('avg_review_score', 2)}, 2) AS avg_review,
       round(100.0 * {exact_avg_sql('late_rate', 4)}, 1) AS avg_late_pct
FROM seller_performance GROUP BY 1 ORDER BY 1"""

FINAL["seller_late_bands_from_mart"] = f"""
SELECT {seller_late_sql('late_rate')} AS seller_late_band,
       count(*) AS sellers,
       CAST(sum(delivered_item_count) AS BIGINT) AS items
FROM seller_performance
WHERE late_rate IS NOT NULL AND delivered_item_count >= 20
GROUP BY 1 ORDER BY 1"""


CTES["payment_reconciliation"] = """
SELECT order_id, total_payment_value,
       CAST(total_item_price + total_freight_value AS DECIMAL(18,2)) AS expected_value,
       CAST(total_payment_value - (total_item_price + total_freight_value) AS DECIMAL(18,2)) AS difference
FROM fct_orders
WHERE total_payment_value IS NOT NULL AND total_item_price IS NOT NULL AND total_freight_value IS NOT NULL
  AND abs(total_payment_value - (total_item_price + total_freight_value)) > 0.01"""

FINAL["payment_reconciliation"] = "SELECT * FROM payment_reconciliation"

_LATE_OR_NULL = "CASE WHEN delivery_vs_estimate_days IS NULL THEN NULL WHEN delivery_vs_estimate_days <= 0 THEN 0 ELSE 1 END"

FINAL["headline_kpis"] = f"""
SELECT count(*) AS orders, count(delivery_vs_estimate_days) AS delivered_orders,
       round(CAST(sum(total_item_price) AS DOUBLE)) AS gmv,
       round(avg(avg_review_score), 2) AS avg_review,
       round(100.0 * avg({_LATE_OR_NULL}), 1) AS pct_late,
       round(100.0 * avg(1 - {_LATE_OR_NULL}), 1) AS pct_on_time
FROM fct_orders"""

FINAL["monthly_revenue_and_review"] = """
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(*) AS orders,
       round(CAST(sum(total_item_price) AS DOUBLE), 2) AS revenue,
       round(avg(avg_review_score), 2) AS avg_review
FROM fct_orders GROUP BY 1 ORDER BY 1"""

FINAL["top_sellers"] = """
SELECT seller_id, seller_state, total_revenue, order_count, item_count
FROM seller_performance ORDER BY total_revenue DESC NULLS LAST, seller_id LIMIT 10"""

FINAL["top_sellers_by_orders"] = """
SELECT seller_id, seller_state, total_revenue, order_count, item_count
FROM seller_performance ORDER BY order_count DESC NULLS LAST, seller_id LIMIT 10"""

FINAL["top_categories_by_orders"] = """
SELECT coalesce(product_category_name_english, '(uncategorised)') AS category,
       round(CAST(sum(price) AS DOUBLE), 2) AS revenue, count(DISTINCT order_id) AS orders
FROM fct_order_items JOIN dim_products USING (product_key)
GROUP BY 1 ORDER BY orders DESC NULLS LAST, category LIMIT 10"""

FINAL["top_categories"] = """
SELECT coalesce(p.product_category_name_english, '(uncategorised)') AS category,
       round(CAST(sum(oi.price) AS DOUBLE), 2) AS revenue,
       count(DISTINCT oi.order_id) AS orders
FROM fct_order_items oi JOIN dim_products p ON oi.product_key = p.product_key
GROUP BY 1 ORDER BY revenue DESC NULLS LAST, category LIMIT 10"""

FINAL["delivery_status_split"] = f"""
SELECT order_status, count(*) AS orders,
       round({pct_sql('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct_orders,
       count(delivery_vs_estimate_days) AS delivered_orders,
       count(*) FILTER (WHERE delivery_vs_estimate_days > 0) AS late_orders,
       round({pct_sql('count(*) FILTER (WHERE delivery_vs_estimate_days > 0)', 'nullif(count(delivery_vs_estimate_days), 0)')}, 1) AS pct_late,
       round({pct_sql('count(*) FILTER (WHERE delivery_vs_estimate_days <= 0)', 'nullif(count(delivery_vs_estimate_days), 0)')}, 1) AS pct_on_time
FROM fct_orders GROUP BY order_status"""

FINAL["late_rate_by_state"] = f"""
SELECT c.customer_state, count(*) AS orders,
       round(100.0 * avg(CASE WHEN o.delivery_vs_estimate_days <= 0 THEN 0 ELSE 1 END), 1) AS pct_late
FROM fct_orders o JOIN dim_customers c ON o.customer_key = c.customer_key
WHERE o.delivery_vs_estimate_days IS NOT NULL
GROUP BY 1"""

FINAL["category_review_mix"] = f"""
SELECT product_category, review_score, item_count,
       round({pct_sql('item_count', 'sum(item_count) OVER (PARTITION BY product_category)')}, 1) AS pct_of_category
FROM category_satisfaction"""

FINAL["high_spend_low_satisfaction"] = """
SELECT customer_unique_id, customer_state, total_spent, avg_review_score, spending_percentile
FROM customer_satisfaction WHERE spending_percentile >= 0.9 AND avg_review_score <= 2.0"""

FINAL["recency_spend_landscape"] = f"""
SELECT r_score, m_score, count(*) AS customers,
       round(avg(CAST(recency_days AS DOUBLE)), 1) AS avg_recency_days,
       round({exact_avg_sql('monetary', 2)}, 2) AS avg_monetary
FROM customer_rfm GROUP BY 1, 2"""

FINAL["payment_mismatch_summary"] = f"""
SELECT CASE WHEN difference > 0 THEN 'over' ELSE 'under' END AS direction, count(*) AS orders,
       round({exact_avg_sql('difference', 2)}, 2) AS mean_difference
FROM payment_reconciliation GROUP BY 1"""

FINAL["categories_to_reach_share"] = """
SELECT min(step) FILTER (reached * 100 >= 80 * (SELECT sum(revenue) FROM category_totals)) AS categories_needed,
       count(*) AS total_categories, 80 AS share_pct
FROM category_ladder"""

FINAL["bottom_half_seller_share"] = f"""
SELECT CAST(sum(sellers) FILTER (decile > 5) AS BIGINT) AS sellers,
       round({pct_sql('sum(sold) FILTER (decile > 5)', 'sum(sold)')}, 1) AS pct_revenue
FROM seller_tenths"""


_MARTS = {
    "dim_customers": "customer_key", "dim_products": "product_key", "dim_sellers": "seller_key", "fct_orders": "order_key",
    "fct_order_items": "order_item_key", "customer_rfm": "customer_unique_id", "customer_satisfaction": "customer_unique_id",
    "category_satisfaction": "product_category", "seller_performance": "seller_key",
}
FINAL["mart_export_report"] = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS mart, '{f}' AS format, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {m}"
    for m, k in _MARTS.items()
    for f in ("parquet", "csv")
)

FINAL["mart_refresh_report"] = "\nUNION ALL\n".join(
    f"SELECT '{b}' AS build, '{m}' AS mart, count(*) AS n_rows, count(*) AS n_stored FROM {m}" for b in ("previous", "current") for m in _MARTS
)


# Rows and values of every column of the marts; the three copies of each are equal.
FINAL["mart_export_checksums"] = "\nUNION ALL\n".join(
    f"SELECT '{m}' AS mart, column_name, (SELECT count(*) FROM {m}) AS n_rows, n_values, 3 AS copies, TRUE AS equal "
    f"FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {m}) ON COLUMNS(*) INTO NAME column_name VALUE n_values)"
    for m in _MARTS
)


def _sql_value(v) -> str:
    return _q(v) if isinstance(v, str) else repr(v)


def check_sql(chk) -> str:
    col = chk.columns[0]
    head = (f"SELECT {_q(chk.model)} AS table_name, {_q(chk.kind)} AS check_name, "
            f"{_q(chk.column_label)} AS column_name, {_q(chk.severity)} AS severity, CAST(count(*) AS BIGINT) AS violations")
    if chk.kind == "unique":
        return f"{head} FROM (SELECT {col} FROM {chk.model} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) t"
    if chk.kind == "not_null":
        return f"{head} FROM {chk.model} WHERE {col} IS NULL"
    if chk.kind == "accepted_values":
        vals = ", ".join(_sql_value(v) for v in chk.values)
        return f"{head} FROM (SELECT {col} AS value_field FROM {chk.model} GROUP BY {col}) t WHERE value_field NOT IN ({vals})"
    if chk.kind == "unique_combination":
        cols = ", ".join(chk.columns)
        return f"{head} FROM (SELECT {cols} FROM {chk.model} GROUP BY {cols} HAVING count(*) > 1) t"
    if chk.kind == "accepted_range":
        conds = []
        if chk.min_value is not None:
            conds.append(f"{col} < {chk.min_value!r}")
        if chk.max_value is not None:
            conds.append(f"{col} > {chk.max_value!r}")
        return f"{head} FROM {chk.model} WHERE {' OR '.join(conds)}"
    if chk.kind == "relationships":
        return (f"{head} FROM {chk.model} c LEFT JOIN (SELECT DISTINCT {chk.to_column} AS to_field FROM {chk.to_model}) p "
                f"ON c.{col} = p.to_field WHERE c.{col} IS NOT NULL AND p.to_field IS NULL")
    raise ValueError(chk.kind)


def register_quality(checks) -> None:
    parts = [check_sql(c) for c in checks]
    parts.append(
        "SELECT 'fct_orders' AS table_name, 'assert_payment_matches_order_value' AS check_name, "
        "'total_payment_value' AS column_name, 'warn' AS severity, CAST(count(*) AS BIGINT) AS violations "
        "FROM payment_reconciliation"
    )
    FINAL["dq_report"] = "\nUNION ALL\n".join(parts)


def register_review_by_category(categories) -> None:
    FINAL["review_by_category_and_lateness"] = _review_by_category_sql(categories)


# ---------------------------------------------------------------------------
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def with_chain(final_sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``final_sql`` with every CTE it (transitively) references."""
    ctes = CTES if ctes is None else ctes
    order: list[str] = []
    seen: set[str] = set()

    def named_in(body: str) -> list[str]:
        return [w for w in dict.fromkeys(_WORD.findall(body)) if w in ctes]

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in named_in(ctes[name]):
            if d != name:
                visit(d)
        order.append(name)

    for d in named_in(final_sql):
        visit(d)
    final = final_sql.strip()
    if not order:
        return final
    chain = ",\n".join(f"{n} AS ({ctes[n].strip()}\n)" for n in order)
    if final[:5].upper() == "WITH ":
        return f"WITH {chain},\n{final[5:]}"
    return f"WITH {chain}\n{final}"


def windowed_query(key: str, start: str, end: str) -> str:
    """A question on the orders placed in [start, end) and their lines only."""
    ctes = dict(CTES)
    ctes["every_order"], ctes["every_line"] = CTES["fct_orders"], CTES["fct_order_items"]
    ctes["fct_orders"] = (
        f"SELECT * FROM every_order WHERE order_purchase_timestamp >= TIMESTAMP '{start}' AND order_purchase_timestamp < TIMESTAMP '{end}'"
    )
    ctes["fct_order_items"] = "SELECT every_line.* FROM every_line SEMI JOIN fct_orders USING (order_id)"
    return with_chain(FINAL[key], ctes)


def oracle_queries() -> dict[str, str]:
    return {k: with_chain(v) for k, v in FINAL.items()}

"""Facts at order grain and order-line grain.

Join order is chosen for the shuffle budget, not copied from the SQL text:

* ``fct_orders``: the three child aggregates come out hash-partitioned on
  ``order_id``; joining them to the orders (after the customer lookup) keeps
  one ``order_id`` partitioning for all three joins.
* ``fct_order_items``: the customer's location is resolved at *order* grain
  (orders ⟕ customers ⟕ centroid) and the seller's at *seller* grain
  (sellers ⟕ centroid), so the line-item relation is joined only by
  ``order_id``, product and seller.  The lines come partitioned on ``order_id``,
  so that join goes first and needs no exchange of them; with ``by_order`` it
  goes last and leaves the fact partitioned on ``order_id``, which the
  order-fact join downstream reuses.  Left joins re-associate freely, so
  the result equals the original six-way left-join chain.
* Surrogate keys are digests that no codec shortens, so they are made after the
  last exchange: the lookups carry whether the id is known, and the key is its
  digest, as in ``dims``.
* With ``buckets`` both facts are dealt out into that many partitions on
  ``order_id``, one a stored bucket, while the rows are still narrow.  Their rows
  move for nothing else then: of customers and products they only ask whether the
  id is known, which a list of the ids that are not there exactly once tells
  (``skew_join.irregular_keys``), and the sellers' points come to the orders as
  pairs of order and seller.  ``STORED`` are the settings under which Spark sees
  that all of these meet where the lines lie.
* All of these are plain joins: AQE broadcasts a side when its runtime size is
  under the threshold, and otherwise shuffles (skew-split if a hot product or
  seller holds a large share of lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.semantics import day_diff, haversine_km, surrogate_key
from marketlens.operators.skew_join import look_up, look_up_known

# whether the id was found in its dimension
_CUSTOMER, _PRODUCT, _SELLER = "known_customer", "known_product", "known_seller"

# rows that lie by order may meet on order and seller
STORED = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


def _dealt(df: DataFrame, buckets: int | None) -> DataFrame:
    return df.repartition(buckets, "order_id") if buckets else df


def fct_orders(
    stg_orders: DataFrame,
    dim_customers: DataFrame,
    items_agg: DataFrame,
    payments_agg: DataFrame,
    reviews_agg: DataFrame,
    buckets: int | None = None,
    irregular_customers: DataFrame | None = None,
) -> DataFrame:
    """``irregular_customers``: (customer_id, copies) of ``skew_join.irregular_keys``."""
    if irregular_customers is None:
        customers = dim_customers.select("customer_id", F.col("customer_key").isNotNull().alias(_CUSTOMER))
        orders = stg_orders.join(customers, "customer_id", "left")
    else:
        orders = look_up_known(stg_orders, irregular_customers, "customer_id", _CUSTOMER)
    joined = (
        orders.join(items_agg, "order_id", "left")
        .join(payments_agg, "order_id", "left")
        .join(reviews_agg, "order_id", "left")
    )
    return _dealt(joined, buckets).select(
        surrogate_key("order_id").alias("order_key"),
        "order_id",
        F.when(F.col(_CUSTOMER), surrogate_key("customer_id")).alias("customer_key"),
        "order_status",
        "order_purchase_timestamp",
        "order_approved_timestamp",
        "order_delivered_carrier_timestamp",
        "order_delivered_customer_timestamp",
        "order_estimated_delivery_date",
        "item_count",
        "total_item_price",
        "total_freight_value",
        "total_payment_value",
        "payment_count",
        "avg_review_score",
        "review_count",
        day_diff("order_purchase_timestamp", "order_delivered_customer_timestamp").alias("delivery_days"),
        day_diff("order_estimated_delivery_date", "order_delivered_customer_timestamp").alias(
            "delivery_vs_estimate_days"
        ),
    )


def order_points(stg_orders: DataFrame, dim_customers: DataFrame, geo: DataFrame, month: str | None = None) -> DataFrame:
    """(order_id, c_lat, c_lng): the customer's centroid; with ``month`` the purchase month too."""
    cgeo = geo.select(
        F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("latitude").alias("c_lat"),
        F.col("longitude").alias("c_lng"),
    )
    months = [F.trunc("order_purchase_timestamp", "month").alias(month)] if month else []
    return (
        stg_orders.select("order_id", "customer_id", *months)
        .join(dim_customers.select("customer_id", "customer_zip_code_prefix"), "customer_id", "left")
        .join(cgeo, "customer_zip_code_prefix", "left")
        .select("order_id", "c_lat", "c_lng", *([month] if month else []))
    )


def seller_points(dim_sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """(seller_id, whether known, s_lat, s_lng): the seller's centroid."""
    sgeo = geo.select(
        F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("latitude").alias("s_lat"),
        F.col("longitude").alias("s_lng"),
    )
    return (
        dim_sellers.select("seller_id", F.col("seller_key").isNotNull().alias(_SELLER), "seller_zip_code_prefix")
        .join(sgeo, "seller_zip_code_prefix", "left")
        .select("seller_id", _SELLER, "s_lat", "s_lng")
    )


def fct_order_items(
    stg_items: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    stg_orders: DataFrame,
    dim_customers: DataFrame,
    geo: DataFrame,
    month: str | None = None,
    buckets: int | None = None,
    by_order: bool = False,
    irregular_products: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """The line fact; with ``month`` also the order's purchase month, under that name.
    ``irregular_products``: (product_id, copies) of ``skew_join.irregular_keys``.
    ``parts``: the shuffle partitions, where they are not as many as the buckets."""
    order_point = order_points(stg_orders, dim_customers, geo, month)
    seller_point = seller_points(dim_sellers, geo)
    if irregular_products is not None:
        joined = _where_the_lines_lie(stg_items, irregular_products, seller_point, order_point, parts or buckets)
    else:
        products = dim_products.select("product_id", F.col("product_key").isNotNull().alias(_PRODUCT))
        lines = stg_items if by_order else stg_items.join(order_point, "order_id", "left")
        lines = look_up(look_up(lines, products, "product_id"), seller_point, "seller_id")
        joined = lines.join(order_point, "order_id", "left") if by_order else lines
    distance = haversine_km(F.col("c_lat"), F.col("c_lng"), F.col("s_lat"), F.col("s_lng"))
    narrow = joined.withColumn("customer_seller_distance_km", distance).drop("c_lat", "c_lng", "s_lat", "s_lng")
    return _dealt(narrow, buckets).select(
        surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        F.when(F.col(_PRODUCT), surrogate_key("product_id")).alias("product_key"),
        F.when(F.col(_SELLER), surrogate_key("seller_id")).alias("seller_key"),
        "shipping_limit_timestamp",
        "price",
        "freight_value",
        "customer_seller_distance_km",
        *([month] if month else []),
    )


def _where_the_lines_lie(
    stg_items: DataFrame, irregular_products: DataFrame, seller_point: DataFrame, order_point: DataFrame, parts: int
) -> DataFrame:
    """Lines with all that is looked up, partitioned by order into ``parts``: pairs of order and seller go to the sellers and come back with a point for
    each row that a seller has; lines without an order have no such pair and go
    to the sellers themselves."""
    known = look_up_known(stg_items, irregular_products, "product_id", _PRODUCT)
    with_order, without = known.where(F.col("order_id").isNotNull()), known.where(F.col("order_id").isNull())
    one_by_one = Window.partitionBy("seller_id").orderBy("s_lat", "s_lng")
    numbered = seller_point.withColumn("copy", F.row_number().over(one_by_one))
    pairs = stg_items.where(F.col("order_id").isNotNull() & F.col("seller_id").isNotNull()).select("order_id", "seller_id")
    found = look_up(pairs, numbered, "seller_id").where(F.col(_SELLER))
    points = _dealt(found, parts).distinct().drop("copy")
    lines = with_order.join(points, ["order_id", "seller_id"], "left")
    rest = _dealt(look_up(without, seller_point, "seller_id"), parts)
    return lines.unionByName(rest).join(order_point, "order_id", "left")

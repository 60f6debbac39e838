"""Aggregate marts at person, seller and (category, score) grain.

Global rankings (NTILE, PERCENT_RANK) run through ``operators.ranking`` so no
step funnels a person-grain relation into one task.  Grand totals are scalar
subqueries (``DataFrame.scalar()``), evaluated once and inlined as a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.bands import frequency_score, rfm_segment
from marketlens.functions.semantics import category_with_fallback, haversine_km, packed_key, round_scaled, surrogate_key, unpacked_key
from marketlens.operators.ranking import global_ntile, global_percent_rank
from marketlens.operators.skew_join import blank_unknown, look_up, look_up_known


def customer_rfm_base(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """One row per paying person with frequency and exact spend — everything
    of the RFM mart that does not depend on the quintile scores."""
    paid = fct_orders.where(F.col("total_payment_value").isNotNull()).join(
        dim_customers.select("customer_key", "customer_unique_id"), "customer_key"
    )
    return paid.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_payment_value").alias("monetary_exact"),
    )


def customer_rfm(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    per_person = customer_rfm_base(fct_orders, dim_customers)
    uid = F.col("customer_unique_id").asc()
    # recency_days = date(latest) - date(last purchase) with one global
    # "latest", so "recency_days DESC" is exactly "purchase date ASC": rank
    # on the date and derive the day count afterwards from the ranked frame.
    last_day = F.to_date("last_purchase")
    scored = global_ntile(per_person, 5, [last_day.asc_nulls_last(), uid], "r_score")
    scored = scored.withColumn("monetary", round_scaled(F.col("monetary_exact").cast("double"), 2))
    scored = global_ntile(scored, 5, [F.col("monetary").asc_nulls_last(), uid], "m_score")
    # The snapshot date is the latest paid purchase overall = max over persons.
    latest = scored.agg(F.max("last_purchase")).scalar()
    scored = scored.withColumn("recency_days", F.datediff(latest, F.col("last_purchase")).cast("bigint"))
    scored = scored.withColumn("f_score", frequency_score("frequency"))
    return scored.select(
        "customer_unique_id",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "m_score",
        "f_score",
        rfm_segment("r_score", "m_score", "f_score").alias("segment"),
    )


def customer_satisfaction(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    orders = fct_orders.join(
        dim_customers.select("customer_key", "customer_unique_id", "customer_state", "customer_city"),
        "customer_key",
    )
    per_person = orders.groupBy("customer_unique_id").agg(
        F.max("customer_state").alias("customer_state"),
        F.max("customer_city").alias("customer_city"),
        F.countDistinct("order_id").alias("order_count"),
        round_scaled(F.sum("total_payment_value").cast("double"), 2).alias("total_spent"),
        round_scaled(F.avg("avg_review_score"), 2).alias("avg_review_score"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    )
    ranked = global_percent_rank(
        per_person, "total_spent", "pr", ascending=True, nulls_last=True, tie="customer_unique_id"
    )
    return ranked.select(
        "customer_unique_id",
        "customer_state",
        "customer_city",
        "order_count",
        "total_spent",
        "avg_review_score",
        round_scaled(F.col("pr"), 4).alias("spending_percentile"),
        F.year("last_purchase").cast("bigint").alias("order_year"),
        F.date_format("last_purchase", "MMMM").alias("order_month"),
    )


def category_satisfaction(fct_order_items: DataFrame, fct_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    items = fct_order_items.select("order_id", "product_key")
    orders = fct_orders.where(F.col("avg_review_score").isNotNull()).select("order_id", "avg_review_score")
    products = dim_products.select(
        "product_key",
        category_with_fallback("product_category_name_english", "product_category_name").alias("product_category"),
    )
    item_reviews = items.join(orders, "order_id").join(products, "product_key")
    return item_reviews.groupBy(
        "product_category",
        F.round(F.col("avg_review_score"), 0).cast("int").alias("review_score"),
    ).agg(F.count(F.lit(1)).alias("item_count"))


def seller_performance(fct_order_items: DataFrame, fct_orders: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Seller mart from stored facts, item-weighted.

    Aggregated on the fact's ``seller_key`` *before* the dimension lookup: the
    key is null exactly when the seller was missing from the dimension, so
    grouping on it yields the same single null group as grouping on the
    joined dimension columns, and the lookup then touches one row per seller
    instead of one per line.  The partial aggregate in front of the shuffle
    absorbs a seller that holds a large share of all lines.
    """
    items = fct_order_items.select(
        "order_id", "seller_key", "product_key", "price", "freight_value", "customer_seller_distance_km"
    )
    orders = fct_orders.select("order_id", "delivery_vs_estimate_days", "avg_review_score")
    # lines are partitioned by order, so this needs no exchange; one row a seller
    # and order is left, and no distinct count multiplies the lines
    items = items.withColumn("seller_key", packed_key("seller_key"))
    per_order = (
        items.groupBy("seller_key", "order_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("price").alias("price"),
            F.sum("freight_value").alias("freight"),
            F.sum("customer_seller_distance_km").alias("km"),
            F.count("customer_seller_distance_km").alias("routes"),
        )
        .join(orders, "order_id", "left")
    )
    volume = per_order.groupBy("seller_key").agg(*_seller_measures(F.count(F.lit(1)), F.col("km"), F.col("routes")))
    variety = (
        items.select("seller_key", packed_key("product_key").alias("product_key"))
        .distinct()
        .groupBy(F.col("seller_key").alias("_key"))
        .agg(F.count("product_key").alias("product_count"))
    )
    per_seller = volume.join(variety, F.col("seller_key").eqNullSafe(F.col("_key"))).drop("_key")
    per_seller = per_seller.withColumn("seller_key", unpacked_key("seller_key"))
    sellers = dim_sellers.select("seller_key", "seller_id", "seller_state")
    return per_seller.join(sellers, "seller_key", "left").select(*_SELLER_COLUMNS)


_SELLER_COLUMNS = (
    "seller_key",
    "seller_id",
    "seller_state",
    "item_count",
    "delivered_item_count",
    "order_count",
    "product_count",
    "total_revenue",
    "total_freight",
    "avg_review_score",
    "late_rate",
    "avg_distance_km",
)


def _seller_measures(orders: Column, km: Column, routes: Column) -> list[Column]:
    """The mart's measures over rows of ``lines``, ``price``, ``freight`` and
    the order's lateness and score; ``orders`` counts the orders."""
    d, score, lines = F.col("delivery_vs_estimate_days"), F.col("avg_review_score"), F.col("lines")
    delivered = F.coalesce(F.sum(F.when(d.isNotNull(), lines)), F.lit(0))
    late = F.coalesce(F.sum(F.when(d > 0, lines)), F.lit(0))
    return [
        F.sum("lines").alias("item_count"),
        delivered.alias("delivered_item_count"),
        orders.alias("order_count"),
        round_scaled(F.sum("price").cast("double"), 2).alias("total_revenue"),
        round_scaled(F.sum("freight").cast("double"), 2).alias("total_freight"),
        round_scaled(F.try_divide(F.sum(lines * score), F.sum(F.when(score.isNotNull(), lines))), 2).alias("avg_review_score"),
        round_scaled(F.try_divide(late, F.nullif(delivered, F.lit(0))), 4).alias("late_rate"),
        round_scaled(F.try_divide(F.sum(km), F.sum(routes)), 1).alias("avg_distance_km"),
    ]


def seller_performance_of_lines(
    stg_items: DataFrame,
    order_points: DataFrame,
    fct_orders: DataFrame,
    dim_sellers: DataFrame,
    seller_points: DataFrame,
    irregular_products: DataFrame,
    irregular_sellers: DataFrame,
) -> DataFrame:
    """The same mart without the line fact: no digest travels, and lines move to
    their orders and, one row a seller and order, to their sellers.

    ``seller_key`` is the seller's id until the last step, null where the seller
    is unknown.  An order or seller with several points has a row for each, of
    which the first counts the order.  What was joined at the sellers is grouped
    again in front of an exchange, so a seller with a large share of all lines
    may be met by several tasks.
    """
    lines = stg_items.select("order_id", "product_id", "seller_id", "price", "freight_value")
    lines = blank_unknown(look_up_known(lines, irregular_products, "product_id", "known"), irregular_sellers, "seller_id")
    lines = lines.withColumnRenamed("seller_id", "seller_key")
    placed = order_points.withColumn("at", F.row_number().over(Window.partitionBy("order_id").orderBy("c_lat", "c_lng")))
    per_order = (
        lines.join(placed, "order_id", "left")
        .groupBy("order_id", "seller_key", "at", "c_lat", "c_lng")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight"))
        .join(fct_orders.select("order_id", "delivery_vs_estimate_days", "avg_review_score"), "order_id", "left")
        .drop("order_id")
    )
    one_by_one = Window.partitionBy("seller_key").orderBy("s_lat", "s_lng")
    points = seller_points.select(F.col("seller_id").alias("seller_key"), "s_lat", "s_lng")
    met = look_up(per_order, points.withColumn("of", F.row_number().over(one_by_one)), "seller_key")
    km = haversine_km(F.col("c_lat"), F.col("c_lng"), F.col("s_lat"), F.col("s_lng"))
    met = met.withColumn("km", km).withColumn("seller_key", F.when(F.col("of").isNotNull(), F.col("seller_key")))
    first = (F.coalesce("at", F.lit(1)) == 1) & (F.coalesce("of", F.lit(1)) == 1)
    routes = F.when(F.col("km").isNotNull(), F.col("lines"))
    measures = _seller_measures(F.count_if(first), F.col("km") * F.col("lines"), routes)
    volume = met.groupBy("seller_key").agg(*measures)
    variety = (
        lines.select("seller_key", F.when(F.col("known"), F.col("product_id")).alias("product_id"))
        .distinct()
        .groupBy(F.col("seller_key").alias("_key"))
        .agg(F.count("product_id").alias("product_count"))
    )
    per_seller = volume.join(variety, F.col("seller_key").eqNullSafe(F.col("_key"))).drop("_key")
    sellers = dim_sellers.select(F.col("seller_id").alias("seller_key"), "seller_id", "seller_state")
    known = F.when(F.col("seller_key").isNotNull(), surrogate_key("seller_key")).alias("seller_key")
    return per_seller.join(sellers, "seller_key", "left").select(known, *_SELLER_COLUMNS[1:])

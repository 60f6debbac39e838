"""Intermediate relations: child tables reduced to order grain (or zip grain)
before they are joined, so the order fact never fans out.

Each is a single ``groupBy().agg()``: Spark runs a partial (map-side) hash
aggregate before the shuffle, so a hot ``order_id`` never reaches one task
with all of its rows.  Money sums are exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def int_order_items_aggregated(stg_items: DataFrame) -> DataFrame:
    return stg_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").cast("decimal(18,2)").alias("total_item_price"),
        F.sum("freight_value").cast("decimal(18,2)").alias("total_freight_value"),
    )


def int_order_payments_aggregated(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.groupBy("order_id").agg(
        F.sum("payment_value").cast("decimal(18,2)").alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def int_order_reviews_aggregated(stg_reviews: DataFrame) -> DataFrame:
    return stg_reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def int_geolocation_deduped(stg_geo: DataFrame) -> DataFrame:
    """One centroid per zip prefix.

    Degrees are summed as decimals with twelve places, so a centroid is the same
    to the last bit however the rows are partitioned; coordinates that are null
    or no finite number are left out."""

    def mean(degrees: str):
        fixed = F.col(degrees).try_cast("decimal(28,12)")
        return F.sum(fixed).cast("double") / F.nullif(F.count(fixed), F.lit(0))

    return stg_geo.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        mean("geolocation_lat").alias("latitude"),
        mean("geolocation_lng").alias("longitude"),
    )

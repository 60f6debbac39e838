"""Staging: one lazily evaluated relation per source, renamed and typed.

Pure projections — Catalyst collapses them into the scan, so they cost
nothing beyond the columns a later step actually reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        F.col("order_approved_at").alias("order_approved_timestamp"),
        F.col("order_delivered_carrier_date").alias("order_delivered_carrier_timestamp"),
        F.col("order_delivered_customer_date").alias("order_delivered_customer_timestamp"),
        F.col("order_estimated_delivery_date").cast("date").alias("order_estimated_delivery_date"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").alias("shipping_limit_timestamp"),
        "price",
        "freight_value",
    )


def stg_order_payments(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def stg_order_reviews(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        F.col("review_creation_date").alias("review_creation_timestamp"),
        "review_answer_timestamp",
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    return geolocation.select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    )


def stg_category_translation(translation: DataFrame) -> DataFrame:
    return translation.select("product_category_name", "product_category_name_english")

"""Dimensions: one row per business key with an md5 surrogate key (SCD type 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.semantics import surrogate_key


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_products(stg_products: DataFrame, stg_translation: DataFrame) -> DataFrame:
    """Products with the English category name.

    A plain left join: the optimizer (AQE) broadcasts the translation lookup
    when its runtime size is under the broadcast threshold and falls back to
    a shuffle join otherwise; no unchecked broadcast hint.
    """
    p = stg_products.alias("p")
    c = stg_translation.alias("c")
    return p.join(c, F.col("p.product_category_name") == F.col("c.product_category_name"), "left").select(
        surrogate_key(F.col("p.product_id")).alias("product_key"),
        F.col("p.product_id"),
        F.col("p.product_category_name"),
        F.col("c.product_category_name_english"),
        F.col("p.product_name_length"),
        F.col("p.product_description_length"),
        F.col("p.product_photos_qty"),
        F.col("p.product_weight_g"),
        F.col("p.product_length_cm"),
        F.col("p.product_height_cm"),
        F.col("p.product_width_cm"),
    )


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )

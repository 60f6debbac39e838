"""Pinned schemas of the nine raw extracts.

The original project let a CSV sniffer infer types.  We never infer: zip
prefixes must stay text (``01037`` is not 1037), money is exact decimal, and
timestamps carry no zone (``TIMESTAMP_NTZ``).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", S),
        ("customer_city", S),
        ("customer_state", S),
    ),
    "orders": _struct(
        ("order_id", S),
        ("customer_id", S),
        ("order_status", S),
        ("order_purchase_timestamp", TS),
        ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
    ),
    "order_items": _struct(
        ("order_id", S),
        ("order_item_id", L),
        ("product_id", S),
        ("seller_id", S),
        ("shipping_limit_date", TS),
        ("price", MONEY),
        ("freight_value", MONEY),
    ),
    "order_payments": _struct(
        ("order_id", S),
        ("payment_sequential", L),
        ("payment_type", S),
        ("payment_installments", L),
        ("payment_value", MONEY),
    ),
    "order_reviews": _struct(
        ("review_id", S),
        ("order_id", S),
        ("review_score", L),
        ("review_comment_title", S),
        ("review_comment_message", S),
        ("review_creation_date", TS),
        ("review_answer_timestamp", TS),
    ),
    "products": _struct(
        ("product_id", S),
        ("product_category_name", S),
        ("product_name_lenght", L),
        ("product_description_lenght", L),
        ("product_photos_qty", L),
        ("product_weight_g", L),
        ("product_length_cm", L),
        ("product_height_cm", L),
        ("product_width_cm", L),
    ),
    "sellers": _struct(
        ("seller_id", S),
        ("seller_zip_code_prefix", S),
        ("seller_city", S),
        ("seller_state", S),
    ),
    "geolocation": _struct(
        ("geolocation_zip_code_prefix", S),
        ("geolocation_lat", D),
        ("geolocation_lng", D),
        ("geolocation_city", S),
        ("geolocation_state", S),
    ),
    "product_category_translation": _struct(
        ("product_category_name", S),
        ("product_category_name_english", S),
    ),
}

SOURCE_NAMES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# --- fixed values: accepted codes --------------------------------------------
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
# ---------------------------------------------------------------------------

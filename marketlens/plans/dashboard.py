"""Dashboard questions.

The original dashboard file is not available, so the measure definitions
here are ours, chosen to agree with the analyses: revenue (GMV) is item
price without freight, late means delivered after the estimated date, and
rates are over delivered orders only.  Top-k lists break ties by the
business key.  ``purchase_window`` is the date-range filter shared by every
page: it restricts both facts to orders placed in ``[start, end)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.semantics import category_english_or_label, late_flag, pct, round_scaled
from marketlens.plans.analyses import exact_avg, seller_decile_totals
from marketlens.plans.quality import payment_reconciliation


def _late_or_null():
    d = F.col("delivery_vs_estimate_days")
    return F.when(d.isNotNull(), late_flag(d))


def headline_kpis(w) -> DataFrame:
    return w.fct_orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("delivery_vs_estimate_days").alias("delivered_orders"),
        round_scaled(F.sum("total_item_price").cast("double"), 0).alias("gmv"),
        round_scaled(F.avg("avg_review_score"), 2).alias("avg_review"),
        round_scaled(F.lit(100.0) * F.avg(_late_or_null()), 1).alias("pct_late"),
        round_scaled(F.lit(100.0) * F.avg(1 - _late_or_null()), 1).alias("pct_on_time"),
    )


def monthly_revenue_and_review(w) -> DataFrame:
    return w.fct_orders.groupBy(F.trunc("order_purchase_timestamp", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        round_scaled(F.sum("total_item_price").cast("double"), 2).alias("revenue"),
        round_scaled(F.avg("avg_review_score"), 2).alias("avg_review"),
    ).orderBy("month")


def top_sellers(w, n: int = 10, measure: str = "revenue") -> DataFrame:
    col = {"revenue": "total_revenue", "orders": "order_count"}[measure]
    sp = w.seller_performance.select("seller_id", "seller_state", "total_revenue", "order_count", "item_count")
    return sp.orderBy(F.col(col).desc_nulls_last(), F.col("seller_id").asc()).limit(n)


def top_categories(w, n: int = 10, measure: str = "revenue") -> DataFrame:
    oi = w.fct_order_items.select("order_id", "product_key", "price")
    p = w.dim_products.select("product_key", "product_category_name_english")
    g = (
        oi.join(p, "product_key")
        .groupBy(category_english_or_label("product_category_name_english").alias("category"))
        .agg(
            round_scaled(F.sum("price").cast("double"), 2).alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
        )
    )
    return g.orderBy(F.col(measure).desc_nulls_last(), F.col("category").asc()).limit(n)


def delivery_status_split(w) -> DataFrame:
    fo = w.fct_orders
    g = fo.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("delivery_vs_estimate_days").alias("delivered_orders"),
        F.count_if(F.col("delivery_vs_estimate_days") > 0).alias("late_orders"),
    )
    total = F.sum("orders").over(Window.partitionBy(F.lit(1)))  # one row a status
    delivered = F.nullif(F.col("delivered_orders"), F.lit(0))
    return g.select(
        "order_status",
        "orders",
        round_scaled(pct(F.col("orders"), total), 1).alias("pct_orders"),
        "delivered_orders",
        "late_orders",
        round_scaled(pct(F.col("late_orders"), delivered), 1).alias("pct_late"),
        round_scaled(pct(F.col("delivered_orders") - F.col("late_orders"), delivered), 1).alias("pct_on_time"),
    )


def late_rate_by_state(w) -> DataFrame:
    fo = w.fct_orders.where(F.col("delivery_vs_estimate_days").isNotNull()).select(
        "customer_key", "delivery_vs_estimate_days"
    )
    c = w.dim_customers.select("customer_key", "customer_state")
    return (
        fo.join(c, "customer_key")
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            round_scaled(F.lit(100.0) * F.avg(late_flag("delivery_vs_estimate_days")), 1).alias("pct_late"),
        )
    )


def category_review_mix(w) -> DataFrame:
    cs = w.category_satisfaction
    per_category = Window.partitionBy("product_category")
    return cs.select(
        "product_category",
        "review_score",
        "item_count",
        round_scaled(pct(F.col("item_count"), F.sum("item_count").over(per_category)), 1).alias("pct_of_category"),
    )


def high_spend_low_satisfaction(w, min_percentile: float = 0.9, max_review: float = 2.0) -> DataFrame:
    cs = w.customer_satisfaction
    return cs.where(
        (F.col("spending_percentile") >= min_percentile) & (F.col("avg_review_score") <= max_review)
    ).select("customer_unique_id", "customer_state", "total_spent", "avg_review_score", "spending_percentile")


def recency_spend_landscape(w) -> DataFrame:
    rfm = w.customer_rfm
    return rfm.groupBy("r_score", "m_score").agg(
        F.count(F.lit(1)).alias("customers"),
        round_scaled(F.avg(F.col("recency_days").cast("double")), 1).alias("avg_recency_days"),
        round_scaled(exact_avg("monetary", 2), 2).alias("avg_monetary"),
    )


def payment_mismatch_summary(w) -> DataFrame:
    rec = payment_reconciliation(w.fct_orders)
    return rec.groupBy(
        F.when(F.col("difference") > 0, F.lit("over")).otherwise(F.lit("under")).alias("direction")
    ).agg(
        F.count(F.lit(1)).alias("orders"),
        round_scaled(exact_avg("difference", 2), 2).alias("mean_difference"),
    )


def categories_to_reach_share(w, share_pct: int = 80) -> DataFrame:
    oi = w.fct_order_items.select("product_key", "price")
    p = w.dim_products.select("product_key", "product_category_name_english")
    rev = (
        oi.join(p, "product_key")
        .groupBy(category_english_or_label("product_category_name_english").alias("category"))
        .agg(F.sum("price").alias("rev"))
    )
    # one row a category: the windows run over the aggregated frame
    whole, order = Window.partitionBy(F.lit(1)), [F.col("rev").desc(), F.col("category").asc()]
    ranked = rev.select(
        F.row_number().over(whole.orderBy(*order)).cast("bigint").alias("rank"),
        F.count(F.lit(1)).over(whole).alias("n_categories"),
        F.sum("rev").over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias("cum_rev"),
        F.sum("rev").over(whole).alias("total_rev"),
    )
    reached = F.col("cum_rev") * 100 >= F.col("total_rev") * share_pct
    return ranked.agg(
        F.min(F.when(reached, F.col("rank"))).alias("categories_needed"),
        F.max("n_categories").alias("total_categories"),
    ).select("categories_needed", "total_categories", F.lit(share_pct).alias("share_pct"))


def bottom_half_seller_share(w) -> DataFrame:
    """Sellers in revenue deciles 6-10 and their share of revenue."""
    d = seller_decile_totals(w)
    bottom = F.col("decile") > 5
    return d.agg(
        F.sum(F.when(bottom, F.col("sellers"))).cast("bigint").alias("sellers"),
        round_scaled(pct(F.sum(F.when(bottom, F.col("rev"))), F.sum("rev")), 1).alias("pct_revenue"),
    )


def purchase_window(w, start: str, end: str):
    """A ``Warehouse`` whose facts keep only orders placed in [start, end).

    On stored marts both facts are partitioned by purchase month; the
    matching month predicate is added so the scans read only the months in
    the window (``PartitionFilters``), then the exact timestamp filter
    applies (to lines by a semi join with the orders).
    """
    from marketlens.plans.pipeline import PARTITION_COLUMN, Warehouse

    ts = F.col("order_purchase_timestamp")
    in_window = (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    m = F.col(PARTITION_COLUMN)
    months = (m >= F.trunc(F.lit(start).cast("date"), "month")) & (m <= F.lit(end).cast("date"))

    def fact(name):
        raw = w._partitioned.get(name)
        return w.relation(name) if raw is None else raw.where(months).drop(PARTITION_COLUMN)

    fo = fact("fct_orders").where(in_window)
    foi = fact("fct_order_items").join(fo.select("order_id"), "order_id", "left_semi")
    # Keep stored dimensions; every mart is rebuilt from the filtered facts.
    stored = {k: v for k, v in w._stored.items() if k.startswith("dim_")}
    stored.update({"fct_orders": fo, "fct_order_items": foi})
    return Warehouse(w.spark, w.sources, stored)

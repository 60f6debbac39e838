"""The seventeen business questions, each a function of the ``Warehouse``.

Conventions (shared with the SQL twins in ``duckdb_twins``):

* percentages are ``100.0 * part / whole`` in double, then ``round_scaled``;
* money totals are summed as exact decimals and turned into double at the
  edge; averages of already-rounded doubles go through ``exact_avg`` (exact
  decimal sum divided by the count), so the answer does not depend on the
  order in which a distributed sum visits the rows;
* grand totals are scalar subqueries, never a window over the whole input;
  windows appear only over frames of at most a handful of band rows;
* ties in rankings are broken by the business key;
* each question ends with the ordering the original statement asks for
  (a sort of at most a few dozen band rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import bands
from marketlens.functions.semantics import category_english_or_label, late_flag, pct, round_scaled
from marketlens.operators.ranking import global_ntile, rank_frame

# --- fixed values: the four categories of the category-controlled view -------
DEFAULT_CONTROL_CATEGORIES = ("bed_bath_table", "health_beauty", "sports_leisure", "computers_accessories")
# ---------------------------------------------------------------------------

_N = "__n"


def exact_avg(c: Column | str, scale: int) -> Column:
    """Average of values that carry at most ``scale`` decimals: exact decimal
    sum converted to double, divided by the non-null count."""
    col = F.col(c) if isinstance(c, str) else c
    total = F.sum(col.cast(f"decimal(30,{scale})")).cast("double")
    return F.try_divide(total, F.count(col).cast("double"))


def _share_of_total(grouped: DataFrame, measure: str) -> Column:
    """Grand total of ``measure`` over a grouped frame as a scalar subquery."""
    return grouped.agg(F.sum(measure)).scalar()


# -- customer segmentation ---------------------------------------------------
def frequency_distribution(w) -> DataFrame:
    # Frequency and the set of persons are fixed before the quintile scoring,
    # so this reads the unscored per-person frame.
    g = w.customer_rfm_base.groupBy("frequency").agg(F.count(F.lit(1)).alias("customers"))
    total = _share_of_total(g, "customers")
    return g.select("frequency", "customers", round_scaled(pct(F.col("customers"), total), 1).alias("pct")).orderBy(
        "frequency"
    )


def segment_sizes(w) -> DataFrame:
    g = w.customer_rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    total = _share_of_total(g, "customers")
    return g.select(
        "segment", "customers", round_scaled(pct(F.col("customers"), total), 1).alias("pct_customers")
    ).orderBy(F.col("customers").desc())


def segment_revenue(w) -> DataFrame:
    g = w.customer_rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("monetary").cast("decimal(18,2)")).alias("rev"),
    )
    n_total = _share_of_total(g, "customers")
    rev_total = _share_of_total(g, "rev")
    return g.select(
        "segment",
        "customers",
        round_scaled(pct(F.col("customers"), n_total), 1).alias("pct_customers"),
        round_scaled(F.col("rev").cast("double"), 0).alias("revenue"),
        round_scaled(pct(F.col("rev"), rev_total), 1).alias("pct_revenue"),
    ).orderBy(F.col("revenue").desc())


# -- delivery impact on reviews ------------------------------------------------
def _reviewed_delivered(fo: DataFrame) -> DataFrame:
    return fo.where(F.col("avg_review_score").isNotNull() & F.col("delivery_vs_estimate_days").isNotNull())


def review_by_delivery_bucket(w) -> DataFrame:
    fo = _reviewed_delivered(w.fct_orders)
    return fo.groupBy(bands.delivery_bucket("delivery_vs_estimate_days").alias("delivery_bucket")).agg(
        F.count(F.lit(1)).alias("orders"),
        round_scaled(F.avg("avg_review_score"), 2).alias("avg_score"),
    ).orderBy("delivery_bucket")


def _items_orders(w) -> DataFrame:
    """Lines with their order's lateness and score; the stored facts are
    bucketed alike by ``order_id``, so there they meet without an exchange."""
    oi = w.items_by_order.select("order_id", "product_key", "seller_key", "customer_seller_distance_km")
    o = w.fct_orders.select("order_id", "delivery_vs_estimate_days", "avg_review_score")
    return oi.join(o, "order_id")


def _by_product(w, lines: DataFrame, *keys: Column) -> DataFrame:
    """Lines counted per product (and ``keys``), then given the product's
    columns: only the counts move to the products, not the lines."""
    counted = lines.groupBy("product_key", *keys).agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("avg_review_score").alias("score_sum"),
        F.sum(late_flag("delivery_vs_estimate_days")).alias("late"),
    )
    p = w.dim_products.select("product_key", "product_category_name_english", "product_weight_g")
    return counted.join(p, "product_key")


def _score_of_products(df: DataFrame, *keys: Column) -> DataFrame:
    out = df.groupBy(*keys).agg(
        F.sum("items").cast("bigint").alias("items"),
        round_scaled(F.try_divide(F.sum("score_sum"), F.sum("items").cast("double")), 2).alias("avg_score"),
    )
    return out.orderBy(*out.columns[: len(keys)])


def _pct_late_of_products() -> Column:
    rate = F.try_divide(F.sum("late").cast("double"), F.sum("items").cast("double"))
    return round_scaled(F.lit(100.0) * rate, 1).alias("pct_late")


def _score_by(df: DataFrame, *keys: Column) -> DataFrame:
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"),
        round_scaled(F.avg("avg_review_score"), 2).alias("avg_score"),
    )
    return out.orderBy(*out.columns[: len(keys)])


def review_by_category_and_lateness(w, categories: tuple[str, ...] = DEFAULT_CONTROL_CATEGORIES) -> DataFrame:
    bucket = bands.late_bucket("delivery_vs_estimate_days").alias("bucket")
    df = _by_product(w, _reviewed_delivered(_items_orders(w)), bucket).where(
        F.col("product_category_name_english").isin(list(categories))
    )
    return _score_of_products(df, F.col("product_category_name_english").alias("category"), F.col("bucket"))


def review_by_weight_and_lateness(w) -> DataFrame:
    bucket = bands.late_bucket("delivery_vs_estimate_days").alias("bucket")
    df = _by_product(w, _reviewed_delivered(_items_orders(w)), bucket).where(F.col("product_weight_g").isNotNull())
    return _score_of_products(df, bands.weight_band_3("product_weight_g").alias("weight_band"), F.col("bucket"))


def review_by_distance_and_lateness(w) -> DataFrame:
    df = _reviewed_delivered(_items_orders(w)).where(F.col("customer_seller_distance_km").isNotNull())
    return _score_by(
        df,
        bands.distance_band("customer_seller_distance_km").alias("distance_band"),
        bands.late_bucket("delivery_vs_estimate_days").alias("bucket"),
    )


# -- drivers of lateness -------------------------------------------------------
def _pct_late() -> Column:
    return round_scaled(F.lit(100.0) * F.avg(late_flag("delivery_vs_estimate_days")), 1).alias("pct_late")


def late_rate_by_distance(w) -> DataFrame:
    df = _items_orders(w).where(
        F.col("delivery_vs_estimate_days").isNotNull() & F.col("customer_seller_distance_km").isNotNull()
    )
    return df.groupBy(bands.distance_band("customer_seller_distance_km").alias("distance_band")).agg(
        F.count(F.lit(1)).alias("items"),
        round_scaled(F.avg("customer_seller_distance_km"), 0).alias("avg_km"),
        _pct_late(),
    ).orderBy("distance_band")


def late_rate_by_weight(w) -> DataFrame:
    lines = _items_orders(w).where(F.col("delivery_vs_estimate_days").isNotNull())
    df = _by_product(w, lines).where(F.col("product_weight_g").isNotNull())
    return (
        df.groupBy(bands.weight_band_4("product_weight_g").alias("weight_band"))
        .agg(F.sum("items").cast("bigint").alias("items"), _pct_late_of_products())
        .orderBy("weight_band")
    )


def late_rate_by_category(w, min_items: int = 1000) -> DataFrame:
    lines = _items_orders(w).where(F.col("delivery_vs_estimate_days").isNotNull())
    df = _by_product(w, lines).where(F.col("product_category_name_english").isNotNull())
    g = df.groupBy(F.col("product_category_name_english").alias("category")).agg(
        F.sum("items").cast("bigint").alias("items"), _pct_late_of_products()
    )
    return g.where(F.col("items") >= min_items).orderBy(F.col("pct_late").desc())


def seller_late_bands_from_facts(w, min_items: int = 20) -> DataFrame:
    df = _items_orders(w).where(F.col("delivery_vs_estimate_days").isNotNull())
    stats = (
        df.groupBy("seller_key")
        .agg(F.count(F.lit(1)).alias("items"), F.avg(late_flag("delivery_vs_estimate_days")).alias("late_rate"))
        .where(F.col("items") >= min_items)
    )
    return (
        stats.groupBy(bands.seller_late_band("late_rate").alias("seller_late_band"))
        .agg(F.count(F.lit(1)).alias("sellers"), F.sum("items").cast("bigint").alias("items"))
        .orderBy("seller_late_band")
    )


def late_rate_by_month(w) -> DataFrame:
    fo = w.fct_orders.where(F.col("delivery_vs_estimate_days").isNotNull())
    return (
        fo.groupBy(F.trunc("order_purchase_timestamp", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), _pct_late())
        .orderBy("month")
    )


# -- revenue concentration -----------------------------------------------------
def category_revenue_top15(w, top: int = 15) -> DataFrame:
    oi = w.fct_order_items.select("product_key", "price")
    p = w.dim_products.select("product_key", "product_category_name_english")
    rev = (
        oi.join(p, "product_key")
        .groupBy(category_english_or_label("product_category_name_english").alias("category"))
        .agg(F.sum("price").alias("rev"))
    )
    # only the leading rows are ranked; the total comes from the aggregated frame
    whole = Window.partitionBy(F.lit(1))
    order = [F.col("rev").desc(), F.col("category").asc()]
    leading = rev.withColumn("total_rev", F.sum("rev").over(whole)).orderBy(*order).limit(top)
    ranked = leading.select(
        "*",
        F.row_number().over(whole.orderBy(*order)).cast("bigint").alias("category_rank"),
        F.sum("rev").over(whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias("cum_rev"),
    )
    out = ranked.select(
        "category_rank",
        "category",
        round_scaled(F.col("rev").cast("double"), 0).alias("revenue"),
        round_scaled(pct(F.col("rev"), F.col("total_rev")), 1).alias("pct_revenue"),
        round_scaled(pct(F.col("cum_rev"), F.col("total_rev")), 1).alias("cum_pct_revenue"),
    )
    return out.orderBy("category_rank").limit(top)


def seller_decile_totals(w) -> DataFrame:
    """Sellers and exact revenue per revenue decile (NTILE(10), top first)."""
    sp = w.seller_performance.select("seller_key", "total_revenue")
    ranked = global_ntile(sp, 10, [F.col("total_revenue").desc_nulls_last(), F.col("seller_key").asc()], "decile")
    return ranked.groupBy("decile").agg(
        F.count(F.lit(1)).alias("sellers"),
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).alias("rev"),
    )


def seller_revenue_deciles(w) -> DataFrame:
    by_decile = seller_decile_totals(w)
    # At most ten rows: windows over this frame are bounded by construction.
    total = F.sum("rev").over(Window.partitionBy(F.lit(1)))
    running = F.sum("rev").over(Window.orderBy("decile"))
    return by_decile.select(
        "decile",
        "sellers",
        round_scaled(F.col("rev").cast("double"), 0).alias("revenue"),
        round_scaled(pct(F.col("rev"), total), 1).alias("pct_revenue"),
        round_scaled(pct(running, total), 1).alias("cum_pct_revenue"),
    ).orderBy("decile")


# -- seller performance ----------------------------------------------------------
def seller_pareto_bands(w) -> DataFrame:
    sp = w.seller_performance.select("seller_key", "total_revenue")
    ranked = rank_frame(
        sp,
        [F.col("total_revenue").desc_nulls_last(), F.col("seller_key").asc()],
        row_number="seller_rank",
        total=_N,
    )
    g = ranked.groupBy(bands.pareto_band("seller_rank", _N).alias("seller_band")).agg(
        F.count(F.lit(1)).alias("sellers"),
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).alias("rev"),
    )
    total = _share_of_total(g, "rev")
    return g.select(
        "seller_band",
        "sellers",
        round_scaled(F.col("rev").cast("double"), 0).alias("revenue"),
        round_scaled(pct(F.col("rev"), total), 1).alias("pct_revenue"),
    ).orderBy("seller_band")


def seller_quality_by_volume(w) -> DataFrame:
    sp = w.seller_performance
    return sp.groupBy(bands.volume_band("item_count").alias("volume_band")).agg(
        F.count(F.lit(1)).alias("sellers"),
        F.sum("item_count").cast("bigint").alias("items"),
        round_scaled(exact_avg("avg_review_score", 2), 2).alias("avg_review"),
        round_scaled(F.lit(100.0) * exact_avg("late_rate", 4), 1).alias("avg_late_pct"),
    ).orderBy("volume_band")


def seller_late_bands_from_mart(w, min_items: int = 20) -> DataFrame:
    sp = w.seller_performance.where(F.col("late_rate").isNotNull() & (F.col("delivered_item_count") >= min_items))
    return (
        sp.groupBy(bands.seller_late_band("late_rate").alias("seller_late_band"))
        .agg(
            F.count(F.lit(1)).alias("sellers"),
            F.sum("delivered_item_count").cast("bigint").alias("items"),
        )
        .orderBy("seller_late_band")
    )

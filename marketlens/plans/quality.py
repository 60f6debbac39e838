"""The declared data-quality suite and the reconciliation monitor.

``CHECKS`` lists the 78 generic checks declared on the models (plus one
relationship the export consumer relies on but nobody declared); the
singular payment reconciliation is ``payment_reconciliation`` with severity
``warn``.  ``dq_report`` evaluates everything into one DataFrame
``(table_name, check_name, column_name, severity, violations)``;
``assert_checks`` raises only for ``error`` rows, mirroring warn-vs-error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.bands import SEGMENTS
from marketlens.operators.checks import Check, fused_report, relationship_report
from marketlens.sources.schemas import ORDER_STATUSES, PAYMENT_TYPES

SCORES = (1, 2, 3, 4, 5)


def _u(model, col):
    return [Check(model, "unique", (col,)), Check(model, "not_null", (col,))]


def _nn(model, *cols):
    return [Check(model, "not_null", (c,)) for c in cols]


CHECKS: list[Check] = [
    # staging
    *_u("stg_orders", "order_id"),
    Check("stg_orders", "accepted_values", ("order_status",), values=ORDER_STATUSES),
    *_u("stg_customers", "customer_id"),
    *_nn("stg_customers", "customer_unique_id"),
    *_u("stg_sellers", "seller_id"),
    *_u("stg_products", "product_id"),
    Check("stg_order_items", "unique_combination", ("order_id", "order_item_id")),
    *_nn("stg_order_items", "order_id", "order_item_id", "product_id", "seller_id"),
    Check("stg_order_payments", "unique_combination", ("order_id", "payment_sequential")),
    *_nn("stg_order_payments", "order_id", "payment_sequential"),
    Check("stg_order_payments", "accepted_values", ("payment_type",), values=PAYMENT_TYPES),
    Check("stg_order_reviews", "unique_combination", ("review_id", "order_id")),
    *_nn("stg_order_reviews", "review_id", "order_id"),
    Check("stg_order_reviews", "accepted_values", ("review_score",), values=SCORES),
    *_nn("stg_geolocation", "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    *_u("stg_category_translation", "product_category_name"),
    # intermediate
    *_u("int_order_items_aggregated", "order_id"),
    *_u("int_order_payments_aggregated", "order_id"),
    *_u("int_order_reviews_aggregated", "order_id"),
    *_u("int_geolocation_deduped", "zip_code_prefix"),
    # marts
    *_u("dim_products", "product_key"),
    *_u("dim_products", "product_id"),
    *_u("dim_sellers", "seller_key"),
    *_u("dim_sellers", "seller_id"),
    *_u("dim_customers", "customer_key"),
    *_u("dim_customers", "customer_id"),
    *_nn("dim_customers", "customer_unique_id"),
    *_u("fct_order_items", "order_item_key"),
    *_nn("fct_order_items", "order_id", "order_item_id"),
    Check("fct_order_items", "relationships", ("product_key",), to_model="dim_products", to_column="product_key"),
    Check("fct_order_items", "relationships", ("seller_key",), to_model="dim_sellers", to_column="seller_key"),
    Check("fct_order_items", "accepted_range", ("customer_seller_distance_km",), min_value=0),
    *_u("fct_orders", "order_key"),
    *_u("fct_orders", "order_id"),
    Check("fct_orders", "relationships", ("customer_key",), to_model="dim_customers", to_column="customer_key"),
    *_u("customer_rfm", "customer_unique_id"),
    Check("customer_rfm", "accepted_values", ("r_score",), values=SCORES),
    Check("customer_rfm", "accepted_values", ("m_score",), values=SCORES),
    Check("customer_rfm", "accepted_values", ("f_score",), values=(1, 3, 5)),
    Check("customer_rfm", "accepted_values", ("segment",), values=SEGMENTS),
    *_u("seller_performance", "seller_key"),
    *_nn("seller_performance", "seller_id"),
    Check("seller_performance", "accepted_range", ("late_rate",), min_value=0, max_value=1),
    *_u("customer_satisfaction", "customer_unique_id"),
    Check("customer_satisfaction", "accepted_range", ("spending_percentile",), min_value=0, max_value=1),
    Check("category_satisfaction", "unique_combination", ("product_category", "review_score")),
    *_nn("category_satisfaction", "product_category", "review_score"),
    Check("category_satisfaction", "accepted_values", ("review_score",), values=SCORES),
    # undeclared but relied upon by the export consumer: line -> order
    Check("fct_order_items", "relationships", ("order_id",), to_model="fct_orders", to_column="order_id", origin="added"),
]

DECLARED_CHECK_COUNT = sum(1 for c in CHECKS if c.origin == "declared")  # 78, plus 1 singular = 79


def payment_reconciliation(fct_orders: DataFrame) -> DataFrame:
    """Orders whose payments differ from items + freight by more than one cent.

    Compared in exact decimals: a gap of exactly 0.01 is not flagged.
    """
    expected = (F.col("total_item_price") + F.col("total_freight_value")).cast("decimal(18,2)")
    diff = (F.col("total_payment_value") - expected).cast("decimal(18,2)")
    return fct_orders.where(
        F.col("total_payment_value").isNotNull()
        & F.col("total_item_price").isNotNull()
        & F.col("total_freight_value").isNotNull()
        & (F.abs(diff) > F.lit(0.01).cast("decimal(18,2)"))
    ).select("order_id", "total_payment_value", expected.alias("expected_value"), diff.alias("difference"))


# marts whose checks would each group all lines again: written once before them,
# the first before the facts (it moves less than from facts that do not lie by order)
_WRITTEN_BEFORE_FACTS, _WRITTEN_FIRST = "seller_performance", "category_satisfaction"


def dq_report(w, checks: list[Check] | None = None, materialize_models: bool = True) -> DataFrame:
    """All checks as one report.

    By default the two facts — the deepest lineage, read by the fact checks,
    the relationship checks and every aggregate mart — are first written
    once, so no check pass re-derives a fact from the sources.  Staging,
    intermediate and dimension relations are one scan plus one projection or
    aggregate away from the sources; the ranking marts already read their
    ranked tables from the checkpoint folder; re-reading those per fused
    pass is cheaper than writing them again.

    The checks run here, one relation after the other, and their few report rows
    are written under the checkpoint folder: the executors' disks hold the
    shuffles of one relation at a time, and all else that was written for the
    checks goes when they have run.
    """
    from marketlens.plans.pipeline import Warehouse, materialize
    from marketlens.session import checkpoint_root, clear_scratch, scratch_mark, shuffles_go, track_scratch

    checks = CHECKS if checks is None else checks
    spark = w.spark
    root = track_scratch(spark, f"{checkpoint_root(spark)}/checks-{uuid.uuid4().hex}")
    written: list[str] = []

    def run(parts: list[DataFrame]) -> None:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        written.append(f"{root}/{len(written):03d}")
        with shuffles_go(spark):
            out.write.parquet(written[-1])

    def of(model: str):
        """The warehouse as given, so that what a model writes is of this run."""
        names = [model] if model == _WRITTEN_FIRST and materialize_models else []
        return materialize(w, names) if names else Warehouse(spark, w.sources, w._stored, w._partitioned)

    mark = scratch_mark(spark)
    try:
        if materialize_models:
            if _WRITTEN_BEFORE_FACTS in {c.model for c in checks}:
                w = materialize(w, [_WRITTEN_BEFORE_FACTS])
            w = materialize(w, ["fct_orders", "fct_order_items"])
        by_model: dict[str, list[Check]] = {}
        for c in checks:
            if c.kind == "relationships":
                given = of("")
                run([relationship_report(given.relation(c.model), given.relation(c.to_model), c)])
            else:
                by_model.setdefault(c.model, []).append(c)
        for model, cs in by_model.items():
            own = scratch_mark(spark)
            run(fused_report(of(model).relation(model), cs))
            clear_scratch(spark, own)
        recon = payment_reconciliation(of("fct_orders").fct_orders)
        run([
            recon.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
                F.lit("fct_orders").alias("table_name"),
                F.lit("assert_payment_matches_order_value").alias("check_name"),
                F.lit("total_payment_value").alias("column_name"),
                F.lit("warn").alias("severity"),
                "violations",
            )
        ])
    finally:
        clear_scratch(spark, mark)
    return spark.read.parquet(*written)


def failing_checks(report: DataFrame) -> list:
    """Error-severity checks with violations (a handful of report rows)."""
    return report.where((F.col("severity") == "error") & (F.col("violations") > 0)).collect()


class DataQualityError(RuntimeError):
    pass


def assert_checks(report: DataFrame) -> list:
    """Raise if any error-severity check fails; return the warn rows that
    have violations (they are reported, never fatal)."""
    found = report.where(F.col("violations") > 0).collect()  # at most one row a check
    failed = [r for r in found if r.severity == "error"]
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failed]
        raise DataQualityError("failing checks:\n" + "\n".join(lines))
    return [r for r in found if r.severity == "warn"]

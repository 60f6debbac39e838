"""The model graph as one lazy object.

``Warehouse`` holds the nine source DataFrames and exposes every staging,
intermediate, dimension, fact and mart relation as a lazily built DataFrame
(``functools.cached_property`` caches the *plan*, not the data).  Asking for
an analysis therefore produces one Catalyst plan that spans the whole
upstream chain, the same way views are inlined into a query.

For production runs, ``write_marts`` materialises the marts as Parquet (the
"table" materialisation, versioned: ``sources.mart_store``) and
``Warehouse.from_marts`` reads the newest version back, so analyses start from
stored marts instead of recomputing the facts.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.skew_join import irregular_keys
from marketlens.plans import dims, facts, intermediate, marts, staging
from marketlens.session import checkpoint_root, clear_scratch, scratch_mark, settings, shuffles_go, track_scratch
from marketlens.sources.readers import SourceConfig, read_sources
from marketlens.sources.testbed import testbed_sources

# --- fixed values: mart export list, dimensions first ------------------------
MART_NAMES = (
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "fct_orders",
    "fct_order_items",
    "customer_rfm",
    "customer_satisfaction",
    "category_satisfaction",
    "seller_performance",
)
# ---------------------------------------------------------------------------

# Both stored facts are partitioned by this derived column (purchase month of
# the order), so date-window questions prune whole directories at the scan.
PARTITION_COLUMN = "purchase_month"
PARTITIONED_MARTS = ("fct_orders", "fct_order_items")
# ... and bucketed alike by their common key, so they meet without an exchange.
BUCKET_COLUMN = "order_id"

# Every relation of the model graph in dependency order.
MODEL_ORDER = (
    "stg_customers",
    "stg_orders",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_products",
    "stg_sellers",
    "stg_geolocation",
    "stg_category_translation",
    "int_order_items_aggregated",
    "int_order_payments_aggregated",
    "int_order_reviews_aggregated",
    "int_geolocation_deduped",
    *MART_NAMES,
)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        sources: dict[str, DataFrame] | None = None,
        stored: dict | None = None,
        partitioned: dict | None = None,
    ):
        self.spark = spark
        self.sources = sources or {}
        self._stored: dict[str, DataFrame] = dict(stored or {})
        # stored tables that still carry their partition column (for pruning)
        self._partitioned: dict[str, DataFrame] = dict(partitioned or {})

    # -- constructors ------------------------------------------------------
    @classmethod
    def from_testbed(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        return cls(spark, testbed_sources(spark, sf_dir))

    @classmethod
    def from_files(cls, spark: SparkSession, cfg: SourceConfig) -> "Warehouse":
        return cls(spark, read_sources(spark, cfg))

    @classmethod
    def from_marts(
        cls, spark: SparkSession, mart_dir: str, sources: dict[str, DataFrame] | None = None, version: int | None = None
    ) -> "Warehouse":
        """The published marts under ``mart_dir``: the newest version, or the given one."""
        from marketlens.sources.mart_store import MartStore

        store = MartStore(spark, mart_dir)
        manifest = store.manifest(version)  # one manifest for all tables
        stored, partitioned = {}, {}
        for m in MART_NAMES:
            df = store.read(m, manifest)
            if manifest["marts"][m]["partition_by"]:
                partitioned[m] = df
                df = df.drop(PARTITION_COLUMN)
            stored[m] = df
        return cls(spark, sources, stored, partitioned)

    def _mart(self, name: str, build) -> DataFrame:
        if name in self._stored:
            return self._stored[name]
        return build()

    # -- staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return self._mart("stg_customers", lambda: staging.stg_customers(self.sources["customers"]))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._mart("stg_orders", lambda: staging.stg_orders(self.sources["orders"]))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return self._mart("stg_order_items", lambda: staging.stg_order_items(self.sources["order_items"]))

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return self._mart("stg_order_payments", lambda: staging.stg_order_payments(self.sources["order_payments"]))

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return self._mart("stg_order_reviews", lambda: staging.stg_order_reviews(self.sources["order_reviews"]))

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._mart("stg_products", lambda: staging.stg_products(self.sources["products"]))

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return self._mart("stg_sellers", lambda: staging.stg_sellers(self.sources["sellers"]))

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return self._mart("stg_geolocation", lambda: staging.stg_geolocation(self.sources["geolocation"]))

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return self._mart("stg_category_translation", lambda: staging.stg_category_translation(self.sources["product_category_translation"]))

    # -- intermediate ------------------------------------------------------
    @cached_property
    def int_order_items_aggregated(self) -> DataFrame:
        return self._mart("int_order_items_aggregated", lambda: intermediate.int_order_items_aggregated(self.stg_order_items))

    @cached_property
    def int_order_payments_aggregated(self) -> DataFrame:
        return self._mart("int_order_payments_aggregated", lambda: intermediate.int_order_payments_aggregated(self.stg_order_payments))

    @cached_property
    def int_order_reviews_aggregated(self) -> DataFrame:
        return self._mart("int_order_reviews_aggregated", lambda: intermediate.int_order_reviews_aggregated(self.stg_order_reviews))

    @cached_property
    def int_geolocation_deduped(self) -> DataFrame:
        return self._mart("int_geolocation_deduped", lambda: intermediate.int_geolocation_deduped(self.stg_geolocation))

    # -- dimensions and facts ------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._mart("dim_customers", lambda: dims.dim_customers(self.stg_customers))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._mart(
            "dim_products", lambda: dims.dim_products(self.stg_products, self.stg_category_translation)
        )

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return self._mart("dim_sellers", lambda: dims.dim_sellers(self.stg_sellers))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._mart("fct_orders", self._build_orders)

    def _build_orders(self, buckets: int | None = None, **looked_up: DataFrame) -> DataFrame:
        return facts.fct_orders(
            self.stg_orders,
            self.dim_customers,
            self.int_order_items_aggregated,
            self.int_order_payments_aggregated,
            self.int_order_reviews_aggregated,
            buckets=buckets,
            **looked_up,
        )

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return self._mart("fct_order_items", self._build_order_items)

    @cached_property
    def items_by_order(self) -> DataFrame:
        """The line fact for joins and groups by order: as stored, else built so
        that it ends partitioned on ``order_id``."""
        return self._mart("fct_order_items", lambda: self._build_order_items(by_order=True))

    def _build_order_items(
        self, month: str | None = None, buckets: int | None = None, by_order: bool = False, parts: int | None = None, **looked_up: DataFrame
    ) -> DataFrame:
        return facts.fct_order_items(
            self.stg_order_items,
            self.dim_products,
            self.dim_sellers,
            self.stg_orders,
            self.dim_customers,
            self.int_geolocation_deduped,
            month=month,
            buckets=buckets,
            by_order=by_order,
            parts=parts,
            **looked_up,
        )

    def with_month(self, name: str, buckets: int | None = None, parts: int | None = None) -> DataFrame:
        """A fact with the purchase month of the order, built from the sources;
        with ``buckets`` in that many partitions by order (``parts``: the shuffle
        partitions of the write, by default as many).  Then the ids that its
        dimension has not exactly once are listed first (one job, kept as a
        table, whose size Spark knows)."""
        if name == "fct_orders":
            odd = {"irregular_customers": self._irregular(self.stg_orders, self.dim_customers, "customer_id")} if buckets else {}
            orders = self._build_orders(buckets, **odd)
            return orders.select("*", F.trunc("order_purchase_timestamp", "month").alias(PARTITION_COLUMN))
        odd = {"irregular_products": self._irregular(self.stg_order_items, self.dim_products, "product_id")} if buckets else {}
        return self._build_order_items(month=PARTITION_COLUMN, buckets=buckets, parts=parts, **odd)

    def _irregular(self, rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
        path = track_scratch(self.spark, f"{checkpoint_root(self.spark)}/irregular-{uuid.uuid4().hex[:12]}")
        with shuffles_go(self.spark):
            irregular_keys(rows, table, key).write.parquet(path)
        return self.spark.read.parquet(path)

    # -- marts -------------------------------------------------------------
    @cached_property
    def customer_rfm(self) -> DataFrame:
        return self._mart("customer_rfm", lambda: marts.customer_rfm(self.fct_orders, self.dim_customers))

    @cached_property
    def customer_rfm_base(self) -> DataFrame:
        """Per-person frequency and spend before scoring (the stored mart when
        there is one).  Questions that need neither the scores nor the
        segment read this and skip the two global rankings."""
        if "customer_rfm" in self._stored:
            return self._stored["customer_rfm"]
        return marts.customer_rfm_base(self.fct_orders, self.dim_customers)

    @cached_property
    def customer_satisfaction(self) -> DataFrame:
        return self._mart(
            "customer_satisfaction", lambda: marts.customer_satisfaction(self.fct_orders, self.dim_customers)
        )

    @cached_property
    def category_satisfaction(self) -> DataFrame:
        return self._mart(
            "category_satisfaction",
            lambda: marts.category_satisfaction(self.items_by_order, self.fct_orders, self.dim_products),
        )

    @cached_property
    def seller_performance(self) -> DataFrame:
        return self._mart("seller_performance", self._build_sellers)

    def _build_sellers(self) -> DataFrame:
        """From the line fact where it is given (it may hold a part of the lines
        only), else from the lines; then two jobs list the irregular ids first."""
        if "fct_order_items" in self._stored:
            return marts.seller_performance(self.items_by_order, self.fct_orders, self.dim_sellers)
        return marts.seller_performance_of_lines(
            self.stg_order_items,
            facts.order_points(self.stg_orders, self.dim_customers, self.int_geolocation_deduped),
            self.fct_orders,
            self.dim_sellers,
            facts.seller_points(self.dim_sellers, self.int_geolocation_deduped),
            self._irregular(self.stg_order_items, self.dim_products, "product_id"),
            self._irregular(self.stg_order_items, self.dim_sellers, "seller_id"),
        )

    def relation(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self, names=None) -> list[str]:
        """Register relations as session temp views under their model names,
        so existing analysis SQL runs unchanged through ``spark.sql``.  Views
        stay lazy, except that the ranking marts (``customer_rfm``,
        ``customer_satisfaction``) run their ranking builds on registration."""
        names = list(MODEL_ORDER if names is None else names)
        for name in names:
            self.relation(name).createOrReplaceTempView(name)
        return names


def write_marts(w: Warehouse, mart_dir: str) -> dict[str, int]:
    """Materialise every mart as Parquet under ``mart_dir`` (full refresh).

    Marts are written in dependency order and each later mart is built from
    the already written ones, so lineage is cut at every table and a lost
    executor only costs the table being written.  The new version is published
    when all marts are written; a refresh that fails leaves the marts as they
    were (``sources.mart_store``).  Returns row counts.

    The facts are stored by purchase month and bucketed by ``order_id``.  Lines
    take the month of their order; lines without an order, or whose order has no
    purchase time, have none.

    On the executors' disks lie at any time the shuffles of one mart; what a
    mart needed besides (ranked tables, lists of ids) goes once it is written.
    """
    from marketlens.sources.mart_store import Build, MartStore, bucket_count

    stored: dict[str, DataFrame] = {}
    with Build(MartStore(w.spark, mart_dir)) as build:
        for name in MART_NAMES:
            current, mark = Warehouse(w.spark, w.sources, stored), scratch_mark(w.spark)
            if name in PARTITIONED_MARTS:
                buckets, parts = bucket_count(w.spark), int(w.spark.conf.get("spark.sql.shuffle.partitions"))
                # all exchanges by order deal out into the buckets, so the rows need
                # no further one; buckets that are few for such joins get them last
                parts = buckets if 8 * buckets > parts else parts
                dealt = current.with_month(name, buckets, parts)
                with settings(w.spark, spark__sql__shuffle__partitions=str(parts), **facts.STORED):
                    df = build.write(name, dealt, PARTITION_COLUMN, BUCKET_COLUMN, buckets)
                stored[name] = df.drop(PARTITION_COLUMN)
            else:
                stored[name] = build.write(name, current.relation(name))
            clear_scratch(w.spark, mark)
    return {name: entry["rows"] for name, entry in build.marts.items()}


def materialize(w: Warehouse, names=None, root: str | None = None) -> Warehouse:
    """Write the named relations (default: the whole graph) once, in
    dependency order, as Parquet tables under the session's checkpoint
    directory, and return a ``Warehouse`` that reads them.

    Each table is built from the already written ones, so every relation is
    computed exactly once and lineage is cut at every table; later readers
    get column pruning and predicate pushdown on the stored Parquet.
    """
    from marketlens.sources.mart_store import CODEC

    wanted = set(MODEL_ORDER if names is None else names)
    base = root or track_scratch(w.spark, f"{checkpoint_root(w.spark)}/marketlens-tables-{uuid.uuid4().hex[:12]}")
    stored: dict[str, DataFrame] = dict(w._stored)
    for name in MODEL_ORDER:
        if name not in wanted or name in stored:
            continue
        current = Warehouse(w.spark, w.sources, stored)
        path = f"{base}/{name}"
        if name in PARTITIONED_MARTS:  # as they are stored: the fewest exchanges
            buckets = int(w.spark.conf.get("spark.sql.shuffle.partitions"))
            df = current.with_month(name, buckets).drop(PARTITION_COLUMN)
        else:
            df = current.relation(name)
        with shuffles_go(w.spark), settings(w.spark, **facts.STORED):
            df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        stored[name] = w.spark.read.parquet(path)
    return Warehouse(w.spark, w.sources, stored)


def build(w: Warehouse, mart_dir: str, export_dir: str | None = None, fmt: str = "parquet") -> dict:
    """The whole run in one call: write the marts (full refresh), run the
    check suite against the stored marts (raising on error-severity
    failures, returning the warn rows), and optionally export the marts.
    """
    from marketlens.plans.quality import assert_checks, dq_report
    from marketlens.sources.sinks import export_marts

    mark = scratch_mark(w.spark)
    counts = write_marts(w, mart_dir)
    stored = Warehouse.from_marts(w.spark, mart_dir, sources=w.sources)
    warnings = assert_checks(dq_report(stored, materialize_models=False))
    exported = export_marts(stored, export_dir, fmt=fmt, log=None) if export_dir else {}
    clear_scratch(w.spark, mark)  # the run's own intermediate tables; the marts are stored by now
    return {"marts": counts, "warnings": [r.asDict() for r in warnings], "exported": exported}

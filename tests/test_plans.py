"""Physical-plan properties that matter at scale."""


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_fact_stays_in_jvm(warehouse):
    plan = _plan(warehouse.fct_order_items)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(warehouse):
    df = warehouse.fct_orders.select("order_id", "delivery_vs_estimate_days")
    text = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read for the item aggregate: only the needed columns appear
    assert "l_returnflag" not in text and "l_quantity" not in text


def test_global_marts_have_no_single_partition_exchange_over_people(warehouse):
    """Only aggregated rows may meet in one partition: per-range counts,
    partial totals or band rows -- never person- or seller-grain rows."""
    from marketlens.plans import analyses as A

    frames = {
        "customer_rfm": warehouse.customer_rfm,
        "customer_satisfaction": warehouse.customer_satisfaction,
        "seller_revenue_deciles": A.seller_revenue_deciles(warehouse),
        "segment_revenue": A.segment_revenue(warehouse),
    }
    for name, df in frames.items():
        lines = _plan(df).splitlines()
        singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
        for i in singles:
            j = i + 1
            while "+- Project" in lines[j] or "+- Filter" in lines[j]:
                j += 1
            assert "HashAggregate" in lines[j], (name, lines[i], lines[j])


def test_seller_mart_aggregates_before_dimension_lookup(warehouse):
    df = warehouse.seller_performance
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # the Aggregate appears below (before) the final join to dim_sellers
    agg_at = text.find("Aggregate [seller_key")
    assert agg_at > text.find("Join LeftOuter")


def test_analyses_return_the_stated_order(warehouse):
    from marketlens.plans import analyses as A

    months = [r.month for r in A.late_rate_by_month(warehouse).collect()]
    assert months == sorted(months)
    sizes = [r.customers for r in A.segment_sizes(warehouse).collect()]
    assert sizes == sorted(sizes, reverse=True)
    keys = [(r.weight_band, r.bucket) for r in A.review_by_weight_and_lateness(warehouse).collect()]
    assert keys == sorted(keys)
    deciles = [r.decile for r in A.seller_revenue_deciles(warehouse).collect()]
    assert deciles == list(range(1, 11))


def test_nothing_is_broadcast_without_size_evidence(warehouse):
    """With the size-based broadcast thresholds disabled (what a large
    cluster sees when no dimension is small), the item fact has no broadcast."""
    spark = warehouse.spark
    keys_conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys_conf}
    try:
        for k in keys_conf:
            spark.conf.set(k, "-1")
        # a new DataFrame so planning happens under these settings
        plan = _plan(warehouse.fct_order_items.select("*"))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan
    assert "SortMergeJoin [product_id" in plan and "SortMergeJoin [seller_id" in plan


def test_building_the_item_fact_starts_no_job(spark):
    from marketlens.plans.pipeline import Warehouse

    tracker = spark.sparkContext.statusTracker()
    w = Warehouse.from_testbed(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("plan-only", "no job expected")
    w.fct_order_items  # noqa: B018
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setJobGroup("", "")


def test_item_fact_moves_its_lines_only_for_the_lookups(spark, warehouse):
    """The lines are partitioned by order once, for their numbers and the join
    with the orders, and then by product and by seller."""
    from marketlens.plans.pipeline import Warehouse

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(Warehouse(spark, warehouse.sources).fct_order_items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = [x[: x.index("Exchange")] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    above_window = [x for x in plan[: plan.index("Window")].splitlines() if "Exchange hashpartitioning" in x]
    assert len(above_window) == 2 and len(lines) > 2
    assert "hashpartitioning(product_id" in "".join(above_window) and "hashpartitioning(seller_id" in "".join(above_window)

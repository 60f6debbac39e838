"""CSV reading with pinned schemas, and export round trips."""

import os

from marketlens.sources.readers import SourceConfig, read_source
from marketlens.sources.sinks import export_marts, read_export


def test_csv_keeps_zip_text_and_multiline_quotes(spark, scratch):
    cfg = SourceConfig(root=scratch, fmt="csv", multiline=frozenset({"customers"}))
    with open(cfg.path("customers"), "w") as f:
        f.write("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n")
        f.write('c1,u1,01037,"sao ""paulo""",SP\n')
        f.write('c2,u2,14409,"franca\nsecond line",SP\n')
        f.write("c3,u3,,,\n")
    rows = read_source(spark, "customers", cfg).orderBy("customer_id").collect()
    assert len(rows) == 3
    assert rows[0].customer_zip_code_prefix == "01037"
    assert rows[0].customer_city == 'sao "paulo"'
    assert rows[1].customer_city == "franca\nsecond line"
    assert rows[2].customer_zip_code_prefix is None


def test_translation_path_override():
    cfg = SourceConfig(root="/data", fmt="csv")
    assert cfg.path("orders") == "/data/orders.csv"
    assert cfg.path("product_category_translation") == "/data/product_category_name_translation.csv"
    prefixed = SourceConfig(root="/data", fmt="csv", template="{root}/x_{name}_dataset.{ext}")
    assert prefixed.path("order_items") == "/data/x_order_items_dataset.csv"


def test_export_both_formats_round_trip(warehouse, scratch):
    marts = ("dim_sellers", "fct_orders", "category_satisfaction")
    counts = export_marts(warehouse, scratch, fmt="both", marts=marts, log=None)
    for name in marts:
        original = warehouse.relation(name)
        n = original.count()
        assert counts["parquet"][name] == n and counts["csv"][name] == n
        pq = read_export(warehouse.spark, scratch, name, "parquet")
        assert [(f.name, f.dataType) for f in pq.schema] == [(f.name, f.dataType) for f in original.schema]
        assert pq.exceptAll(original).count() == 0 and original.exceptAll(pq).count() == 0
        csv = read_export(warehouse.spark, scratch, name, "csv", schema=original.schema)
        assert csv.exceptAll(original).count() == 0 and original.exceptAll(csv).count() == 0
        assert os.path.isdir(os.path.join(scratch, f"{name}.csv"))


def test_stored_marts_prune_months_and_match_lazy(warehouse, scratch):
    from marketlens.plans.dashboard import headline_kpis, purchase_window, top_categories
    from marketlens.plans.pipeline import Warehouse, write_marts

    counts = write_marts(warehouse, scratch)
    stored = Warehouse.from_marts(warehouse.spark, scratch)
    for name in ("fct_orders", "fct_order_items"):
        assert counts[name] == warehouse.relation(name).count()
        assert stored.relation(name).columns == warehouse.relation(name).columns
    assert stored.fct_order_items.exceptAll(warehouse.fct_order_items).count() == 0
    lazy = purchase_window(warehouse, "1997-01-01", "1999-01-01")
    pruned = purchase_window(stored, "1997-01-01", "1999-01-01")
    plan = pruned.fct_orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "GreaterThanOrEqual(order_purchase_timestamp" in pushed.split("]")[0]
    lines = pruned.fct_order_items._jdf.queryExecution().executedPlan().toString()
    assert lines.count("PartitionFilters: [isnotnull(purchase_month") == 2
    assert headline_kpis(pruned).collect() == headline_kpis(lazy).collect()
    assert top_categories(pruned).collect() == top_categories(lazy).collect()
    assert stored.customer_rfm.exceptAll(warehouse.customer_rfm).count() == 0


def test_csv_extract_end_to_end(warehouse, scratch):
    """Nine CSV extracts -> pinned-schema reader -> the same marts."""
    from marketlens.plans.pipeline import Warehouse
    from marketlens.sources.readers import SourceConfig
    from marketlens.sources.schemas import SOURCE_NAMES

    cfg = SourceConfig(root=scratch, fmt="csv")
    for name in SOURCE_NAMES:
        (
            warehouse.sources[name]
            .coalesce(2)
            .write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(cfg.path(name))
        )
    from_csv = Warehouse.from_files(warehouse.spark, cfg)
    for name in SOURCE_NAMES:
        types = lambda df: [(f.name, f.dataType) for f in df.schema]
        assert types(from_csv.sources[name]) == types(warehouse.sources[name])
    for rel in ("fct_orders", "fct_order_items", "seller_performance", "customer_rfm"):
        a, b = from_csv.relation(rel), warehouse.relation(rel)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, rel


def test_build_runs_marts_checks_and_export(warehouse, scratch):
    from marketlens.plans.pipeline import MART_NAMES, Warehouse, build

    from marketlens.session import scratch_mark

    before = scratch_mark(warehouse.spark)
    out = build(warehouse, f"{scratch}/marts", export_dir=f"{scratch}/exports", fmt="csv")
    assert set(out["marts"]) == set(MART_NAMES)
    assert [w["check_name"] for w in out["warnings"]] == ["assert_payment_matches_order_value"]
    assert out["exported"]["csv"]["fct_orders"] == out["marts"]["fct_orders"]
    assert scratch_mark(warehouse.spark) == before  # its intermediate tables are gone
    assert Warehouse.from_marts(warehouse.spark, f"{scratch}/marts").customer_rfm.count() == out["marts"]["customer_rfm"]


def test_parquet_extract_end_to_end(warehouse, scratch):
    """Nine Parquet extracts -> pinned-schema reader -> the same marts."""
    from marketlens.plans.pipeline import Warehouse
    from marketlens.sources.readers import SourceConfig
    from marketlens.sources.schemas import SOURCE_NAMES

    cfg = SourceConfig(root=scratch, fmt="parquet")
    for name in SOURCE_NAMES:
        warehouse.sources[name].write.mode("overwrite").parquet(cfg.path(name))
    from_pq = Warehouse.from_files(warehouse.spark, cfg)
    for rel in ("fct_orders", "category_satisfaction", "seller_performance"):
        a, b = from_pq.relation(rel), warehouse.relation(rel)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, rel


def test_registered_views_run_analysis_sql(warehouse):
    from marketlens.plans import analyses as A

    warehouse.register_views(["fct_orders", "fct_order_items", "dim_products"])
    sql = warehouse.spark.sql(
        """
        select cast(date_trunc('month', o.order_purchase_timestamp) as date) as month,
               count(*) as orders,
               round(100.0 * avg(case when o.delivery_vs_estimate_days <= 0 then 0 else 1 end), 1) as pct_late
        from fct_orders o
        where o.delivery_vs_estimate_days is not null
        group by 1
        """
    )
    got = sorted(tuple(r) for r in sql.collect())
    assert got == sorted(tuple(r) for r in A.late_rate_by_month(warehouse).collect())


def test_csv_keeps_fractions_of_a_second(spark, scratch):
    import datetime as dt

    from marketlens.sources.sinks import read_export, write_table

    times = [dt.datetime(2020, 1, 2, 10, 0, 0, 123456), dt.datetime(2020, 1, 2, 10, 0, 0), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp_ntz")
    assert write_table(df, f"{scratch}/x.csv", "csv") == 3
    back = read_export(spark, scratch, "x", "csv", df.schema)
    assert sorted((r.i, r.t) for r in back.collect() if r.t) == list(enumerate(times))[:2]


def test_large_csv_is_split_but_reviews_keep_line_breaks(spark, warehouse, scratch):
    from marketlens.sources.readers import SourceConfig, read_source

    cfg = SourceConfig(root=scratch, fmt="csv")
    warehouse.sources["order_items"].coalesce(1).write.option("header", True).csv(cfg.path("order_items"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        items = read_source(spark, "order_items", cfg)
        assert items.rdd.getNumPartitions() > 1 and items.count() == warehouse.sources["order_items"].count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    header = warehouse.sources["order_reviews"].columns
    with open(cfg.path("order_reviews"), "w") as f:
        f.write(",".join(header) + "\n" + 'r1,o1,5,"title","one\ntwo ""quoted""",2020-01-01 00:00:00,2020-01-02 00:00:00.5\n')
    (row,) = read_source(spark, "order_reviews", cfg).collect()
    assert row.review_comment_message == 'one\ntwo "quoted"' and row.review_answer_timestamp.microsecond == 500000


def test_stored_facts_have_one_file_a_bucket_and_month(spark, warehouse, scratch):
    from marketlens.plans.pipeline import write_marts
    from marketlens.sources.mart_store import BUCKETS_CONF, MartStore

    settings = {"spark.sql.shuffle.partitions": "32", BUCKETS_CONF: "2"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        write_marts(warehouse, scratch)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name in ("fct_orders", "fct_order_items"):
        stored = MartStore(spark, scratch).read(name)
        months = stored.select("purchase_month").distinct().count()
        assert len(stored.inputFiles()) <= 2 * months


def test_export_is_provable(spark, scratch):
    """Odd texts, types and nulls come back from CSV as they were, with the
    types of the schema file; any change is noticed."""
    import datetime as dt
    from decimal import Decimal

    import pytest

    from marketlens.sources.sinks import ExportMismatch, export_entry, read_export, verify_export, write_table

    rows = [
        (1, " a ", 0.1, Decimal("1.10"), dt.datetime(2020, 1, 2, 3, 4, 5, 600), dt.date(2020, 1, 2)),
        (2, "", 1e-300, Decimal("-2.00"), None, None),
        (3, None, None, None, dt.datetime(1970, 1, 1), dt.date(1, 1, 1)),
        (4, 'x "y", \\ z', -0.0, Decimal("0.00"), None, None),
        (5, "two\nlines\r\n", 1 / 3, None, None, None),
        (5, "two\nlines\r\n", 1 / 3, None, None, None),
    ]
    df = spark.createDataFrame(rows, "i long, t string, d double, m decimal(18,2), ts timestamp_ntz, day date").repartition(3)
    for fmt in ("parquet", "csv"):
        assert write_table(df, f"{scratch}/odd.{fmt}", fmt) == 6 == verify_export(spark, scratch, "odd", fmt)
        back = read_export(spark, scratch, "odd", fmt)
        assert back.dtypes == df.dtypes
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    entries = [export_entry(spark, scratch, "odd", f) for f in ("parquet", "csv")]
    assert entries[0] == entries[1] and entries[0]["line_breaks"]
    # the same number of rows and keys, one value changed
    wrong = df.selectExpr("i", "t", "if(i = 2, 2e-300, d) as d", "m", "ts", "day")
    path = f"{scratch}/odd.csv"
    note = export_entry(spark, scratch, "odd", "csv")
    write_table(wrong, path, "csv")
    from marketlens.sources import sinks

    import json

    sinks._write_text(spark, f"{path}.schema.json", json.dumps(note))
    with pytest.raises(ExportMismatch, match="d differ"):
        verify_export(spark, scratch, "odd", "csv")
    sinks._write_text(spark, f"{path}.schema.json", json.dumps(note | {"schema": df.selectExpr("i", "cast(t as long) t", "d", "m", "ts", "day").schema.jsonValue()}))
    with pytest.raises(Exception):  # a text where the schema says number
        read_export(spark, scratch, "odd", "csv").collect()
    with pytest.raises(ExportMismatch, match="no schema file"):
        verify_export(spark, scratch, "nothing", "csv")

"""What lies on the executors' disks while tables are written."""

import datetime as dt
from collections import Counter

import pytest

from marketlens.operators.skew_join import irregular_keys, look_up_known
from marketlens.plans import facts
from marketlens.plans.pipeline import PARTITION_COLUMN, Warehouse, write_marts
from marketlens.session import settings

NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(found.size()) if (f := found.apply(i).getName()).startswith("shuffle_")}


@pytest.fixture(scope="module")
def odd(spark):
    """Relations in which ids are missing, unknown, and there more than once."""
    t = lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d)
    orders = [(f"o{i}", f"c{i}", "delivered", t(i), t(i), t(i), t(i + i % 7) if i % 5 else None, (t(i) + dt.timedelta(3)).date()) for i in range(20)]
    orders += [orders[3], orders[3], ("o20", None, "shipped", None, None, None, None, None), ("o21", "none", "shipped", t(1), None, None, None, None)]
    customers = [(f"k{i}", f"c{i}", f"u{i % 9}", f"z{i % 4}", "city", "state") for i in range(19)] + [("k4", "c4", "u4", "z2", "city", "state")]
    lines = [(f"o{i % 23}", i, f"p{i % 11}", f"s{i % 13}", t(i), i % 17, i % 3) for i in range(200)]
    lines += [(None, 1, "p1", "s1", t(0), 5, 1), (None, 2, "p2", "none", t(0), 5, 1), ("o1", 900, None, None, t(0), 5, 1), ("o1", 901, "none", "s2", t(0), 7, 1), ("o1", 902, "none", None, t(0), 7, 1)]
    products = [(f"k{i}", f"p{i}", "c", "c", i) for i in range(10)] + [("k3", "p3", "c", "c", 3)]
    sellers = [(f"k{i}", f"s{i}", f"z{i % 5}", "city", f"state{i}") for i in range(12)] + [("k5", "s5", "z1", "city", "state5"), ("k6", "s6", "z1", "city", "state6")]
    geo = [(f"z{i}", float(i), float(i) * 2) for i in range(4)]
    reviews = [(f"o{i}", 1.0 + i % 5, 1) for i in range(0, 20, 2)]
    rows = {
        "stg_orders": (orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_timestamp timestamp_ntz, order_delivered_carrier_timestamp timestamp_ntz, order_delivered_customer_timestamp timestamp_ntz, order_estimated_delivery_date date"),
        "dim_customers": (customers, "customer_key string, customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"),
        "dim_products": (products, "product_key string, product_id string, product_category_name string, product_category_name_english string, product_weight_g bigint"),
        "dim_sellers": (sellers, "seller_key string, seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"),
        "int_geolocation_deduped": (geo, "zip_code_prefix string, latitude double, longitude double"),
        "int_order_reviews_aggregated": (reviews, "order_id string, avg_review_score double, review_count bigint"),
    }
    stored = {k: spark.createDataFrame(v, schema) for k, (v, schema) in rows.items()}
    from pyspark.sql import functions as F

    items = spark.createDataFrame(lines, "order_id string, order_item_id bigint, product_id string, seller_id string, shipping_limit_timestamp timestamp_ntz, price int, freight_value int")
    stored["stg_order_items"] = items.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")})
    for key, part in (("dim_products", "product"), ("dim_sellers", "seller"), ("dim_customers", "customer")):
        stored[key] = stored[key].withColumn(f"{part}_key", F.md5(f"{part}_id"))
    payments = "order_id string, total_payment_value decimal(18,2), payment_count bigint"
    stored["int_order_payments_aggregated"] = spark.createDataFrame([], payments)
    return stored


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("conf", [{}, NO_BROADCAST, NO_BROADCAST | {"spark__sql__adaptive__enabled": "false"}], ids=["small", "joins", "salted"])
@pytest.mark.parametrize("name", ["fct_orders", "fct_order_items"])
def test_stored_facts_have_the_rows_of_the_plain_joins(spark, odd, name, conf):
    with settings(spark, **conf):
        plain = counted(Warehouse(spark, None, odd).relation(name))
        dealt = Warehouse(spark, None, odd).with_month(name, 3).drop(PARTITION_COLUMN)
        with settings(spark, spark__sql__shuffle__partitions="3", **facts.STORED):
            assert counted(dealt) == plain and sum(plain.values()) > 20


def test_stored_lines_move_once(spark, warehouse):
    """For their numbers, into the buckets; only pairs of ids move besides.  No
    table but the list of irregular ids is small here."""
    with settings(spark, **{k: "2k" for k in NO_BROADCAST}):
        dealt = Warehouse(spark, warehouse.sources).with_month("fct_order_items", 3)
        with settings(spark, spark__sql__shuffle__partitions="3", spark__sql__adaptive__enabled="false", **facts.STORED):
            plan = dealt._jdf.queryExecution().executedPlan().toString()
    above_window = plan[: plan.index("Window")]
    assert "Exchange hashpartitioning" not in above_window and "hashpartitioning(order_id" in plan


def test_shuffles_go_with_the_write(spark, warehouse, scratch):
    before = shuffle_files(spark)
    write_marts(warehouse, scratch)
    assert not {f for f in shuffle_files(spark) - before if f.endswith(".data")}


def test_irregular_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("x", 4), (None, 5)], "k string, n int")
    table = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), (None,)], "k string")
    odd = irregular_keys(rows, table, "k")
    assert counted(odd) == Counter({("b", 2): 1, ("x", 0): 1})
    known = counted(look_up_known(rows, odd, "k", "known"))
    assert known == Counter({("a", 1, True): 1, ("b", 2, True): 2, ("b", 3, True): 2, ("x", 4, None): 1, (None, 5, None): 1})


def test_seller_mart_of_lines_equals_that_of_the_line_fact(spark, odd):
    from marketlens.plans import marts

    w = Warehouse(spark, None, odd)
    plain = counted(marts.seller_performance(w.items_by_order, w.fct_orders, w.dim_sellers))
    assert counted(w.seller_performance) == plain and None in {r[0] for r in plain}


def test_seller_mart_moves_no_digests(spark, warehouse):
    """Lines go to their orders, their sellers and the count of products."""
    with settings(spark, **{k: "2k" for k in NO_BROADCAST}):
        plan = Warehouse(spark, warehouse.sources).seller_performance._jdf.queryExecution().executedPlan().toString()
    assert "md5(" in plan and plan.rindex("md5(") < plan.index("Exchange")
    assert "unhex" not in plan and "hashpartitioning(product_id" not in plan


def test_checks_leave_only_their_report(spark, warehouse):
    """Facts, marts and shuffles that the checks needed are gone when they have run."""
    import glob

    from marketlens.plans.quality import dq_report
    from marketlens.session import checkpoint_root

    folder = checkpoint_root(spark).removeprefix("file:")
    before, shuffled = set(glob.glob(f"{folder}/*")), shuffle_files(spark)
    report = dq_report(warehouse)
    left = set(glob.glob(f"{folder}/*")) - before
    assert [f.split("/")[-1].split("-")[0] for f in left] == ["checks"]
    assert not {f for f in shuffle_files(spark) - shuffled if f.endswith(".data")}
    assert report.count() == 80


def test_checks_leave_the_callers_marts(spark, warehouse):
    from marketlens.plans.quality import CHECKS, dq_report

    w = Warehouse(spark, warehouse.sources)
    n = w.customer_rfm.count()
    assert dq_report(w, [c for c in CHECKS if c.model == "customer_rfm"], materialize_models=False).count() > 0
    assert w.customer_rfm.count() == n


def test_exports_read_each_mart_back_before_the_next(spark, monkeypatch):
    """All marts in both formats, whole; no more than one mart's copies at a time."""
    import glob

    import __spark_entry__ as entry
    from marketlens.plans.pipeline import MART_NAMES
    from marketlens.session import checkpoint_root
    from marketlens.sources import sinks

    folder, seen, write = checkpoint_root(spark).removeprefix("file:"), [], sinks.write_table

    def watched(df, path, *args):
        n = write(df, path, *args)
        seen.append({f.split("/")[-1].split(".")[0] for f in glob.glob(f"{folder}/export-*/*.*") if not f.endswith(".json")})
        return n

    monkeypatch.setattr(sinks, "write_table", watched)
    rows = entry.queries()["mart_export_report"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.mart, r.format) for r in rows} == {(m, f) for m in MART_NAMES for f in sinks.FORMATS} and len(rows) == 2 * len(MART_NAMES)
    assert all(r.n_rows > 0 and r.n_keys > 0 for r in rows)
    assert seen == [{m} for m in MART_NAMES for _ in sinks.FORMATS]
    assert not glob.glob(f"{folder}/export-*/*.csv") + glob.glob(f"{folder}/export-*/*.parquet/_SUCCESS")


def test_compressed_csv_comes_back(spark, scratch):
    import glob

    from marketlens.sources.sinks import verify_export, write_table

    df = spark.createDataFrame([(1, " a "), (2, ""), (3, None), (4, "two\nlines")], "i long, t string")
    assert write_table(df, f"{scratch}/odd.csv", "csv", compression="gzip") == 4 == verify_export(spark, scratch, "odd", "csv")
    assert glob.glob(f"{scratch}/odd.csv/*.csv.gz")
    write_table(df, f"{scratch}/plain.csv", "csv")
    assert glob.glob(f"{scratch}/plain.csv/*.csv") and not glob.glob(f"{scratch}/plain.csv/*.gz")


def test_seller_mart_follows_a_fact_that_is_given(spark, odd):
    """A warehouse may be given a part of the lines (a purchase window)."""
    whole = Warehouse(spark, None, odd)
    part = whole.fct_order_items.where("order_id in ('o1', 'o2')")
    windowed = Warehouse(spark, None, odd | {"fct_order_items": part})
    n = sum(r.item_count for r in windowed.seller_performance.dropDuplicates(["seller_key"]).collect())
    assert n == part.count() < whole.fct_order_items.count()

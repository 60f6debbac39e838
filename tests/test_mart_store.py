"""Versioned, bucketed marts."""

import pytest

from marketlens.plans import analyses as A
from marketlens.plans.pipeline import MART_NAMES, Warehouse, write_marts
from marketlens.sources import mart_store
from marketlens.sources.mart_store import Build, MartStore, NoPublishedMarts

LATENESS = (
    A.review_by_category_and_lateness,
    A.review_by_weight_and_lateness,
    A.review_by_distance_and_lateness,
    A.late_rate_by_distance,
    A.late_rate_by_weight,
    A.late_rate_by_category,
    A.seller_late_bands_from_facts,
)


@pytest.fixture(scope="module")
def root(warehouse, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    write_marts(warehouse, root)
    return root


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("question", LATENESS, ids=lambda f: f.__name__)
def test_stored_facts_meet_without_an_exchange(spark, warehouse, root, question):
    """Both facts are read by buckets and joined where they lie, also in a
    session that did not write them."""
    args = (("economy", "large", "medium", "promo"),) if question is A.review_by_category_and_lateness else ()
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    other.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    df = question(Warehouse.from_marts(other, root), *args)
    plan = plan_of(df)
    assert "SortMergeJoin [order_id" in plan and "hashpartitioning(order_id" not in plan
    assert plan.count("Bucketed: true") == 2
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in question(warehouse, *args).collect()]


def test_tables_are_registered_again_from_their_location(spark, root):
    """After the catalog has forgotten them: schema, rows, buckets and months."""
    store = MartStore(spark, root)
    manifest = store.manifest()
    before = store.read("fct_order_items", manifest)
    schema, rows = before.schema, before.count()
    name = mart_store._table_name(f"{store.root}/{manifest['build']}/fct_order_items")
    spark.sql(f"DROP TABLE {name}")
    again = store.read("fct_order_items", manifest)
    assert again.schema == schema and again.count() == rows == manifest["marts"]["fct_order_items"]["rows"]
    months = again.select("purchase_month").distinct().count()
    assert len(again.inputFiles()) <= months * manifest["marts"]["fct_order_items"]["buckets"]


def test_failed_refresh_leaves_the_marts(spark, warehouse, scratch, monkeypatch):
    counts = write_marts(warehouse, scratch)
    rows = sorted(Warehouse.from_marts(spark, scratch).dim_sellers.collect())
    write = Build.write

    def breaks(self, name, *args):
        if name == "customer_satisfaction":
            raise RuntimeError("lost")
        return write(self, name, *args)

    monkeypatch.setattr(Build, "write", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        write_marts(warehouse, scratch)
    store = MartStore(spark, scratch)
    assert store.versions() == [1]
    stored = Warehouse.from_marts(spark, scratch)
    assert {m: stored.relation(m).count() for m in MART_NAMES} == counts
    assert sorted(stored.dim_sellers.collect()) == rows
    builds = store._fs.listStatus(store._path(f"{scratch}/builds"))
    assert len(builds) == 1  # what the failed one wrote is gone


def test_versions_are_kept_and_forgotten(spark, scratch):
    store = MartStore(spark, scratch)
    with pytest.raises(NoPublishedMarts):
        store.manifest()
    for i in range(4):
        with Build(store) as build:
            build.write("a", spark.range(i), None, None)
            build.write("b", spark.range(10).selectExpr("id", "id % 3 as part"), "part", "id")
        assert build.version == i + 1
    assert store.versions() == [3, 4]
    assert [store.read("a", store.manifest(v)).count() for v in (3, 4)] == [2, 3]
    assert store.read("b").columns == ["id", "part"] and store.read("b").where("part = 1").count() == 3
    with pytest.raises(NoPublishedMarts):
        store.manifest(1)


def test_two_builds_at_once_get_two_versions(spark, scratch):
    store = MartStore(spark, scratch)
    first, second = Build(store), Build(store)
    first.write("a", spark.range(1))
    second.write("a", spark.range(2))
    number = store.versions  # both see no version yet
    store.versions = lambda: []
    try:
        assert (store.publish(first), store.publish(second)) == (1, 2)
    finally:
        store.versions = number
    assert store.read("a").count() == 2


def test_facts_make_their_keys_after_the_last_exchange(warehouse):
    """What is dealt out to the buckets and looked up carries no digests."""
    for name in ("fct_orders", "fct_order_items"):
        plan = plan_of(warehouse.with_month(name, 2))
        assert "md5(" in plan and plan.rindex("md5(") < plan.index("Exchange hashpartitioning"), name


def test_stored_tables_are_written_with_a_codec_that_shortens_keys(root):
    import glob

    files = glob.glob(f"{root}/builds/*/*/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)

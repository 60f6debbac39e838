"""Lookups of hot and null keys without adaptive skew handling."""

import pytest
from pyspark.sql import functions as F

from marketlens.operators import skew_join


@pytest.fixture()
def plain_spark(spark):
    """The session without AQE and without automatic broadcasts."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _lines(spark, n=40_000):
    """Half of the lines on one seller, a tenth without one, a few unknown."""
    i = F.col("id")
    seller = F.when(i % 2 == 0, F.lit("hot")).when(i % 10 == 1, F.lit(None)).when(i % 100 == 3, F.lit("gone"))
    return spark.range(n).select(i.alias("line"), seller.otherwise(F.concat(F.lit("s"), i % 700)).alias("seller_id"), F.lit(1).alias("pieces"))


def _sellers(spark):
    names = spark.range(700).select(F.concat(F.lit("s"), "id").alias("seller_id"))
    hot = spark.createDataFrame([("hot",)], "seller_id string")
    return names.unionByName(hot).withColumn("piece", F.concat(F.lit("key-"), "seller_id"))


def _loads(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_no_task_above_twice_the_median(plain_spark):
    lines, sellers = _lines(plain_spark), _sellers(plain_spark)
    plain = _loads(lines.join(sellers, "seller_id", "left"))
    assert plain[-1] > 2 * plain[len(plain) // 2]  # the data are skewed
    salted = _loads(skew_join.look_up(lines, sellers, "seller_id"))
    assert sum(salted) == 40_000
    assert salted[-1] <= 2 * salted[len(salted) // 2]


def test_rows_equal_the_plain_join(plain_spark):
    lines, sellers = _lines(plain_spark, 5_000), _sellers(plain_spark)
    found = skew_join.salted_look_up(lines, sellers, "seller_id")
    assert found.columns == ["line", "seller_id", "pieces", "piece"]
    want = lines.join(sellers, "seller_id", "left").select(found.columns)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_repeated_rows_stay(plain_spark):
    lines = _lines(plain_spark, 1_000).unionByName(_lines(plain_spark, 1_000))
    assert skew_join.salted_look_up(lines, _sellers(plain_spark), "seller_id").count() == 2_000


def test_heavy_keys_are_counted_exactly_and_few(plain_spark):
    heavy = {r.seller_id: r.pieces for r in skew_join.heavy_keys(_lines(plain_spark), "seller_id", 16).collect()}
    # 20,000 of 36,000 lines that have a seller: 8.9 fair shares; "gone" has 0.18 of one
    assert heavy == {"hot": 143}


@pytest.mark.parametrize("side", ["rows", "table", "both"])
def test_empty_sides(plain_spark, side):
    lines, sellers = _lines(plain_spark, 100), _sellers(plain_spark)
    if side in ("rows", "both"):
        lines = lines.where("false")
    if side in ("table", "both"):
        sellers = sellers.where("false")
    found = skew_join.salted_look_up(lines, sellers, "seller_id")
    assert found.count() == (0 if side != "table" else 100)
    assert found.where("piece is not null").isEmpty()


def test_all_keys_null(plain_spark):
    lines = _lines(plain_spark, 2_000).withColumn("seller_id", F.lit(None).cast("string"))
    found = skew_join.salted_look_up(lines, _sellers(plain_spark), "seller_id")
    loads = _loads(found)
    assert sum(loads) == 2_000 and loads[-1] <= 2 * loads[len(loads) // 2]
    assert found.where("piece is not null").isEmpty()


def test_adaptive_sessions_join_plainly(spark):
    lines, sellers = _lines(spark, 100), _sellers(spark)
    assert skew_join.splits_skew(spark)
    plan = skew_join.look_up(lines, sellers, "seller_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan


def test_item_fact_without_adaptive_execution(plain_spark):
    from marketlens.plans.pipeline import Warehouse
    from tests.conftest import SF_SMALL

    salted = Warehouse.from_testbed(plain_spark, SF_SMALL).fct_order_items
    assert "xxhash64" in salted._jdf.queryExecution().optimizedPlan().toString()
    rows = salted.collect()
    plain_spark.conf.set("spark.sql.adaptive.enabled", "true")
    plain = Warehouse.from_testbed(plain_spark, SF_SMALL).fct_order_items.collect()
    plain_spark.conf.set("spark.sql.adaptive.enabled", "false")
    assert sorted(map(str, rows)) == sorted(map(str, plain))


@pytest.mark.parametrize("parts", [5, 13, 200])
def test_centroids_and_distances_do_not_depend_on_partitions(spark, parts):
    from marketlens.functions.semantics import haversine_km
    from marketlens.plans.intermediate import int_geolocation_deduped

    i = F.col("id")
    points = spark.range(3_000).select(
        (i % 7).cast("string").alias("geolocation_zip_code_prefix"),
        (F.sin(i.cast("double")) * 33.3).alias("geolocation_lat"),
        (F.cos(i.cast("double")) * 61.7).alias("geolocation_lng"),
    )
    odd = spark.createDataFrame([("0", None, float("nan")), ("nowhere", None, float("inf"))], points.schema)
    points = points.unionByName(odd)

    def bits(df):
        km = haversine_km(F.col("latitude"), F.col("longitude"), F.lit(-23.5), F.lit(-46.6)).alias("km")
        return {r[0]: tuple(None if v is None else v.hex() for v in r[1:]) for r in df.select("zip_code_prefix", "latitude", "longitude", km).collect()}

    want = bits(int_geolocation_deduped(points.coalesce(1)))
    assert want["nowhere"][:2] == (None, None)
    assert bits(int_geolocation_deduped(points.repartition(parts, F.xxhash64("geolocation_lat")))) == want

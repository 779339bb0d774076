"""Joins that spread frequent keys: same rows as the plain join, even tasks."""

from statistics import median

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from authlytics.operators import skew

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_of(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


MANY = [("hot", i) for i in range(50)] + [("hot", 1)] * 3 + [(None, 1)] * 20 + [("a", 1), ("b", 2)]
FEW = [("hot", "x"), ("a", "y"), ("a", "y"), ("c", "z"), (None, "n")]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("few", [FEW, [], FEW[1:]])
@pytest.mark.parametrize("many", [MANY, [], [(None, 5)]])
def test_same_rows_as_the_plain_join(spark, no_broadcast, many, few, how):
    left = spark.createDataFrame(many, "k string, Salt long").repartition(3)
    right = spark.createDataFrame(few, "k string, parts string")
    found, plain = skew.spread_join(left, right, "k", how), left.join(right, "k", how)
    assert found.columns == plain.columns
    assert rows_of(found) == rows_of(plain)


@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_heavy_keys(spark, kind):
    key = {"long": "k", "string": "cast(k as string)", "date": "date_add(date'2024-01-01', cast(k as int))"}
    rows = spark.range(100_000).selectExpr("if(id % 2 = 0, 3, id) AS k").selectExpr(f"{key[kind]} AS k")
    found = skew.heavy_keys(rows, "k", 20, "parts").collect()
    assert [r["k"] for r in found] == [rows.groupBy("k").count().orderBy(F.desc("count")).first()["k"]]
    assert 10 * skew.PARTS <= found[0]["parts"] <= 10 * skew.PARTS + 2
    assert skew.heavy_keys(rows.limit(0), "k", 20, "parts").count() == 0
    assert skew.heavy_keys(rows.selectExpr("cast(null as long) AS k"), "k", 20, "parts").count() == 0


def test_a_third_on_one_key_is_spread_at_default_thresholds(spark):
    """Rows by task of the join: the largest below three times the median."""
    changed = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        few = spark.range(6_000_000).selectExpr("id AS k", "id * 2 AS v")
        many = spark.range(2_000_000).selectExpr("if(id % 3 = 0, 7, id * 3) AS k", "id AS row")
        assert not skew.is_broadcast(few)
        sizes = {}
        for name, joined in (("spread", skew.spread_join(many, few, "k")), ("plain", many.join(few, "k"))):
            assert joined.agg(F.sum(F.col("v") - 2 * F.col("k"))).first()[0] == 0
            by_task = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
            sizes[name] = [r["count"] for r in by_task]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes["spread"]) == sum(sizes["plain"]) == 2_000_000
    assert max(sizes["plain"]) > 10 * median(sizes["plain"])
    assert max(sizes["spread"]) < 3 * median(sizes["spread"])


def test_small_tables_are_joined_as_they_are(spark):
    few = spark.range(5).selectExpr("id AS k", "id AS v")
    plan = skew.spread_join(spark.range(9).selectExpr("id % 3 AS k", "id AS n"), few, "k")
    assert "approx_top_k" not in plan._jdf.queryExecution().executedPlan().toString()


def test_other_joins_are_refused(spark):
    rows = spark.createDataFrame(FEW, "k string, v string")
    with pytest.raises(ValueError, match="inner and left"):
        skew.spread_join(rows, rows.withColumnRenamed("v", "w"), "k", "full")


@pytest.mark.parametrize("name", ["raw_auth_events", "user_friction_scores"])
def test_models_spread_their_joins(spark, no_broadcast, name):
    """Same rows as with tables that are broadcast, which the SQL is compared with."""
    query = registry.queries()[name]
    found = query(spark, SF_DIR)
    assert "approx_top_k" in found._jdf.queryExecution().executedPlan().toString()
    spread = rows_of(found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plain = query(spark, SF_DIR)
    assert spread and spread == rows_of(plain.select(found.columns))

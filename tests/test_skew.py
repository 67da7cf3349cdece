"""One key holding a third of all rows: results stay whole, duplicates
collapse before the shuffle, and AQE splits the skewed join partition."""

import math

import pytest
from pyspark.sql import functions as F

from reachset.operators.algebra import (
    Link,
    audience,
    exclude,
    hot_values,
    in_any,
    restrict_to,
    semi_chain,
)
from reachset.sources.events import intersect_sources

HOT = 7


@pytest.fixture
def skewed(spark):
    # 30k rows; key 7 carries a third of them
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 100).alias("v"),
    )
    return df


@pytest.fixture
def no_broadcast(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    df.collect()  # runs the dataset's own query execution: the adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def test_audience_collapses_hot_key_before_exchange(spark, skewed):
    aud = audience(skewed, "k")
    assert aud.count() == 20000  # ids not divisible by 3 (7 is one of them)
    plan = aud._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange: one row per key per map task
    partial = plan.rindex("HashAggregate(keys=[k")
    assert plan.index("Exchange hashpartitioning(k") < partial


def test_union_and_intersection_counts_stay_whole(spark, skewed):
    other = spark.range(0, 40000, 2).select(F.col("id").alias("k"))
    u = in_any([skewed, other], "k")
    want_union = {r.k for r in skewed.select("k").distinct().collect()} | set(range(0, 40000, 2))
    assert u.count() == len(want_union)
    both = intersect_sources({"a": (skewed, "k"), "b": (other, "k")}, key="k")
    mine = {r.k for r in skewed.select("k").distinct().collect()}
    assert {r.k for r in both.collect()} == mine & set(range(0, 40000, 2))


def test_skewed_semi_join_is_split(spark, skewed, no_broadcast):
    inner = spark.range(0, 30000, 5).select(F.col("id").alias("k"))
    hot = spark.createDataFrame([(HOT,)], "k bigint")
    keys = in_any([inner, hot], "k")
    out = semi_chain([Link(keys, key="k"), Link(skewed, key="v", on="k")], measure_from=0)
    plan = final_plan(out)
    assert "SortMergeJoin" in plan and "LeftSemi" in plan
    assert "_salt" in plan  # hot probe keys are salted, not left to one task
    want = {r.v for r in skewed.join(keys, "k", "left_semi").select("v").distinct().collect()}
    assert {r.v for r in out.collect()} == want


def test_only_measured_hot_keys_are_salted(spark, skewed):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert hot_values(skewed, "k", measure_from=0) == [(HOT, math.ceil(10001 * parts / 30000))]
    assert hot_values(spark.range(30000), "id", measure_from=0) == []
    assert hot_values(skewed, "k") == [] == hot_values(skewed, "k", measure_from=None)


def test_a_broadcast_key_set_leaves_the_rows_where_they_are(spark, skewed):
    keys = spark.range(5).select(F.col("id").alias("k"))
    plan = final_plan(semi_chain([Link(keys, key="k"), Link(skewed, key="v", on="k")]))
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final
    assert final.count("Exchange hashpartitioning(_on") <= 2  # groupings of keys only
    below = final[final.index("BroadcastHashJoin"):]
    assert below.index("BroadcastQueryStage") > 0 and "_salt" not in final


def test_restricting_rows_to_keys_with_a_hot_value(spark, skewed, no_broadcast):
    keys = spark.createDataFrame([(HOT,), (8,), (None,)], "k bigint")
    got = restrict_to(skewed, keys, on="k", spread_by="v", measure_from=0)
    assert "_salt" in final_plan(got)
    assert sorted(r.v for r in got.collect()) == sorted(
        r.v for r in skewed.where("k in (7, 8)").collect()
    )


def test_null_keys_go_around_the_exclusion(spark, no_broadcast):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    out = exclude(df, spark.range(0, 9000, 2).select(F.col("id").alias("k")), "k")
    assert {r.id for r in out.collect()} == {i for i in range(9000) if i % 3 == 0 or i % 2}
    assert "_salt" in final_plan(out)


def test_skewed_exclusion_is_whole(spark, skewed, no_broadcast):
    drop = spark.range(0, 30000, 4).select(F.col("id").alias("k"))
    out = exclude(audience(skewed, "k"), drop, "k")
    want = {r.k for r in skewed.select("k").distinct().collect()} - set(range(0, 30000, 4))
    assert {r.k for r in out.collect()} == want

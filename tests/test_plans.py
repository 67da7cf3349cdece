"""Plan checks: semi/anti joins, pushed filters, no cartesian product,
no Python evaluation, inner GROUP BYs only where a key set is built."""

import pytest

import __spark_entry__ as E
from reachset.plans.named import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def long_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_semi_chain_is_semi_joins_with_pushed_filters(spark):
    p = plan(E.queries()["semi_chain"](spark, SF))
    assert p.count("LeftSemi") == 4
    assert "PushedFilters: [IsNotNull(r_name), EqualTo(r_name,ASIA)" in p


def test_windows_reach_the_scan(spark):
    p = plan(E.queries()["unconverted_audience"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in p
    assert "LessThan(ts,2024-01-31T00:00)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    # three audiences of one table: one scan of it, flagged per user
    assert p.count("events.parquet") == 1 and "partial_max" in p  # bool_or runs as max
    assert "LeftSemi" in p  # companies restricted to the audience


def test_anti_join_for_exclusion(spark):
    p = plan(E.queries()["anti_audience"](spark, SF))
    assert "LeftAnti" in p


def test_union_is_one_grouping(spark):
    p = plan(E.queries()["any_signal_audience"](spark, SF))
    assert "Union" in p and "LeftAnti" in p


def test_intersection_by_counts_is_one_shuffle(spark):
    p = plan(E.queries()["intersect_sources"](spark, SF))
    assert p.count("Exchange hashpartitioning") == 1
    assert "Join" not in p


def test_any_signal_at_scale_is_two_shuffles(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = E.queries()["any_signal_audience"](spark, SF)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # all signals grouped once, new accounts grouped once; the anti-join
        # reuses both partitionings
        assert final.count("Exchange hashpartitioning") == 2
        assert "SortMergeJoin" in final and "LeftAnti" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

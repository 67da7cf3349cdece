"""Membership filters: no key lost, few others pass, filters merge."""

import pytest
from pyspark.sql import functions as F

from reachset.operators.membership import (
    BLOCK_BITS,
    blocks_for,
    false_positive_rate,
    key_filter,
    maybe_in,
    semi_join_filtered,
)


def test_no_key_is_lost_and_few_others_pass(spark):
    n = 50_000
    keys = spark.range(n).select((F.col("id") * 3).alias("k"))
    blocks = blocks_for(n)
    found = key_filter(keys, "k", blocks)
    assert found.size == blocks * BLOCK_BITS // 8 and found.bits.count() == blocks
    assert maybe_in(keys, "k", found).count() == n
    others = spark.range(200_000).select((F.col("id") * 3 + 1).alias("k"))
    rate = false_positive_rate(n, blocks)
    assert 0.003 < rate < 0.01
    assert 0.5 * rate < maybe_in(others, "k", found).count() / 200_000 < 1.5 * rate


def test_filters_merge(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("z",)], "k string")
    both = key_filter(a, "k", 3).merge(key_filter(b, "k", 3))
    assert {r.k for r in maybe_in(a.unionByName(b), "k", both).collect()} == {"x", "y", "z"}
    none = key_filter(a.where("false"), "k", 1)
    assert maybe_in(a, "k", none).count() == 0
    with pytest.raises(ValueError):
        key_filter(a, "k", 1).merge(both)
    with pytest.raises(ValueError):
        maybe_in(spark.range(3), "id", both)


@pytest.mark.parametrize("filter_max", [0, 1 << 27])
def test_the_join_is_exact(spark, filter_max):
    rows = spark.range(5000).select(F.when(F.col("id") % 11 > 0, F.col("id") % 900).alias("k"), "id")
    keys = spark.range(0, 900, 7).select(F.col("id").alias("key")).union(spark.createDataFrame([(None,)], "key long"))
    got = semi_join_filtered(rows, keys, "k", "key", bits_per_key=2, filter_max=filter_max)
    want = [i for i in range(5000) if i % 11 and i % 900 % 7 == 0]
    assert sorted(r.id for r in got.collect()) == want


def test_rows_shuffled_are_the_matches_and_the_stated_rest(spark):
    """sf0.1 without broadcast: what reaches the exact join."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
        urgent = read("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey").distinct()
        lines = read("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
        n = urgent.count()
        blocks = blocks_for(n)
        likely = maybe_in(lines, "o_orderkey", key_filter(urgent, "o_orderkey", blocks)).count()
        matches = lines.join(urgent, "o_orderkey", "left_semi").count()
        others = lines.count() - matches
        assert matches <= likely <= matches + 2 * false_positive_rate(n, blocks) * others + 50
        assert likely < 0.5 * lines.count()
        plan = semi_join_filtered(lines, urgent, "o_orderkey")
        assert plan.count() == matches
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    finally:
        for k in keys:
            spark.conf.unset(k)

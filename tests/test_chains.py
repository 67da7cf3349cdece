"""Fused chains: the same keys as separate chains, each level read once."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from reachset.operators.algebra import Link, exclude, semi_chain
from reachset.operators.chains import SharedLink, shared_chains

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def levels(spark, tmp_path):
    rng = random.Random(4)
    some = lambda n: rng.choice([None, *range(n)])

    def level(name, n, width):
        rows = [(some(width), some(width), some(3), some(width)) for _ in range(n)]
        spark.createDataFrame(rows, "on int, key int, kind int, other int").write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return level("inner", 40, 30), level("middle", 300, 30), level("outer", 600, 30)


def one(frame, column):
    return sorted(r[column] for r in frame.collect())


@pytest.mark.parametrize("measure_from", [None, 0])
@pytest.mark.parametrize("broadcast", [True, False])
def test_fused_chains_equal_separate_ones(spark, levels, measure_from, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    inner, middle, outer = levels
    a, b, c = (F.col("kind") == k for k in range(3))
    both = shared_chains(
        [
            SharedLink(inner, {"a": "key", "b": "key"}, where={"a": a}),
            SharedLink(middle, {"a": "key", "b": "key", "c": "key"}, on="on", where={"b": b, "c": c}),
            SharedLink(outer, {"a": "key", "b": "key", "c": "key", "d": "key"}, on="on", where={"d": c}),
        ],
        measure_from=measure_from,
    )
    want = {
        "a": [Link(inner.where(a), "key"), Link(middle, "key", "on"), Link(outer, "key", "on")],
        "b": [Link(inner, "key"), Link(middle.where(b), "key", "on"), Link(outer, "key", "on")],
        "c": [Link(middle.where(c), "key"), Link(outer, "key", "on")],
        "d": [Link(outer.where(c), "key")],
    }
    flags = {n: sorted(r.k for r in both.flags("k").collect() if r[n]) for n in want}
    for name, links in want.items():
        expected = one(semi_chain(links, out="k", measure_from=measure_from), "k")
        assert one(both.of(name, "k"), "k") == expected == flags[name]


def test_chains_that_part_share_the_last_level(spark, levels, no_broadcast):
    inner, middle, outer = levels
    both = shared_chains(
        [SharedLink(inner, {"a": "key", "b": "key"}),
         SharedLink(middle, {"a": "key", "b": "other"}, on="on", where={"b": F.col("kind") == 1})]
    )
    first = [Link(inner, "key")]
    assert one(both.of("a", "k"), "k") == one(semi_chain([*first, Link(middle, "key", "on")], out="k"), "k")
    again = semi_chain([Link(both.of("b", "k"), "k"), Link(outer, "key", "on")])
    b = [*first, Link(middle.where("kind = 1"), "other", "on"), Link(outer, "key", "on")]
    assert one(again, "key") == one(semi_chain(b), "key")
    # both readers in one plan: the shared levels run once
    plan = final(both.of("a", "k").join(again.withColumnRenamed("key", "k"), "k", "left_anti"))
    assert plan.count("/inner]") == 1 and plan.count("/middle]") == 1 and "ReusedExchange" in plan


def test_multi_valued_keys_and_bad_levels(spark):
    a = spark.createDataFrame([(1, [1, 2, None]), (2, [3])], "on int, key array<int>")
    b = spark.createDataFrame([(1, "x"), (3, "y"), (4, "z"), (None, "w")], "on int, key string")
    both = shared_chains(
        [SharedLink(a, {"a": "key", "b": "key"}, where={"b": F.col("on") == 2}),
         SharedLink(b, {"a": "key", "b": "key"}, on="on")]
    )
    assert one(both.of("a", "k"), "k") == ["x", "y"] and one(both.of("b", "k"), "k") == ["y"]
    with pytest.raises(ValueError):
        shared_chains([SharedLink(b, {"a": "key"}), SharedLink(b, {"a": "key"})])
    with pytest.raises(ValueError):
        shared_chains([SharedLink(b, {"a": "key", "b": "on"}), SharedLink(b, {"a": "key"}, on="on")])
    with pytest.raises(ValueError):
        shared_chains([])


def test_the_chain_query_reads_each_table_once(spark, no_broadcast):
    plan = final(E.queries()["unconverted_chain"](spark, "/root/testdata/sf0.01"))
    for name in ("customer", "orders", "lineitem"):
        assert plan.count(f"{name}.parquet") == 1
    assert "_salt" in plan  # rows without a key to match are spread


def test_exclusion_reads_its_input_once(spark, tmp_path, no_broadcast):
    spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out = exclude(df, spark.range(0, 3000, 2).select(F.col("id").alias("k")), "k")
    plan = final(out)
    assert plan.count("/rows]") == 1 and "hashpartitioning(k" in plan and "_salt" in plan[plan.index("hashpartitioning(k"):][:60]
    assert sorted(r.id for r in out.collect()) == [i for i in range(3000) if i % 3 == 0 or i % 2]

"""Algebra properties on random key sets."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reachset.operators.algebra import audience, exclude, in_all, in_any

keysets = st.lists(st.one_of(st.none(), st.integers(-5, 30)), max_size=25)
SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def keys(df):
    return {r.k for r in df.collect()}


@SETTINGS
@given(a=keysets, b=keysets)
def test_union_commutes_and_is_idempotent(spark, a, b):
    fa, fb = frame(spark, a), frame(spark, b)
    ab = keys(in_any([fa, fb], "k"))
    assert ab == keys(in_any([fb, fa], "k")) == keys(in_any([fa, fb, fa], "k"))
    assert ab == {x for x in a + b if x is not None}


@SETTINGS
@given(a=keysets, b=keysets)
def test_intersection_plus_difference_is_whole(spark, a, b):
    fa, fb = frame(spark, a), frame(spark, b)
    both = keys(in_all([fa, fb], "k"))
    only_a = keys(exclude(audience(fa, "k"), fb, "k"))
    assert both | only_a == {x for x in a if x is not None}
    assert not both & only_a
    assert keys(exclude(audience(fa, "k"), fa, "k")) == set()


@SETTINGS
@given(a=keysets, b=keysets, extra=keysets)
def test_bigger_exclusion_never_grows(spark, a, b, extra):
    fa = audience(frame(spark, a), "k")
    small = keys(exclude(fa, frame(spark, b), "k"))
    big = keys(exclude(fa, frame(spark, b + extra), "k"))
    assert big <= small


pairs_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40)), max_size=60)


@SETTINGS
@given(pairs=pairs_st, inner=st.lists(st.integers(0, 8), max_size=6),
       hot=st.dictionaries(st.integers(0, 8), st.integers(1, 5), max_size=3))
def test_salted_semi_join_equals_plain_semi_join(spark, pairs, inner, hot):
    from reachset.operators.algebra import semi_join_spread

    probe = spark.createDataFrame(pairs, "on bigint, v bigint")
    keys = frame(spark, inner)
    out = semi_join_spread(probe, keys.distinct().withColumnRenamed("k", "on"), "on", "v", list(hot.items()))
    assert sorted((r.on, r.v) for r in out.collect()) == sorted(p for p in pairs if p[0] in set(inner))


events_st = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["view", "click", "buy"])), max_size=40)


@SETTINGS
@given(rows=events_st)
def test_signal_flags_equal_separate_audiences(spark, rows):
    from pyspark.sql import functions as F

    from reachset.operators.algebra import signal_flags

    ev = spark.createDataFrame(rows, "k bigint, t string")
    kind = F.col("t")
    flags = signal_flags(ev, "k", {"v": kind == "view", "c": kind == "click", "b": kind == "buy"})
    one_pass = keys(flags.where(F.col("v") & F.col("c") & ~F.col("b")).select("k"))
    views, clicks, buys = (ev.where(kind == x).select("k") for x in ("view", "click", "buy"))
    separate = keys(exclude(in_all([views, clicks], "k"), buys, "k"))
    assert one_pass == separate

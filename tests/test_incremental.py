"""Day windows and mergeable distinct counts against full scans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reachset.operators.bitmap_counts import count_bitmaps, group_bitmaps, merge_bitmaps, number_keys
from reachset.operators.day_windows import (
    changed,
    day_counts,
    difference,
    move_window,
    read_days,
    window_counts,
    write_days,
)

DAY0 = dt.date(2023, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(9)
    rows = [
        (dt.datetime.combine(day(rng.randrange(400)), dt.time(rng.randrange(24))), rng.choice([None, *range(200)]))
        for _ in range(6000)
    ]
    rows += [(None, 3), (dt.datetime(2023, 1, 5), 7)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, user bigint").cache()


def full(events, lo, hi):
    rows = events.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)) & F.col("user").isNotNull())
    return {r.user: r["count"] for r in rows.groupBy("user").count().collect()}


def state_of(df):
    return {r.user: r.n for r in df.collect()}


def test_a_year_moved_by_a_day_reads_two_days(spark, events, tmp_path):
    path = str(tmp_path / "days")
    write_days(day_counts(events, "user"), path)
    old, new = (day(10), day(375)), (day(11), day(376))
    state = window_counts(read_days(spark, path, [old], "bigint", "user"), "user")
    assert state_of(state) == full(events, *old)
    moved = move_window(state, path, "user", old, new)
    assert state_of(moved) == full(events, *new)
    two = read_days(spark, path, difference(new, old) + difference(old, new), "bigint", "user")
    assert {r.day for r in two.select("day").distinct().collect()} == {day(10), day(375)}
    scan = two._jdf.queryExecution().executedPlan().collectLeaves().head()
    two.collect()
    assert scan.metrics().apply("numPartitions").value() == 2


@pytest.mark.parametrize("new", [(100, 160), (40, 90), (300, 310), (60, 70), (50, 80), (90, 90)])
def test_any_move_equals_the_full_scan(spark, events, tmp_path, new):
    path = str(tmp_path / "days")
    write_days(day_counts(events, "user"), path)
    old, new = (day(50), day(80)), tuple(day(n) for n in new)
    state = window_counts(read_days(spark, path, [old], "bigint", "user"), "user")
    assert state_of(move_window(state, path, "user", old, new)) == full(events, *new)


def test_a_day_written_again_replaces_it(spark, events, tmp_path):
    path, window = str(tmp_path / "days"), (day(0), day(30))
    write_days(day_counts(events, "user"), path)
    read = lambda w: read_days(spark, path, [w], "bigint", "user")
    state = spark.createDataFrame(window_counts(read(window), "user").collect(), "user bigint, n bigint")
    before = spark.createDataFrame(read((day(4), day(5))).collect(), "user bigint, n bigint, day date")
    late = events.unionByName(spark.createDataFrame([(dt.datetime(2023, 1, 5, 9), 999)], events.schema))
    corrected = day_counts(late, "user").where(F.col("day") == F.lit(day(4)))
    write_days(corrected, path)
    assert state_of(changed(state, "user", corrected, before)) == full(late, *window)
    assert state_of(window_counts(read(window), "user")) == full(late, *window)


def test_difference_of_windows():
    assert difference((day(0), day(5)), (day(1), day(6))) == [(day(0), day(1))]
    assert difference((day(0), day(9)), (day(3), day(5))) == [(day(0), day(3)), (day(5), day(9))]
    assert difference((day(0), day(2)), (day(2), day(4))) == [(day(0), day(2))]
    assert difference((day(3), day(3)), (day(0), day(9))) == []
    assert difference((day(0), day(2)), (day(1), day(1))) == [(day(0), day(2))]


def test_bitmaps_count_distinct_keys(spark, events):
    df = events.select(F.to_date("ts").alias("day"), (F.col("user") % 3).alias("kind"), "user")
    ids = number_keys(df, "user")
    numbers = sorted(r.id for r in ids.collect())
    assert numbers == list(range(1, 201))  # dense, from 1
    daily = group_bitmaps(df, ["day", "kind"], "user", ids)
    assert daily.count() == df.where("user is not null").select("day", "kind").distinct().count()
    for by in (["kind"], ["day"], []):
        got = {tuple(r)[:-1]: r.n for r in count_bitmaps(merge_bitmaps(daily, by), by, "n").collect()}
        want = df.groupBy(*by).agg(F.count_distinct("user").alias("n")).collect()
        assert got == {tuple(r)[:-1]: r.n for r in want if r.n}


def test_the_dictionary_grows_and_keeps_its_numbers(spark):
    a = spark.range(70_000).select((F.col("id") * 2).cast("string").alias("k"))
    b = spark.range(90_000).select(F.col("id").cast("string").alias("k"))
    ids = spark.createDataFrame(number_keys(a, "k").toPandas())
    more = number_keys(b, "k", ids)
    assert more.count() == 70_000 + 45_000
    assert more.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 115_000, 115_000)
    assert more.join(ids, ["k", "id"]).count() == 70_000
    # more than one bucket of 32768 numbers
    maps = group_bitmaps(b, [], "k", more)
    assert maps.count() == 4 and count_bitmaps(maps, [], "n").first().n == 90_000
    none = group_bitmaps(b.where("false"), [], "k", more)
    assert merge_bitmaps(none, []).count() == 0

"""Date parameters, window literals, dataset reading and small shapers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reachset.functions.dates import days_before, resolve_date, window_bounds
from reachset.operators.shape import project, with_literals
from reachset.sources.events import event_window, read_dataset, union_sources

AS_OF = dt.date(2021, 2, 16)


def test_relative_and_iso_dates():
    assert resolve_date("0d", AS_OF) == AS_OF
    assert resolve_date("14d", AS_OF) == dt.date(2021, 2, 2)
    assert resolve_date("2w", AS_OF) == dt.date(2021, 2, 2)
    assert resolve_date("1y", AS_OF) == dt.date(2020, 2, 16)
    assert resolve_date("1y", dt.date(2020, 2, 29)) == dt.date(2019, 2, 28)
    assert resolve_date("today", AS_OF) == AS_OF
    assert resolve_date("2019-12-28") == dt.date(2019, 12, 28)
    assert window_bounds("20d", "12d", dt.date(2021, 2, 4)) == (
        dt.date(2021, 1, 15),
        dt.date(2021, 1, 23),
    )
    assert days_before("2019-12-28", 30) == dt.date(2019, 11, 28)
    with pytest.raises(ValueError):
        resolve_date("soon")
    with pytest.raises(ValueError):
        window_bounds("1d", "2d", AS_OF)


def test_window_is_half_open_for_every_time_type(spark):
    rows = [
        (dt.datetime(2021, 2, 1, 23, 59), dt.date(2021, 2, 1), "2021-02-01"),
        (dt.datetime(2021, 2, 2, 0, 0), dt.date(2021, 2, 2), "2021-02-02"),
        (dt.datetime(2021, 2, 15, 23, 0), dt.date(2021, 2, 15), "2021-02-15"),
        (dt.datetime(2021, 2, 16, 0, 0), dt.date(2021, 2, 16), "2021-02-16"),
    ]
    df = spark.createDataFrame(rows, "ntz timestamp_ntz, d date, s string").withColumn(
        "ltz", F.col("ntz").cast("timestamp")
    )
    for col in ("ntz", "ltz", "d", "s"):
        got = event_window(df, "14d", "0d", ts=col, as_of=AS_OF).count()
        assert got == 2, col


def test_read_dataset_aliases_and_union(spark, tmp_path):
    a = str(tmp_path / "a")
    b = str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "advertiserId bigint, v string").write.parquet(a)
    spark.createDataFrame([(2, 5)], "advertiser_id bigint, w int").write.parquet(b)
    da = read_dataset(spark, a, {"advertiserId": "advertiser_id"})
    db = read_dataset(spark, b)
    u = union_sources({"a": da, "b": db}, where=F.col("advertiser_id") > 0, source_col="src")
    got = sorted((r.advertiser_id, r.v, r.w, r.src) for r in u.collect())
    assert got == [(1, "x", None, "a"), (2, None, 5, "b")]
    with pytest.raises(ValueError):
        read_dataset(spark, a, {"nope": "x"})


def test_project_and_literals(spark):
    df = spark.createDataFrame([(1, "a", "e@x")], "k bigint, n string, emailAddress string")
    assert project(df, drop=("emailAddress",)).columns == ["k", "n"]
    with pytest.raises(ValueError):
        project(df, drop=("nope",))
    out = with_literals(df, {"firstName": "", "City": "Chicago"}).collect()[0]
    assert (out.firstName, out.City) == ("", "Chicago")


def test_declared_driver_schemas_match_files(spark):
    from pyspark.sql.types import _parse_datatype_string

    from reachset.plans.named import DRIVER_SCHEMAS

    for name, ddl in DRIVER_SCHEMAS.items():
        stored = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").schema
        declared = _parse_datatype_string(ddl)
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in declared], name


def test_window_prunes_date_partitions(spark, tmp_path):
    path = str(tmp_path / "ev")
    rows = [
        (dt.datetime(2021, 2, d, 12), dt.date(2021, 2, d).isoformat(), d) for d in range(1, 17)
    ]
    spark.createDataFrame(rows, "ts timestamp_ntz, dt string, k int").write.partitionBy("dt").parquet(path)
    ev = spark.read.parquet(path)
    out = event_window(ev, "14d", "0d", as_of=AS_OF, partition_col="dt")
    assert sorted(r.k for r in out.collect()) == list(range(2, 16))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_bucketed_lookup_is_not_shuffled(spark, tmp_path):
    from reachset.operators.algebra import audience
    from reachset.sources.lookups import attach_profile, write_bucketed_lookup

    email = spark.range(0, 2000).select(
        F.col("id"), F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x")).alias("emailAddress")
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        table = write_bucketed_lookup(email, "email_bucketed", "id", n, str(tmp_path / "email"))
        aud = audience(spark.range(0, 5000, 7).select(F.col("id").alias("accountId")), "accountId")
        out = attach_profile(aud, "accountId", table, "id", {"emailAddress": "emailAddress"}, how="inner")
        assert out.count() == len(range(0, 2000, 7))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        # the lookup table's scan is not followed by an exchange
        assert "Exchange hashpartitioning(id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists email_bucketed")


def test_read_dataset_with_declared_schema_and_list_union(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, s string").write.parquet(path)
    df = read_dataset(spark, path, schema="k bigint, s string")
    assert df.schema.simpleString() == "struct<k:bigint,s:string>"
    both = union_sources([df, df.where(F.col("k") == 2)], where=F.col("k") > 1)
    assert sorted(r.k for r in both.collect()) == [2, 2]


def test_windows_within_a_day_are_exact(spark):
    day = dt.datetime(2024, 1, 10)
    ev = spark.createDataFrame(
        [(h, day + dt.timedelta(hours=h)) for h in range(24)], "h int, ts timestamp_ntz"
    ).withColumn("day", F.to_date("ts"))
    lo, hi = day.replace(hour=6), day.replace(hour=18)
    got = event_window(ev, lo, hi).collect()
    assert sorted(r.h for r in got) == list(range(6, 18))
    assert event_window(ev, lo, hi, partition_col="day").count() == 12
    assert event_window(ev, day, dt.date(2024, 1, 11), partition_col="day").count() == 24
    with pytest.raises(ValueError, match="time of day"):
        event_window(ev, lo, hi, ts="day")
    with pytest.raises(ValueError, match="after its end"):
        event_window(ev, hi, lo)

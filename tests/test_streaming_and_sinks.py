"""Streaming audience and the campaign sinks."""

import json
import os

from pyspark.sql import functions as F

from reachset.operators.algebra import audience
from reachset.session import shared_dir
from reachset.sources.sinks import (
    read_campaign_csv,
    write_campaign_csv,
    write_campaign_json,
)
from reachset.streaming import read_event_stream, stream_audience, write_audience_stream

SF = "/root/testdata/sf0.001"


def test_stream_audience_equals_batch(spark):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    events = read_event_stream(spark, SF, schema, glob="events.parquet")
    aud = stream_audience(events.where(F.col("event_type") == "view"), "account_id", source="user_id")
    out, ckpt = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-ckpt")

    def start():
        q = write_audience_stream(aud.select("account_id"), write_campaign_json, out, ckpt)
        q.awaitTermination(120)
        return sum(p["numInputRows"] for p in q.recentProgress)

    assert start() > 0
    assert start() == 0  # the same checkpoint: nothing is read twice
    write_campaign_json(spark.range(1), f"{out}/batch=99", mode="overwrite")
    write_campaign_json(spark.range(0).selectExpr("id as account_id"), f"{out}/batch=99", mode="overwrite")
    got = {r.account_id for r in spark.read.schema("account_id bigint").json(out).collect()}
    batch = spark.read.parquet(f"{SF}/events.parquet").where(F.col("event_type") == "view")
    want = {r.account_id for r in audience(batch, "account_id", source="user_id").collect()}
    assert got == want and want


def test_json_sink_drops_email_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, "Ann", "a@x"), (2, None, "b@x")], "accountId bigint, firstName string, emailAddress string"
    )
    path = shared_dir(spark, "json")
    write_campaign_json(df, path)
    lines = []
    for f in sorted(os.listdir(path)):
        if f.endswith(".json"):
            with open(os.path.join(path, f)) as fh:
                lines += [json.loads(x) for x in fh if x.strip()]
    assert sorted(lines, key=lambda r: r["accountId"]) == [
        {"accountId": 1, "firstName": "Ann"},
        {"accountId": 2, "firstName": None},
    ]


def test_csv_sink_keeps_every_value(spark):
    rows = [
        (1, "Ann", "a@x"), (2, "Bo", None), (3, "", "c@x"), (4, None, "d@x"),
        (5, 'a "q" \\ b', "e@x"), (6, "x\ny", "f@x"), (7, " lead ", "g,x"), (8, '"', "\\"),
    ]
    df = spark.createDataFrame(rows, "accountId bigint, firstName string, emailAddress string")
    path = shared_dir(spark, "csv")
    write_campaign_csv(df, path, max_records_per_file=3)
    back = read_campaign_csv(spark, path, "accountId bigint, firstName string, emailAddress string")
    assert sorted(tuple(r) for r in back.collect()) == rows

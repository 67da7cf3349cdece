"""Sliding windows kept up by days.

The audiences look back over windows that move by a day between runs.  Instead
of reading a year of events each time, counts per day and key are stored once,
one partition per day; a window's state is the sum of its days, and moving it
adds the days that come in and takes out those that leave, so a run reads one
new and one expired day.  Counts are exact, so a key leaves the audience when
its last event does.

``[first, after)`` are dates, half-open as everywhere.  A null key or time
counts nowhere.  Writing a day again replaces it; :func:`changed` brings a state
up to date with such a correction.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

Window = tuple[dt.date, dt.date]


def day_counts(events: DataFrame, key: str, ts: str = "ts", source: str | None = None) -> DataFrame:
    """``day, key, n``: events per day and key, aggregated on the map side first."""
    rows = events.select(F.to_date(ts).alias("day"), F.col(source or key).alias(key))
    return rows.dropna().groupBy("day", key).agg(F.count(F.lit(1)).alias("n"))


def write_days(counts: DataFrame, path: str) -> None:
    """Store day counts, one partition per day; the days at hand replace those stored."""
    counts.repartition("day").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(
        "day"
    ).parquet(path)


def read_days(spark: SparkSession, path: str, windows: Iterable[Window], key_type: str, key: str) -> DataFrame:
    """The stored counts of the days in any of the windows; other days are not opened."""
    days = spark.read.schema(f"`{key}` {key_type}, n long, day date").parquet(path)
    inside = F.lit(False)
    for window in windows:
        inside = inside | _in(window)
    return days.where(inside)


def _in(window: Window) -> Column:
    return (F.col("day") >= F.lit(window[0])) & (F.col("day") < F.lit(window[1]))


def window_counts(days: DataFrame, key: str) -> DataFrame:
    """``key, n`` of a window: the sum of its days."""
    return days.groupBy(key).agg(F.sum("n").alias("n"))


def difference(a: Window, b: Window) -> list[Window]:
    """The days of ``a`` that are not in ``b``, as windows."""
    if a[0] >= a[1]:
        return []
    if b[0] >= b[1] or b[1] <= a[0] or b[0] >= a[1]:
        return [a]
    parts = [(a[0], b[0]), (b[1], a[1])]
    return [(x, y) for x, y in parts if x < y]


def changed(state: DataFrame, key: str, plus: DataFrame | None = None, minus: DataFrame | None = None) -> DataFrame:
    """The state with counts added and taken out: one grouping, keys that reach 0 go."""
    rows = state.select(key, "n")
    if plus is not None:
        rows = rows.unionByName(plus.select(key, "n"))
    if minus is not None:
        rows = rows.unionByName(minus.select(key, (-F.col("n")).alias("n")))
    return rows.groupBy(key).agg(F.sum("n").alias("n")).where("n != 0")


def move_window(state: DataFrame, path: str, key: str, old: Window, new: Window) -> DataFrame:
    """``key, n`` of the window ``new``, from the state of ``old`` and the days in one of them only."""
    come, gone = difference(new, old), difference(old, new)
    kind = state.schema[key].dataType.simpleString()
    if not come and not gone:
        return state.select(key, "n")
    days = read_days(state.sparkSession, path, come + gone, kind, key)
    sign = F.when(_in(new), F.lit(1)).otherwise(F.lit(-1)).cast(LongType())
    return changed(state, key, plus=days.select(key, (F.col("n") * sign).alias("n")))

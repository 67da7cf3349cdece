"""Event-dataset scans.

An event dataset is any DataFrame with a time column.  In production it is
a Parquet table partitioned by event date; the window predicate below is
then resolved by partition pruning, and every other equality/range
predicate is pushed into the Parquet reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.dates import typed_bound, window_bounds
from ..functions.predicates import id_key


def read_dataset(
    spark: SparkSession,
    path: str,
    aliases: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    ids: Sequence[str] = (),
) -> DataFrame:
    """Read one dataset, give differently spelled keys one name and ids one type.

    ``aliases`` maps stored name -> canonical name (``advertiserId`` ->
    ``advertiser_id``).  Renaming is a projection alias, so column pruning
    and filter pushdown still reach the scan.  ``ids`` (canonical names) that
    are stored as text become bigint; text that is no number becomes null
    (``RowGuard.watch_ids`` counts it).  An id stored as a number is left as it
    is, so filters on it still reach the scan.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if aliases:
        missing = [c for c in aliases if c not in df.columns]
        if missing:
            raise ValueError(f"{path}: no column(s) {missing}")
        df = df.withColumnsRenamed(dict(aliases))
    text = [c for c in ids if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: id_key(c) for c in text}) if text else df


def event_window(
    df: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    ts: str = "ts",
    as_of: dt.date | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Rows with ``start <= ts < end`` (S1; half-open, SURVEY §1.4 row 9).

    ``start``/``end`` accept the relative forms of :func:`window_bounds`.
    ``partition_col`` names the table's event-date partition column (a
    date, or 'yyyy-MM-dd' text); the same range is then also stated on it,
    so Spark lists and reads only the partitions of the window instead of
    filtering every file of the table.
    """
    lo, hi = window_bounds(start, end, as_of)
    cond = window_predicate(df, lo, hi, ts)
    if partition_col is not None and partition_col != ts:
        # the rows of [lo, hi) lie on the days from lo's to hi's; a bound within a
        # day needs that whole day's partition
        first = lo.date() if isinstance(lo, dt.datetime) else lo
        after = hi.date() + dt.timedelta(days=1) if isinstance(hi, dt.datetime) else hi
        cond = window_predicate(df, first, after, partition_col) & cond
    return df.where(cond)


def window_predicate(df: DataFrame, lo, hi, ts: str = "ts") -> Column:
    dtype = df.schema[ts].dataType
    col = F.col(ts)
    return (col >= typed_bound(lo, dtype)) & (col < typed_bound(hi, dtype))


def union_sources(
    frames: Mapping[str, DataFrame] | list[DataFrame],
    where: Column | None = None,
    source_col: str | None = None,
) -> DataFrame:
    """Several datasets read as one, with one shared filter.

    Columns are matched by name; a column missing from one dataset is null
    there.  The filter is written once on the union and Catalyst pushes it
    into every branch (and from there into each scan).  ``source_col``, if
    given, tags every row with the name of its dataset.
    """
    items = list(frames.items()) if isinstance(frames, Mapping) else [
        (str(i), f) for i, f in enumerate(frames)
    ]
    if not items:
        raise ValueError("no sources")
    parts = []
    for name, f in items:
        if source_col:
            f = f.withColumn(source_col, F.lit(name))
        parts.append(f)
    out = parts[0]
    for f in parts[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.where(where) if where is not None else out


def intersect_sources(
    sources: Mapping[str, tuple[DataFrame, str]],
    key: str,
    min_counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """Keys that occur in several datasets, each a minimum number of times
    (S3 + J8 + A4: ``GROUP BY key HAVING a.counts>0 and b.counts>0``).

    ``sources`` maps a name to (filtered dataset, its key column).  The key
    columns are given one name, the datasets are unioned with a source tag,
    and one aggregation counts rows per (key, source).  Partial aggregation
    runs before the shuffle, so a key holding a third of all rows costs one
    row per map task, and the whole intersection is a single exchange.
    """
    if not sources:
        raise ValueError("no sources")
    need = {name: 1 for name in sources}
    need.update(min_counts or {})
    unknown = set(need) - set(sources)
    if unknown:
        raise ValueError(f"min_counts for unknown sources {sorted(unknown)}")
    tagged = None
    for i, (name, (df, col)) in enumerate(sources.items()):
        part = df.select(F.col(col).alias(key), F.lit(i).alias("_src"))
        tagged = part if tagged is None else tagged.unionByName(part)
    names = list(sources)
    counts = [
        F.count_if(F.col("_src") == F.lit(i)).alias(f"_n{i}") for i in range(len(names))
    ]
    agg = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(*counts)
    cond = F.lit(True)
    for i, name in enumerate(names):
        cond = cond & (F.col(f"_n{i}") >= F.lit(int(need[name])))
    return agg.where(cond).select(key)

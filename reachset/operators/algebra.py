"""Audience algebra: key sets, semi-join chains, set operations
(SURVEY §2.4 J1-J8, §2.5 A1-A6, §2.7 U1-U3).

An *audience* is a DataFrame whose key column holds each key once.  The
rules that keep these plans sound at scale:

* Every key set is built with a grouping (``audience``), so duplicates and
  hot keys collapse in the map-side partial aggregate before any shuffle.
* Joins between audiences are equi-joins on the key.  Both sides are
  already hash-partitioned on it by their grouping, so a sort-merge join
  needs no further exchange, and neither side can be skewed (each key is
  one row); AQE turns the join into a broadcast join at run time when a
  side proves small.
* Where one side is raw rows that may be skewed on the join key (the levels
  of a nested ``IN`` chain), AQE's skew split cannot help -- it needs both
  join inputs straight from a shuffle, and a grouped side is not.  Large
  inputs are therefore measured, and keys found hot are salted
  (:func:`hot_values`, :func:`semi_join_spread`); all others join as they are.
* No key list is collected to the driver; a "key list" is a DataFrame used
  on the right of a semi- or anti-join.
* Null keys are dropped on entry (SURVEY §1.4 rows 1-2), so null never
  matches null and anti-joins never meet the ``NOT IN`` trap.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

#: Probe sides estimated at this many bytes or more are measured for hot keys.
MEASURE_FROM = 1 << 30
#: A key set called bounded is broadcast only if estimated at no more bytes than this.
BROADCAST_MAX = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``broadcast(df)`` while it is estimated small, else ``df`` (Spark then shuffles)."""
    return F.broadcast(df) if estimated_bytes(df) <= BROADCAST_MAX else df


def hot_values(
    df: DataFrame, on: str, measure_from: int | None = MEASURE_FROM
) -> list[tuple[object, int]]:
    """``(value, salts)`` of the ``on`` values that hold over twice a partition's fair share.

    Fewer than ``spark.sql.shuffle.partitions`` values can.  Counts are
    aggregated on the map side over one column; ``salts`` is as many fair
    shares as the value holds.  An input estimated under ``measure_from``
    bytes (None: every input) is not measured and has none.  One job.
    """
    if measure_from is None or estimated_bytes(df) < measure_from:
        return []
    partitions = _partitions(df)
    counts = df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    # the total is observed while the same job finds the largest counts
    rows = Observation()
    top = counts.observe(rows, F.sum("_n").alias("total")).orderBy(F.desc("_n")).limit(partitions).collect()
    fair = (rows.get.get("total") or 0) / partitions if top else 0
    return [(r[0], math.ceil(r["_n"] / fair)) for r in top if r["_n"] > 2 * fair]


def no_salt(key: str) -> Column:
    """Salt 0 for every key, in a form that is not folded: a literal would leave the join's keys."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_only(df: DataFrame, key: str, source: str | None = None) -> DataFrame:
    col = F.col(source or key)
    return df.where(col.isNotNull()).select(col.alias(key))


def audience(
    df: DataFrame,
    key: str,
    *attrs: str,
    source: str | None = None,
    count: str | None = None,
) -> DataFrame:
    """Distinct key (plus attribute) rows: ``GROUP BY key[, attrs]`` (A1, A2, A5).

    ``source`` names the stored key column when it differs from ``key``
    (``GROUP BY account_id AS accountId``).  With ``count`` the group size is
    kept as a column of that name; without it the count is never produced.
    Rows with a null key are dropped.
    """
    col = F.col(source or key)
    base = df.where(col.isNotNull()).select(col.alias(key), *attrs)
    if count:
        return base.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias(count))
    return base.distinct()


def audience_by_token(
    df: DataFrame, tokens: str, alias: str | None = None, count: str | None = None
) -> DataFrame:
    """Group by a multi-valued field: one group per element.

    A scalar column is treated as a one-element list.
    """
    alias = alias or tokens
    dtype = df.schema[tokens].dataType
    elems = F.explode(F.col(tokens)) if isinstance(dtype, ArrayType) else F.col(tokens)
    exploded = df.select(elems.alias(alias))
    return audience(exploded, alias, count=count)


def distinct_count(df: DataFrame, by: str | Sequence[str], key: str, alias: str) -> DataFrame:
    """Exact number of distinct ``key`` per group (A3).

    Spark plans this as a two-level aggregation (by group+key, then by
    group), each with a map-side partial step: no group is ever collected.
    """
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count_distinct(F.col(key)).alias(alias))


def signal_flags(
    df: DataFrame, key: str, signals: Mapping[str, Column], source: str | None = None
) -> DataFrame:
    """Per key, whether each named signal occurred: one scan, one shuffle.

    When several audiences come from the same dataset (views, clicks and
    purchases of one event table), scanning it once and grouping by key
    with one boolean ``bool_or`` per signal replaces a scan, a grouping and
    a join per audience.  Partial aggregation keeps it skew-safe.  Combine
    the flag columns with ``&``, ``|`` and ``~`` for intersection, union and
    exclusion.  ``df`` must already be restricted to rows any signal needs.
    """
    col = F.col(source or key)
    aggs = [
        F.bool_or(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in signals.items()
    ]
    return df.where(col.isNotNull()).groupBy(col.alias(key)).agg(*aggs)


def in_all(audiences: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys present in every audience: intersection.

    Chained left-semi joins on distinct key sets; each side is partitioned
    on the key by its own grouping, so no extra exchange is planned.
    """
    if not audiences:
        raise ValueError("no audiences")
    out = audience(audiences[0], key)
    for other in audiences[1:]:
        out = out.join(audience(other, key), on=key, how="left_semi")
    return out


def in_any(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys present in any frame: union.

    The frames need not be distinct: they are unioned first and grouped
    once, so the whole union costs one shuffle (partial aggregation per
    branch before it).
    """
    if not frames:
        raise ValueError("no frames")
    out = _key_only(frames[0], key)
    for f in frames[1:]:
        out = out.unionByName(_key_only(f, key))
    return audience(out, key)


def exclude(
    df: DataFrame,
    other: DataFrame,
    key: str,
    other_key: str | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``.

    A left-anti join: rows of ``df`` with a null key are kept, as pandas'
    ``~isin`` keeps them; a null in ``other`` removes nothing.  ``other`` is
    reduced to its distinct keys first, so a hot key on that side is one row.
    Rows with a null key match nothing; a salt from their other columns keeps
    them from meeting in one partition.  ``null_keys=False`` states that there
    are none (an audience): then a partitioning by the key is used as it is.
    """
    right = audience(other, other_key or key)
    if other_key and other_key != key:
        right = right.withColumnRenamed(other_key, key)
    if not null_keys or not df.schema[key].nullable:
        return df.join(right, on=key, how="left_anti")
    rest = [F.col(c) for c in df.columns if c != key] or [F.lit(0)]
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*rest), F.lit(_partitions(df)))).otherwise(0)
    salted = df.withColumn("_salt", salt.cast("int"))
    kept = salted.join(right.withColumn("_salt", no_salt(key)), on=[key, "_salt"], how="left_anti")
    return kept.select(*df.columns)


def restrict_to(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    keys_on: str | None = None,
    spread_by: str | None = None,
    bounded: bool = False,
    measure_from: int | None = MEASURE_FROM,
) -> DataFrame:
    """Rows of ``df`` whose ``on`` value is in ``keys``.

    Replaces "collect the ids, paste them into the next query": the key
    list stays distributed and becomes the (grouped) build side of a
    left-semi join.  ``df`` is the probe side and is joined as it is: when
    ``keys`` is small it is broadcast and ``df`` is not shuffled.

    With ``spread_by`` (a column of ``df`` that varies within an ``on``
    value, such as the account id of events keyed by city) a large probe is
    measured, and values found hot are salted by it (:func:`hot_values`).
    Without it ``df`` should hold each ``on`` value a bounded number of
    times, as a lookup table does.

    ``bounded=True`` asks for a broadcast of ``keys`` (regions, nations); it
    is done while the estimated size allows it (:func:`checked_broadcast`).
    """
    right = audience(keys, on, source=keys_on)
    if bounded:
        return df.join(checked_broadcast(right), on=on, how="left_semi")
    if spread_by is not None and (hot := hot_values(df, on, measure_from)):
        return semi_join_spread(df.where(F.col(on).isNotNull()), right, on, spread_by, hot)
    return df.join(right, on=on, how="left_semi")


def combine(left: DataFrame, right: DataFrame, key: str, how: str = "full") -> DataFrame:
    """Join two attribute-carrying audiences on the key.

    ``how="full"`` keeps keys of either side with one coalesced key column
    (pandas ``merge(how='outer', on=key)``); ``"left"``/``"inner"`` as named.
    Rows with a null key are removed from both sides first (audiences never
    hold one), so null keys never match each other.
    """
    lhs = left.where(F.col(key).isNotNull())
    rhs = right.where(F.col(key).isNotNull())
    return lhs.join(rhs, on=key, how=how)


# --------------------------------------------------------------------------
# nested IN (FROM ... GROUP BY ...) chains
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Link:
    """One level of a nested ``IN (FROM ... GROUP BY ...)`` query.

    ``df``  the dataset, already filtered.
    ``key`` the column this level hands to the level outside it (its
            ``GROUP BY``); an array column hands each element.
    ``on``  the column matched against the keys of the level inside it;
            None for the innermost level.
    ``bounded`` the keys this level hands outward are a small set of known
            bound -- the keys of a dimension table (regions, nations, a
            fixed list).  The next level then broadcasts them, which no
            amount of skew can hurt, instead of salting a shuffled join.
    """

    df: DataFrame
    key: str
    on: str | None = None
    bounded: bool = False


def semi_join_spread(
    rows: DataFrame,
    keys: DataFrame,
    on: str,
    spread_by: str | Sequence[str],
    hot: Sequence[tuple[object, int]],
    how: str = "left_semi",
) -> DataFrame:
    """``rows`` whose ``on`` value is in ``keys``, with the ``hot`` values salted.

    ``keys`` holds distinct values in column ``on`` (a grouping).  ``hot``
    comes from :func:`hot_values`: a hot value's rows get one of its salts
    from a hash of ``spread_by``, and its one build row is repeated per salt,
    so its rows are spread over that many tasks.  Every other value joins
    with salt 0.  The result is exact whatever the data: salting changes only
    where a row is joined.  ``hot`` has fewer values than there are shuffle
    partitions, which bounds the broadcast.  ``how="left"`` (or ``"inner"``)
    attaches the other columns of ``keys`` instead; rows without a value, which
    match nothing, are then spread as well.
    """
    schema = StructType(
        [StructField(on, rows.schema[on].dataType), StructField("_salts", IntegerType())]
    )
    table = F.broadcast(rows.sparkSession.createDataFrame(list(hot), schema))
    salts = F.coalesce(F.col("_salts"), F.when(F.col(on).isNull(), _partitions(rows)).otherwise(1))
    spread = [spread_by] if isinstance(spread_by, str) else list(spread_by)
    salt = F.pmod(F.xxhash64(*spread), salts).cast("int")
    probe = rows.join(table, on=on, how="left").select(*rows.columns, salt.alias("_salt"))
    replicas = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    build = keys.join(table, on=on, how="left").withColumn("_salt", F.explode(replicas))
    return probe.join(build.drop("_salts"), on=[on, "_salt"], how=how).drop("_salt")


def semi_chain(
    links: Sequence[Link],
    out: str | None = None,
    measure_from: int | None = MEASURE_FROM,
) -> DataFrame:
    """Evaluate nested semi-joins, innermost level first.

    Each level keeps the rows whose ``on`` value is among the keys the
    inner level produced, then hands on its own distinct keys: the join
    reduces the raw rows first, what is left is grouped (map-side partial
    aggregation) afterwards.  A small key set is broadcast and the level's
    rows are not shuffled by the join at all.  A level estimated at
    ``measure_from`` bytes or more is measured, and only values found hot are
    salted (0 measures every level, None none).  Returns one column named
    ``out`` (default: the outermost level's key).
    """
    if not links:
        raise ValueError("empty chain")
    first = links[0]
    if first.on is not None:
        raise ValueError("the innermost level has no 'on' column")
    current = _level_keys(first.df, first.key, "_on")
    inner_bounded = first.bounded
    for link in links[1:]:
        if link.on is None:
            raise ValueError(f"level keyed by {link.key!r} needs an 'on' column")
        probe = link.df.select(F.col(link.on).alias("_on"), F.col(link.key).alias("_v"))
        probe = probe.where(F.col("_on").isNotNull())
        if inner_bounded:
            kept = probe.join(checked_broadcast(current), on="_on", how="left_semi")
        elif link.on == link.key:
            # distinct values of a column joined on itself: nothing can be hot
            kept = probe.distinct().join(current, on="_on", how="left_semi")
        elif hot := hot_values(probe, "_on", measure_from):
            kept = semi_join_spread(probe, current, "_on", "_v", hot)
        else:
            kept = probe.join(current, on="_on", how="left_semi")
        if isinstance(kept.schema["_v"].dataType, ArrayType):
            kept = kept.select(F.explode("_v").alias("_v"))
        current = kept.where(F.col("_v").isNotNull()).select(F.col("_v").alias("_on")).distinct()
        inner_bounded = link.bounded
    return current.withColumnRenamed("_on", out or links[-1].key)


def _level_keys(df: DataFrame, col: str, alias: str) -> DataFrame:
    dtype = df.schema[col].dataType
    if isinstance(dtype, ArrayType):
        df = df.select(F.explode(F.col(col)).alias(col))
    return audience(df, alias, source=col)

"""Exact distinct counts that can be merged (A3).

A distinct count cannot be added up over days or groups, so each new question
would count the rows again.  Here every key has a dense number, a group's keys
are bitmaps over these numbers, 32768 to a bucket, and the union of groups or
days is an or of their buckets: no row is read again, and at most one bounded
row per group and bucket is shuffled.  Counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_IN_PARTITION = (1 << 33) - 1  # Spark numbers the rows of a partition in the lower 33 bits


def number_keys(df: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, id``: the dictionary ``known`` with the keys of ``df`` that it lacks.

    Ids are dense from 1 and stay with their keys.  Keys are numbered where a
    grouping put them; what goes round is one row per partition.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    after = 0
    if known is not None:
        keys = keys.join(known, key, "left_anti")
        after = known.agg(F.max("id")).first()[0] or 0
    placed = cut_lineage(  # written, so that a key has one number in all jobs
        keys.select(key, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.col("at").bitwiseAND(F.lit(_IN_PARTITION)) + F.col("first") + 1 + after
    new = placed.join(F.broadcast(first), "part").select(key, place.alias("id"))  # a row per partition
    return known.unionByName(new) if known is not None else new


def group_bitmaps(df: DataFrame, by: Sequence[str], key: str, ids: DataFrame) -> DataFrame:
    """``by..., bucket, bits``: each group's keys.  A group's repeated keys go before the join."""
    pairs = df.where(F.col(key).isNotNull()).select(*by, key).distinct().join(ids, key)
    bucket, place = F.bitmap_bucket_number("id"), F.bitmap_bit_position("id")
    return pairs.select(*by, bucket.alias("bucket"), place.alias("place")).groupBy(*by, "bucket").agg(
        F.bitmap_construct_agg("place").alias("bits")
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of the groups that agree in ``by`` (none: of all)."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, by: Sequence[str], alias: str) -> DataFrame:
    """Distinct keys of each group; ``bitmaps`` has one row per group and bucket."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(alias))

"""Attribute lookups restricted to an audience.

The reference pastes the audience's ids into a MySQL ``IN (...)`` list and
calls a lookup service with a list of ids.  Here the profile tables and the
advertiser reference table are DataFrames (Parquet, or ``spark.read.jdbc``
with partitioning options in production) and the restriction is a
left-semi join, so no id ever travels through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.algebra import (
    MEASURE_FROM,
    audience,
    checked_broadcast,
    hot_values,
    semi_join_spread,
)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table read in parallel ranges of ``partition_column``.

    Credentials come in ``properties`` from the caller; nothing is read
    from the environment here.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower_bound))
        .option("upperBound", str(upper_bound))
        .option("numPartitions", str(num_partitions))
    )
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def attach_profile(
    aud: DataFrame,
    key: str,
    primary: DataFrame,
    primary_key: str,
    primary_cols: Mapping[str, str],
    secondary: DataFrame | None = None,
    link: tuple[str, str] | None = None,
    secondary_cols: Mapping[str, str] | None = None,
    how: str = "left",
    secondary_bounded: bool = False,
    measure_from: int | None = MEASURE_FROM,
) -> DataFrame:
    """Attach profile attributes to an audience (S4 with the left join J6).

    ``primary`` (the e-mail table) is joined to ``aud`` on
    ``aud[key] == primary[primary_key]``; ``secondary`` (the name table) is
    left-joined to that on ``link = (primary column, secondary column)``.
    Column maps are ``{output name: stored name}``.

    Each table is met by one join.  ``how="left"`` keeps audience keys without
    a profile (the reference's outer merge); Spark's runtime filter cuts a
    large profile table down to the audience's keys before it is shuffled.
    ``how="inner"`` returns only keys that have a profile (the profile query).
    ``secondary_bounded=True`` states that the secondary table is a small
    dimension of fixed size (nations, regions): it is then broadcast (while
    its estimated size allows it).  Otherwise a link value that many profiles
    share is measured on the profile table, before any join, and salted, and
    so are rows without a link.
    """
    link_cols = [link[0]] if secondary is not None and link else []
    if secondary is not None and not link:
        raise ValueError("secondary table needs link=(primary column, secondary column)")
    p = primary.select(
        F.col(primary_key).alias(key),
        *[F.col(src).alias(dst) for dst, src in primary_cols.items()],
        *[F.col(c).alias(f"_link_{c}") for c in link_cols],
    ).where(F.col(key).isNotNull())
    out = aud.join(p, on=key, how=how)
    if secondary is None:
        return out
    lk = f"_link_{link[0]}"
    sec_cols = [F.col(src).alias(dst) for dst, src in (secondary_cols or {}).items()]
    if secondary_bounded:
        sec = secondary.select(F.col(link[1]).alias(lk), *sec_cols).where(F.col(lk).isNotNull())
        return out.join(checked_broadcast(sec), on=lk, how="left").drop(lk)
    if link[0] == primary_key:
        # The secondary table is keyed like the audience (names by account
        # id): join it on the audience key, which both sides are already
        # partitioned by, instead of re-shuffling on the link column.  The
        # extra condition keeps the reference's rule that names attach only
        # to rows that found a primary row.
        sec = secondary.select(F.col(link[1]).alias("_sk"), *sec_cols).where(
            F.col("_sk").isNotNull()
        )
        cond = (out[key] == sec["_sk"]) & out[lk].isNotNull()
        return out.join(sec, cond, how="left").drop("_sk", lk)
    sec = secondary.select(F.col(link[1]).alias(lk), *sec_cols).where(F.col(lk).isNotNull())
    return semi_join_spread(out, sec, lk, key, hot_values(p, lk, measure_from), how="left").drop(lk)


def employer_accounts(
    info: DataFrame, key: str, flag: Column | str, source: str | None = None
) -> DataFrame:
    """Accounts the reference table marks as employers (S5 + F10).

    ``flag`` is a column name (kept when not null, as ``advertiser_id``)
    or a boolean condition.  The reference asks the lookup service about the
    audience's ids only; here the anti-join that uses the result meets the
    audience anyway, so no join restricts it first.
    """
    cond = F.col(flag).isNotNull() if isinstance(flag, str) else flag
    return audience(info.where(cond), key, source=source)


def write_bucketed_lookup(
    df: DataFrame, table: str, key: str, buckets: int, path: str, mode: str = "overwrite"
) -> DataFrame:
    """Store an account-keyed lookup table bucketed (and sorted) by ``key``.

    Every market run joins the e-mail, name and advertiser tables by account
    id; read back as a bucketed table, their side of those joins is already
    hash-partitioned, so only the (smaller) audience side is shuffled.
    ``path`` should be in the shared storage; the table is registered in the
    session catalog under ``table``.
    """
    (
        df.write.mode(mode)
        .bucketBy(int(buckets), key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)

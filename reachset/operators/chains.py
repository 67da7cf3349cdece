"""Several nested semi-join chains over shared levels, each level read once.

Two audiences often follow the same chain of datasets and differ in a filter
or in the last levels.  Here a level is stated once for all its chains: every
key it hands outward carries a bitmask of the chains it belongs to.  A row
starts with the bits of the chains whose condition it meets, the join with the
level inside ands the bits of its key there, and the grouping ors the bits of
equal keys.  Bits that are left at the outermost level name the chains.

A chain may begin at a level further out (it has no restriction from inside)
and may end at a level further in (it takes no part outside of it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType

from ..session import cut_lineage
from .algebra import (
    MEASURE_FROM,
    checked_broadcast,
    hot_values,
    no_salt,
    semi_join_spread,
)


@dataclass(frozen=True)
class SharedLink:
    """One level of one or more chains.

    ``df``    the dataset, filtered by what all its chains ask for.
    ``keys``  chain name -> the column handed outward.  Chains that hand on
              different columns can only do so at the outermost shared level.
    ``on``    the column matched against the level inside; None if all the
              level's chains begin here.
    ``where`` chain name -> what this chain asks for besides.
    ``bounded`` as in :class:`~reachset.operators.algebra.Link`.
    """

    df: DataFrame
    keys: Mapping[str, str]
    on: str | None = None
    where: Mapping[str, Column] = field(default_factory=dict)
    bounded: bool = False


@dataclass(frozen=True)
class ChainKeys:
    """Keys of the outermost level and the chains that each belongs to."""

    frame: DataFrame
    columns: Mapping[str, str]
    bits: Mapping[str, int]

    def _has(self, name: str) -> Column:
        return F.col("_bits").bitwiseAND(F.lit(self.bits[name])) != 0

    def of(self, name: str, out: str) -> DataFrame:
        """The distinct keys of one chain, in a column named ``out``."""
        column = self.columns[name]
        keys = self.frame.where(self._has(name)).select(F.col(column).alias(out))
        return keys.distinct() if len(set(self.columns.values())) > 1 else keys

    def flags(self, out: str) -> DataFrame:
        """Every key with one boolean per chain (the chains hand on the same column)."""
        (column,) = set(self.columns.values())
        return self.frame.select(F.col(column).alias(out), *[self._has(n).alias(n) for n in self.columns])


def _some_value(kind: DataType) -> Column:
    """Stands for null in a key whose bits are gone, so that the column is never null.

    A key column that may be null would get a null filter from each join that
    reads it, pushed below the grouping; the readers' plans would then differ
    and Spark would compute the level once for each of them.
    """
    if isinstance(kind, StringType):
        return F.lit("")
    if isinstance(kind, NumericType):
        return F.lit(0).cast(kind)
    raise ValueError(f"keys of several columns must be numbers or text, not {kind.simpleString()}")


def _inside(rows: DataFrame, inner: DataFrame, begin: int, bounded: bool, measure_from: int | None) -> DataFrame:
    """``rows`` with the bits that they keep: those of their key inside, and those that begin here."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inner = inner.withColumnRenamed("_bits", "_inner")
    if not begin:
        rows = rows.where(F.col("_on").isNotNull())
    how = "left" if begin else "inner"
    spread = [c for c in rows.columns if c.startswith("_k")]
    if bounded:
        joined = rows.join(checked_broadcast(inner), "_on", how)
    elif hot := hot_values(rows, "_on", measure_from):
        joined = semi_join_spread(rows, inner, "_on", spread, hot, how=how)
    elif begin:
        # rows without a key to match would meet in one partition
        salt = F.when(F.col("_on").isNull(), F.pmod(F.xxhash64(*spread), F.lit(partitions))).otherwise(0)
        joined = rows.withColumn("_salt", salt.cast("int")).join(
            inner.withColumn("_salt", no_salt("_on")), ["_on", "_salt"], "left"
        ).drop("_salt")
    else:
        joined = rows.join(inner, "_on", how)
    kept = F.coalesce(F.col("_inner"), F.lit(0).cast("long")).bitwiseOR(F.lit(begin))
    return joined.withColumn("_bits", F.col("_bits").bitwiseAND(kept)).drop("_inner", "_on").where("_bits != 0")


def shared_chains(
    links: Sequence[SharedLink], measure_from: int | None = MEASURE_FROM, cut: bool = False
) -> ChainKeys:
    """Evaluate the levels, innermost first, each read and joined once for all its chains.

    ``cut`` writes the result to the checkpoint folder (one job), for readers
    whose plans are too different to share it.
    """
    if not links:
        raise ValueError("no levels")
    names = list(dict.fromkeys(n for link in links for n in link.keys))
    if len(names) > 62:
        raise ValueError("62 chains at most")
    bits = {n: 1 << i for i, n in enumerate(names)}
    seen: set[str] = set()
    inner: DataFrame | None = None
    bounded = False
    for number, link in enumerate(links):
        begin = reduce(int.__or__, (bits[n] for n in link.keys if n not in seen), 0)
        if link.on is None and seen & set(link.keys):
            raise ValueError("a level with chains from inside needs an 'on' column")
        columns = list(dict.fromkeys(link.keys.values()))
        kinds = [link.df.schema[c].dataType for c in columns]
        if len(columns) > 1 and number < len(links) - 1:
            raise ValueError("only the outermost shared level can hand on different columns")
        rows = link.df
        if set(link.keys) <= set(link.where):  # a filter that reaches the scan
            rows = rows.where(reduce(Column.__or__, (link.where[n] for n in link.keys)))
        own = F.lit(0).cast("long")
        for n, c in link.keys.items():
            asked = F.coalesce(link.where.get(n, F.lit(True)), F.lit(False)) & F.col(c).isNotNull()
            own = own.bitwiseOR(F.when(asked, F.lit(bits[n]).cast("long")).otherwise(0))
        kept = [
            (F.coalesce(F.col(c), _some_value(k)) if len(columns) > 1 else F.col(c)).alias(f"_k{i}")
            for i, (c, k) in enumerate(zip(columns, kinds))
        ]
        matched = [F.col(link.on).alias("_on")] if link.on and inner is not None else []
        rows = rows.select(*kept, *matched, own.alias("_bits")).where("_bits != 0")
        if matched:
            rows = _inside(rows, inner, begin, bounded, measure_from)
        if isinstance(kinds[0], ArrayType):
            rows = rows.select(F.explode("_k0").alias("_k0"), "_bits").where(F.col("_k0").isNotNull())
        groups = [f"_k{i}" for i in range(len(columns))]
        grouped = rows.groupBy(*groups).agg(F.bit_or("_bits").alias("_bits"))
        seen |= set(link.keys)
        inner, bounded = grouped.withColumnRenamed("_k0", "_on"), link.bounded
    place = {c: f"_k{i}" for i, c in enumerate(columns)}
    return ChainKeys(
        cut_lineage(grouped) if cut else grouped,
        {n: place[c] for n, c in link.keys.items()},
        {n: bits[n] for n in link.keys},
    )

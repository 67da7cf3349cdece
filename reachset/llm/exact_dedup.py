"""Exact dedup by a heavy-hitter split (JVM-side only).

A Misra-Gries pass (``DataFrame.stat.freqItems``: Karp, Schenker and
Papadimitriou's form of it) names at most ``1 / support`` digests that may
be frequent; every digest held by more than ``support`` of the rows is among
them.  One aggregation verifies them: exact count, and smallest id.  That
table is bounded by ``1 / support`` rows whatever the corpus, so it is
broadcast, and copies of a frequent text are decided on the map side.  Only
the remaining digests, none of them frequent, are shuffled.

Texts are equal when identical after each run of blanks is replaced by one
space.  Defined results: a null text is the empty text; a null id loses to
any id and an all-null group keeps one row with a null ``keep_id``; rows
repeated with the same id count as copies, the one with the smallest row number
stays (so a frequent text is decided on the map side whatever its ids); an empty table
gives an empty result; other columns are ignored by :func:`dedup_table` and
returned untouched, whatever their names, by :func:`drop_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, documents, materialize, whole_text

#: A digest held by more than this share of the rows is split off.
SUPPORT = 1 / 256


def text_digest(text: str = "text") -> Column:
    """SHA-256 (lowercase hex) of the blank-normalised text in UTF-8."""
    return F.sha2(F.encode(F.regexp_replace(whole_text(text), BLANKS, " "), "UTF-8"), 256)


def heavy_digests(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified frequent digests: ``(digest, heavy_row, heavy_keep, heavy_size)``.

    ``digests`` has ``id, row, digest``.  The winner is the row with the smallest
    id, null last, then the smallest row number.  At most ``1 / support`` rows.
    A candidate that turns out to hold no more than ``support`` of the rows, or
    one row, is left to the ordinary path.
    """
    least = max(1.0, support * digests.count())
    found = digests.select("digest").freqItems(["digest"], support).first()
    candidates = [d for d in (found[0] if found and found[0] else []) if d is not None]
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    return (
        digests.where(F.col("digest").isin(candidates) if candidates else F.lit(False))
        .groupBy("digest")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("heavy_size"))
        .where(F.col("heavy_size") > least)
        .select("digest", F.col("first.row").alias("heavy_row"), F.col("first.id").alias("heavy_keep"), "heavy_size")
    )


def _decided(digests: DataFrame, support: float) -> DataFrame:
    """``row, id, keep_id, group_size, kept, digest`` of every row of ``digests``."""
    marked = digests.join(F.broadcast(heavy_digests(digests, support)), "digest", "left")
    lost = F.coalesce(F.col("heavy_row") != F.col("row"), F.lit(False))  # a copy of a frequent text
    map_side = marked.where(lost).select(
        "row", "id", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"),
        F.lit(False).alias("kept"), "digest",
    )
    group = Window.partitionBy("digest")
    ordered = group.orderBy(F.col("id").asc_nulls_last(), "row")
    shuffled = marked.where(~lost).select(
        "row", "id", F.min("id").over(group).alias("keep_id"),
        F.coalesce(F.col("heavy_size"), F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(ordered) == 1).alias("kept"), "digest",
    )
    return map_side.unionByName(shuffled)


def dedup_table(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, text_sha256``."""
    digests = materialize(
        docs.select(
            F.col(id_col).alias("id"), text_digest(text).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    return _decided(digests, support).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows that stay, with all their columns."""
    whole = materialize(  # written, so that a row has one number in all jobs
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("doc"), text_digest(text).alias("digest"),
            F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
        ),
        "numbered",
        "zstd",
    )
    gone = _decided(whole.select("id", "row", "digest"), support).where("not kept").select("row")
    return whole.join(gone, "row", "left_anti").select("doc.*")


def op4_exact_dedup(spark, sf_dir):
    return dedup_table(documents(spark, sf_dir))


OP4_SQL = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h
  from documents
)
select doc_id, min(doc_id) over (partition by h) as keep_id,
       count(*) over (partition by h) as group_size,
       row_number() over (partition by h order by doc_id nulls last) = 1 as kept,
       h as text_sha256
from d
"""

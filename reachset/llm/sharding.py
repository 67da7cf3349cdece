"""Sharding by sampled splitters (JVM-side only).

Documents are ordered by ``(hash of the text, id, row number)`` and cut into shards of
nearly equal bytes (law ``bytes``).  A size-weighted sample of keys (the
``n_ranges * per_range`` smallest of ``-ln(u) / size``, ``u`` a hash of the
key) gives quantile boundaries; records fall into the ranges between them.
Exact bytes per range are then summed, and a range that came out overfull is
sampled again and subdivided until none is, or only one row is left in it
(copies of a row have keys of their own, by a row number written once).
Ranges are the unit of parallel work: each one's running sum of bytes plus
the bytes of all ranges before it places a document in the whole order, so
shards are cut where the bytes say and a hot group of equal texts spreads
over as many ranges and shards as its bytes need.  Only boundaries and range
totals (bounded by the parameters) reach the driver.

Defined results: a null text is empty (0 bytes, plus ``overhead``); a null
id sorts first among equal texts; repeated rows each get their own slot; an
empty table gives an empty result.  A document belongs to the shard that
holds its middle byte, so a shard's bytes are off by half a document at each
end at most.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize, whole_text

#: A range above this many times its fair share is subdivided.
OVERFULL = 2.0


def _key(h: str, id_col: str, row: str) -> Column:
    """``(hash, id, row number)`` as text, so that splitters are plain strings."""
    wide = lambda c: F.lpad(F.hex(c), 16, "0")
    named = F.coalesce(F.concat(F.lit("1"), wide(F.col(id_col))), F.lit("0"))
    return F.concat(wide(F.col(h)), named, wide(F.col(row)))


def _sample_keys(rows: DataFrame, size: int) -> list[str]:
    """The size-weighted sample, sorted: a bounded top-k, reruns agree."""
    u = (F.xxhash64("key", F.lit(17)).bitwiseAND((1 << 52) - 1) + 1) / F.lit(float(1 << 52))
    picked = rows.select("key", (-F.log(u) / F.col("size")).alias("p")).orderBy("p", "key")
    return sorted(r.key for r in picked.limit(size).select("key").collect())


def _boundaries(keys: list[str], pieces: int) -> list[str]:
    """The ``pieces - 1`` inner quantiles of a sorted sample, without repeats."""
    inner = {keys[len(keys) * i // pieces] for i in range(1, pieces)} if keys else set()
    return sorted(inner)


def _with_range(rows: DataFrame, splitters: list[str]) -> DataFrame:
    """``range``: how many splitters are <= the key, by two short scans."""
    if not splitters:
        return rows.withColumn("range", F.lit(0))
    step = max(1, int(len(splitters) ** 0.5))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    at_most = lambda keys: F.size(F.filter(keys, lambda s: s <= F.col("key")))
    heads = F.split(F.lit(",".join(b[0] for b in blocks)), ",")
    block = F.split(F.lit(";".join(",".join(b) for b in blocks)), ";")
    inside = at_most(F.split(F.get(block, F.col("block_no") - 1), ","))
    return (
        rows.withColumn("block_no", at_most(heads))
        .withColumn(
            "range",
            F.when(F.col("block_no") == 0, 0).otherwise((F.col("block_no") - 1) * step + inside),
        )
        .drop("block_no")
    )


def _totals(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    got = ranged.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")
    )
    return {r["range"]: (r.n, r.b) for r in got.collect()}


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text: str = "text",
    overhead: int = 8,
    n_ranges: int = 384,
    per_range: int = 16,
    max_rounds: int = 4,
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    spark = docs.sparkSession
    body = F.encode(whole_text(text), "UTF-8")
    rows = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(whole_text(text)) + overhead).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(whole_text(text)).alias("h"),
            F.monotonically_increasing_id().alias("row"),
        ).select("id", "size", "text_crc32", _key("h", "id", "row").alias("key")),
        "shard-keys",
    )
    splitters = _boundaries(_sample_keys(rows, n_ranges * per_range), n_ranges)
    for _ in range(max_rounds):
        totals = _totals(ranged := _with_range(rows, splitters))
        fair = sum(b for _, b in totals.values()) / n_ranges
        full = {r: b for r, (n, b) in totals.items() if b > OVERFULL * fair and n > 1}
        if not full:
            break
        more = _sample_keys(ranged.where(F.col("range").isin(list(full))), per_range * n_ranges)
        by_range: dict[int, list] = {}
        for k in more:
            by_range.setdefault(bisect_right(splitters, k), []).append(k)
        new = {
            s
            for r, b in full.items()
            for s in _boundaries(by_range.get(r, []), max(2, round(b / fair)))
        } - set(splitters)
        if not new:
            break
        splitters = sorted({*splitters, *new})

    totals = _totals(_with_range(rows, splitters))
    count = len(splitters) + 1
    n = np.array([totals.get(r, (0, 0))[0] for r in range(count)], dtype=np.int64)
    b = np.array([totals.get(r, (0, 0))[1] for r in range(count)], dtype=np.int64)
    total = max(1, int(b.sum()))
    starts = spark.createDataFrame(
        [(r, int(x), int(y)) for r, x, y in zip(range(count), np.cumsum(n) - n, np.cumsum(b) - b)],
        "range int, rows_before long, bytes_before long",
    )
    order = Window.partitionBy("range").orderBy("key")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("bytes_before") + F.sum("size").over(upto) - F.col("size") / 2
    placed = materialize(
        _with_range(rows, splitters)
        .join(F.broadcast(starts), "range")
        .select(
            "id",
            "size",
            "text_crc32",
            F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(order) - 1).alias("place"),
        ),
        "shard-places",
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sampled_splitters(spark, sf_dir):
    return shard_documents(documents(spark, sf_dir))

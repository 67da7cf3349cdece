"""Best-fit packing of token sequences, bulk-synchronously.

Documents are encoded where they lie and cut into pieces of at most
``capacity`` tokens; a full piece is a sequence of its own.  The others are
*items*, the open sequences' free space are *gaps*.  One round is one sweep:

1. items and gaps are sorted by size together, an item before a gap of the
   same size.  The order is by ranges: a class is one size, one kind and one
   of ``salts`` hash slices, rows are ranked inside their class, and the
   table of class counts (bounded by capacity and salts, whatever the corpus;
   the only thing that reaches the driver) gives what stands before each;
2. ascending, an item opens a level and a gap closes one, so a gap meets the
   largest item that fits and is not taken by a smaller gap.  An item and
   the gap that follows it on the same level match; competing gaps and items
   are told apart by rank, so no gap is taken twice;
3. matched gaps shrink by their item; a gap with no match fits nothing left
   and is closed.

When no gap is left, as many empty sequences are opened as the items' total
needs, and sweeping goes on.  Items far smaller than the gaps are first
bundled with their neighbours in size order, which bounds the sweeps.  While
there are bundles no gap is closed: when no gap fits one, the bundles left are
opened, their items make bundles ``ratio`` times smaller, and so on down to
single items, before a sequence is opened.  Each round is written to the
shared folder, so losing executors costs a re-read.

Defined results: a null text is empty and gives one piece, the end token; a
piece is one row, also for repeated documents and null ids; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize
from .tokens import default_tokenizer, encoder

ITEM, GAP, PLACED = 0, 1, 2


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text: str
) -> DataFrame:
    """One row per piece of every document."""
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    @F.pandas_udf("array<struct<start:long,length:int,ids_crc32:long>>")
    def pieces(texts: pd.Series) -> pd.Series:
        out = []
        for ids in encoder(tokenizer).encode(texts):
            ids += end
            parts = [(at, ids[at : at + step]) for at in range(0, len(ids), step)]
            out.append(
                [
                    {"start": at // 4, "length": len(x) // 4, "ids_crc32": zlib.crc32(x)}
                    for at, x in parts
                ]
            )
        return pd.Series(out)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.posexplode(pieces(F.col(text)))
    ).select("doc_id", F.col("pos").alias("piece"), "col.*")


def class_counts(events: DataFrame, salts: int) -> pd.DataFrame:
    """Rows of each class, in sweep order; bounded by the capacity and the salts."""
    got = _sliced(events, salts).groupBy("size", "kind", "salt").agg(F.count(F.lit(1)).alias("n"))
    return got.toPandas().sort_values(["size", "kind", "salt"], ignore_index=True)


def _sliced(events: DataFrame, salts: int) -> DataFrame:
    return events.withColumn("salt", F.pmod(F.xxhash64("id", "kind"), F.lit(salts)).cast("int"))


def _ranked(events: DataFrame, counts: pd.DataFrame, salts: int) -> DataFrame:
    """Each event with its ``level`` (items less gaps up to it) and ``volume`` (sizes before it)."""
    step = counts["n"].where(counts["kind"] == ITEM, -counts["n"])
    volume = counts["size"].astype("int64") * counts["n"]
    starts = events.sparkSession.createDataFrame(
        counts[["size", "kind", "salt"]].assign(
            level_before=step.cumsum() - step, volume_before=volume.cumsum() - volume
        ),
        "size int, kind int, salt int, level_before long, volume_before long",
    )
    in_class = Window.partitionBy("size", "kind", "salt").orderBy("id")
    return (
        _sliced(events, salts)
        .join(F.broadcast(starts), ["size", "kind", "salt"])
        .withColumn("rank", F.row_number().over(in_class))
        .withColumn(
            "level",
            F.col("level_before")
            + F.when(F.col("kind") == ITEM, F.col("rank")).otherwise(1 - F.col("rank")),
        )
        .withColumn("volume", F.col("volume_before") + (F.col("rank") - 1) * F.col("size"))
    )


def sweep(
    events: DataFrame, counts: pd.DataFrame, capacity: int, salts: int, keep: bool = False
) -> DataFrame:
    """One round: placed items, items left and gaps that took an item (``keep``: all gaps)."""
    on_level = Window.partitionBy("level").orderBy("size", "kind")
    seen = _ranked(events, counts, salts).select(
        "id",
        "size",
        "kind",
        F.lag(F.struct("id", "size", "kind")).over(on_level).alias("below"),
        (F.lead("kind").over(on_level) == GAP).alias("taken"),
    )
    matched = (F.col("kind") == GAP) & (F.col("below.kind") == ITEM)
    nothing = F.lit(None).cast("long")

    def row(id_: Column, size: Column, kind: int, bin_: Column = nothing, at: Column = nothing):
        return F.struct(
            id_.alias("id"), size.cast("int").alias("size"), F.lit(kind).alias("kind"),
            bin_.alias("bin"), at.cast("int").alias("at"),
        )

    size, below = F.col("size"), F.col("below")
    out = F.when(
        matched,
        F.array(
            row(below["id"], below["size"], PLACED, F.col("id"), capacity - size),
            row(F.col("id"), size - below["size"], GAP),
        ),
    ).when(
        (F.col("kind") == ITEM) & ~F.coalesce(F.col("taken"), F.lit(False)),
        F.array(row(F.col("id"), size, ITEM)),
    )
    if keep:
        out = out.when(F.col("kind") == GAP, F.array(row(F.col("id"), size, GAP)))
    return seen.select(F.explode(out).alias("e")).select("e.*")


def _bundle(
    items: DataFrame, counts: pd.DataFrame, limit: int, first_id: int, salts: int
) -> DataFrame:
    """Neighbours in size order joined into bundles of about ``limit`` tokens:
    ``child, id, at, size`` (``size``: the child's)."""
    ranked = _ranked(items, counts, salts).withColumn("no", F.floor(F.col("volume") / limit))
    in_bundle = Window.partitionBy("no")
    return ranked.select(
        F.col("id").alias("child"),
        (F.lit(first_id) + F.col("no")).cast("long").alias("id"),
        (F.col("volume") - F.min("volume").over(in_bundle)).cast("int").alias("at"),
        "size",
    )


def _event(kind: int) -> list[Column]:
    return [
        F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("bin"),
        F.lit(None).cast("int").alias("at"),
    ]


def place(items: DataFrame, capacity: int, salts: int = 32, ratio: int = 8) -> DataFrame:
    """``id, size`` with sizes below the capacity to ``id, bin, at``."""
    spark = items.sparkSession
    large = F.col("size") > capacity // 2  # no two of them fit one sequence: each opens its own
    opening = items.select(
        "id", "size", F.when(large, PLACED).otherwise(ITEM).alias("kind"),
        F.when(large, F.col("id")).alias("bin"), F.when(large, 0).alias("at"),
    )
    seeds = items.where(large).select("id", (capacity - F.col("size")).alias("size"), *_event(GAP))
    state = materialize(opening.unionByName(seeds), "pack")
    placed = [state.where(F.col("kind") == PLACED).select("id", "bin", "at")]
    bundles: list[DataFrame] = []
    new_bin = -1  # bins opened here count down; those of large items have the item's id
    new_item = 1 << 62
    made, limit = None, 0  # the bundles that are open and about how large they are
    while True:
        open_ = state.where(F.col("kind") != PLACED)
        counts = class_counts(open_, salts)
        left = counts[counts["kind"] == ITEM]
        if not len(left):
            break
        least = int(left["size"].min())
        total = int((left["size"].astype("int64") * left["n"]).sum())
        gaps = counts[(counts["kind"] == GAP) & (counts["size"] >= least)]
        fits = (F.col("kind") == ITEM) | (F.col("size") >= least)
        idle = open_.where(~fits)
        if len(gaps):
            events = open_.where(fits)
            counts = pd.concat([left, gaps]).sort_values(["size", "kind", "salt"])
        else:
            remaining = open_.where(F.col("kind") == ITEM)
            if made is not None:  # no gap fits a bundle: their items may fit
                whole = remaining.join(made.select("id").distinct(), "id", "left_anti")
                opened = made.join(remaining.select("id"), "id", "left_semi").select(
                    F.col("child").alias("id"), "size", *_event(ITEM)
                )
                remaining = materialize(whole.unionByName(opened), "pack")
                limit //= ratio
                made = None
            else:
                limit = capacity // ratio
                idle = None  # no gap fits an item
                needed = -(-total // capacity)
                empty = spark.range(new_bin - needed + 1, new_bin + 1).select(
                    "id", F.lit(capacity).alias("size"), *_event(GAP)
                )
                new_bin -= needed
            left = class_counts(remaining, salts)
            most = int(left["size"].max())
            # larger items stay single beside the bundles
            small = left[left["size"] <= limit // 4]
            volume = int((small["size"].astype("int64") * small["n"]).sum())
            if (idle is not None or most <= limit) and limit > 1 and volume > limit:
                single = remaining.where(F.col("size") > int(small["size"].max()))
                few = remaining.where(F.col("size") <= int(small["size"].max()))
                made = materialize(_bundle(few, small, limit, new_item, salts), "bundles")
                bundles.append(made.select("child", "id", "at"))
                new_item += -(-volume // limit) + 1
                remaining = single.unionByName(
                    made.groupBy("id").agg(F.sum("size").cast("int").alias("size")).select(
                        "id", "size", *_event(ITEM)
                    )
                )
            if idle is not None:
                state = remaining.unionByName(open_.where(F.col("kind") == GAP))
                state = materialize(state, "pack")
                continue
            events = remaining.unionByName(empty)
            counts = class_counts(events, salts)
        state = sweep(events, counts, capacity, salts, made is not None)
        if made is not None:
            state = state.unionByName(idle) if idle is not None else state
        state = materialize(state, "pack")
        placed.append(state.where(F.col("kind") == PLACED).select("id", "bin", "at"))
    result = placed[0]
    for more in placed[1:]:
        result = result.unionByName(more)
    for members in reversed(bundles):
        inside = members.withColumnRenamed("at", "inside")
        opened = inside.join(result, "id").select(
            F.col("child").alias("id"), "bin", (F.col("at") + F.col("inside")).alias("at")
        )
        result = result.join(members.select("id").distinct(), "id", "left_anti").unionByName(opened)
    return result


def pack(
    docs: DataFrame,
    capacity: int = 4096,
    end_id: int = 1,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = cut_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, id_col, text)
    pieces = materialize(cut.withColumn("id", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "*", F.col("id").alias("bin"), F.lit(0).alias("at")
    )
    rest = pieces.where(F.col("length") < capacity)
    placed = place(rest.select("id", F.col("length").alias("size")), capacity)
    return whole.unionByName(rest.join(placed, "id")).select(
        F.col("doc_id").alias(id_col), "piece", "start", F.col("length").cast("long"), "ids_crc32",
        F.col("bin").alias("sequence_id"), F.col("at").cast("long").alias("offset"),
    )


def op8_best_fit_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))

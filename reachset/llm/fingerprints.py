"""I-Match document fingerprints (JVM-side only).

A document keeps its distinct terms whose inverse document frequency lies in
a band (very common and very rare terms go), sorted, and hashes what it keeps
in each of many randomised subsets of the lexicon.  Subset ``(r, l)`` holds a
term if ``l`` bits of its hash's ``r``-th slice are zero, a share ``2 ** -l``
of the lexicon, so long and short documents both have subsets in which they
keep only a few terms.  Two fingerprints agree on a subset if the kept terms
are the same; ``likeness`` is the share that agrees among the ``informative``
sparsest subsets in which either keeps anything.

The lexicon is bounded: a term in the band is in at least ``exp(-max_idf)``
of the documents, so there are at most ``exp(max_idf)`` times the mean number
of distinct terms of a document.  It is counted all the same, and broadcast
only up to ``broadcast_terms``; beyond that the join shuffles.

The next document in descending id order comes from range buckets of ids: a
bucket's rows are read in order, and the first row of the bucket below is
copied to its end, so there is no global sort in one task.

Defined results: a null text is empty, its fingerprint keeps nothing and is
like another such one (1.0); a document without a term in the band falls
back to one term that stands for all its terms; equal ids are ordered by a
hash of the text, null ids come last; an only document follows itself; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize, whole_text

MIN_IDF, MAX_IDF = 0.8, 8.0
#: Subset shares 2**-l, the densest first; each has REPLICAS subsets.  A sparser subset of
#: a replica lies within its denser ones.
LEVELS = (3, 5, 7, 9, 11)
REPLICAS = 12
BITS = 12
#: Spark's hash of an empty array: the subset keeps nothing.
NOTHING = 42


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits, as 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str, min_idf: float, max_idf: float) -> DataFrame:
    """Hashes of the terms whose ``ln(documents / df)`` is in the band, counted over all rows."""
    n = docs.count()
    return (
        docs.select(F.explode(terms(whole_text(text))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where((F.col("df") <= n * math.exp(-min_idf)) & (F.col("df") >= n * math.exp(-max_idf)))
        .select("term")
    )


def _has_no(mask: int):
    return lambda term: term.bitwiseAND(mask) == 0


def hash_subsets(rows: DataFrame, sides: tuple[str, ...], keep: list[str]) -> DataFrame:
    """``rows`` with each side's sorted terms replaced by its subset hashes, the sparsest
    subsets first, the whole lexicon last.

    One projection per level: each filters the arrays of the one before it.
    """
    slices = 64 // BITS - 1  # taken from one 64-bit hash
    done: list[str] = []
    # the terms' own hashes decide for the first replicas, hashes of hashes after that
    for k in range(1, -(-REPLICAS // slices)):
        rows = rows.select(
            "*", *[F.transform(s if k == 1 else f"{s}_{k - 1}", lambda t: F.xxhash64(t)).alias(f"{s}_{k}")
                   for s in sides]
        )
    current = {(s, r): s if r < slices else f"{s}_{r // slices}" for s in sides for r in range(REPLICAS)}
    whole = [F.hash(s).alias(f"{s}_whole") for s in sides]
    for level in LEVELS:
        masks = [((1 << level) - 1) << (BITS * (r % slices)) for r in range(REPLICAS)]
        arrays = {(s, r): f"{s}_at{level}_{r}" for s, r in current}
        hashes = [] if level == LEVELS[0] else [
            F.hash(c).alias(f"{c}_hash") for c in current.values()
        ]
        rows = rows.select(
            *keep, *done, *whole, *hashes,
            *[F.filter(c, _has_no(masks[r])).alias(arrays[s, r]) for (s, r), c in current.items()],
        )
        if whole:
            done += [f"{s}_whole" for s in sides]
        done += [f"{c}_hash" for c in current.values()] if hashes else []
        whole, current = [], arrays
    rows = rows.select(*keep, *done, *[F.hash(c).alias(f"{c}_hash") for c in current.values()])
    return rows.select(
        *keep,
        *[
            F.array(
                *[f"{s}_at{level}_{r}_hash" for level in reversed(LEVELS) for r in range(REPLICAS)],
                f"{s}_whole",
            ).alias(s)
            for s in sides
        ],
    )


def likeness(a: Column, b: Column, informative: int = 12) -> Column:
    agree = F.zip_with(
        a, b,
        lambda x, y: F.when((x == NOTHING) & (y == NOTHING), -1).when(x == y, 1).otherwise(0),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("same"))
    return F.aggregate(
        agree, start,
        lambda acc, v: F.when(
            (v >= 0) & (acc["n"] < informative),
            F.struct((acc["n"] + 1).alias("n"), (acc["same"] + v).alias("same")),
        ).otherwise(acc),
        lambda acc: F.when(acc["n"] == 0, 1.0).otherwise(acc["same"] / acc["n"]),
    )


def as_text(hashes: Column) -> Column:
    return F.array_join(
        F.transform(
            hashes,
            lambda x: F.when(x == NOTHING, "-").otherwise(
                F.lower(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)))
            ),
        ),
        ".",
    )


def with_next_text(docs: DataFrame, id_col: str, text: str, buckets: int) -> DataFrame:
    """``bucket, no, id, text, next_text, extra``: rows by descending id inside range buckets.

    Each bucket ends with an ``extra`` row, a copy of the document after its last one.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), whole_text(text).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = rows.select(F.percentile_approx("id", shares, 100 * buckets)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col("id")))

    def numbers(joined: Column) -> Column:
        return F.split(joined, ",").cast("array<bigint>")

    if blocks:
        head = at_most(numbers(F.lit(",".join(str(b[0]) for b in blocks))))
        block = F.split(F.lit(";".join(",".join(map(str, b)) for b in blocks)), ";")
        rows = rows.withColumn("head", head)
        inside = at_most(numbers(F.get(block, F.col("head") - 1)))
        bucket = F.when(F.col("head") == 0, 0).otherwise((F.col("head") - 1) * step + inside)
        rows = rows.withColumn("bucket", F.coalesce(bucket, F.lit(0))).drop("head")
    else:
        rows = rows.withColumn("bucket", F.lit(0))

    tops = sorted(  # one row for each bucket
        rows.groupBy("bucket").agg(F.max(F.struct("id", "h")).alias("top")).collect(),
        key=lambda r: -r.bucket,
    )
    ends: dict[int, int] = {}  # the bucket that a top row also ends, by its own bucket
    for r, below in zip(tops, [*tops[1:], *tops[:1]]):
        ends[below.bucket] = r.bucket
    plan = docs.sparkSession.createDataFrame(
        [(r.bucket, r.top.id, r.top.h, ends[r.bucket]) for r in tops],
        "bucket int, top_id long, top_h long, ends int",
    )
    is_top = F.col("id").eqNullSafe(F.col("top_id")) & (F.col("h") == F.col("top_h"))

    def place(b: str, extra: bool) -> Column:
        return F.struct(F.col(b).alias("bucket"), F.lit(extra).alias("extra"))

    copies = F.when(is_top, F.array(place("bucket", False), place("ends", True))).otherwise(
        F.array(place("bucket", False))
    )
    spread = rows.join(F.broadcast(plan), "bucket").select(
        F.explode(copies).alias("place"), "id", "text", "h"
    ).select("place.*", "id", "text", "h")
    # as many tasks as asked for: the work on a byte is far more than its shuffle
    spread = spread.repartition(max(1, buckets // 2), "bucket")
    order = Window.partitionBy("bucket").orderBy(
        "extra", F.col("id").desc_nulls_last(), F.col("h").desc()
    )
    return spread.select(
        "bucket", F.row_number().over(order).alias("no"), "id", "text",
        F.lead("text").over(order).alias("next_text"), "extra",
    )


def fingerprint_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_idf: float = MIN_IDF,
    max_idf: float = MAX_IDF,
    buckets: int | None = None,
    broadcast_terms: int = 4_000_000,
) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    band = materialize(lexicon(docs, text, min_idf, max_idf), "lexicon")
    known = band.withColumnRenamed("term", "known")
    known = F.broadcast(known) if band.count() <= broadcast_terms else known

    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - third),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third),
    )
    rows = with_next_text(docs, id_col, text, buckets).select(
        "bucket", "no", "text", edited.alias("edited"),
        F.struct(
            "id", "extra", n.cast("long").alias("n_chars"),
            F.sha2(F.encode(edited, "UTF-8"), 256).alias("edited_sha256"),
        ).alias("info"),
    )
    sides = rows.select(
        "bucket",
        "no",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("which"), terms(F.col("text")).alias("terms"), "info"),
                F.struct(
                    F.lit(1).alias("which"), terms(F.col("edited")).alias("terms"),
                    F.when(F.lit(False), F.col("info")).alias("info"),
                ),
            )
        ).alias("side"),
    )
    # what a document has besides its terms is on one of its rows only: narrow rows to sort
    found = sides.select("bucket", "no", "side.*").select(
        "bucket", "no", "which", "info", F.posexplode_outer("terms").alias("pos", "term")
    ).withColumn("info", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("info"))).drop("pos")
    found = found.join(known, F.col("term") == F.col("known"), "left")

    def side(which: int, name: str) -> list[Column]:
        here = F.col("which") == which
        return [
            F.collect_list(F.when(here, F.col("known"))).alias(f"{name}_kept"),
            F.bit_xor(F.when(here, F.col("term"))).alias(f"{name}_all"),
        ]

    # rows lie by bucket already, so this needs no further shuffle
    sets = found.groupBy("bucket", "no").agg(
        F.max("info").alias("info"), *side(0, "own"), *side(1, "edited")
    ).select("bucket", "no", "info.*", "own_kept", "own_all", "edited_kept", "edited_all")
    key = ["bucket", "no", "id", "extra", "n_chars", "edited_sha256"]

    def kept(name: str) -> Column:
        stand_in = F.when(F.col(f"{name}_all").isNotNull(), F.array(f"{name}_all")).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.when(F.size(f"{name}_kept") > 0, F.array_sort(f"{name}_kept")).otherwise(stand_in)

    prints = hash_subsets(
        sets.select(*key, kept("own").alias("own"), kept("edited").alias("changed")),
        ("own", "changed"), key,
    )
    order = Window.partitionBy("bucket").orderBy("no")
    return (
        prints.withColumn("following", F.lead("own").over(order))
        .where(~F.col("extra"))
        .select(
            F.col("id").alias(id_col),
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )


def op10_i_match(spark, sf_dir):
    return fingerprint_documents(documents(spark, sf_dir))

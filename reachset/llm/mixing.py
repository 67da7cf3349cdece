"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target share of all words (water-filled: no target over
``max_repeat`` times the source).  A document is taken ``floor(f)`` times,
``f = target / source size``, and once more with inclusion probability
``frac(f)``.  The cube method turns those probabilities into 0 or 1 while
keeping, in every source, the expected words and the expected number of
documents: three undecided documents have a direction that leaves both sums
unchanged (the null space of a 2 x 3 matrix), and a random step along it,
fair in expectation, decides at least one of them (flight).  Sources are cut
into blocks of ``block`` documents, so a hot source is many tasks; a block
leaves at most two documents undecided, which meet again in fewer blocks of
the next level, until two per source are left: the landing problem, solved by
the rounding that misses the word total least, one more document of the last
block being turned in or out where that helps.

Defined results: a null text has no words (size 0); a null source is a
source, last in order; null ids and repeated rows are documents of their own;
an empty table gives an empty result; a source without words has target 0.
Random steps are seeded by source, level and block, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, materialize, whole_text

EPSILON = 1e-9


def water_fill(sizes: list[int], weights: list[float], max_repeat: float) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``max_repeat`` times its size."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if total * weights[i] / weight >= max_repeat * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = total * weights[i] / weight
            break
        for i in over:
            targets[i] = float(max_repeat * sizes[i])
            total -= targets[i]
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide all but at most two probabilities, keeping ``sum(pi)`` and ``sum(pi * size)``."""
    p, s = pi.tolist(), size.tolist()
    draws = iter(rng.random(len(p) + 1).tolist())
    active: list[int] = []
    for i in range(len(p)):
        if not EPSILON < p[i] < 1 - EPSILON:
            p[i] = float(round(p[i]))
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = active
        u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])  # normal to (1, 1, 1) and to the sizes
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(active, u) if x)
        down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(active, u) if x)
        step = up if next(draws) * (up + down) < down else -down
        left = []
        for k, x in zip(active, u):
            p[k] += step * x
            if EPSILON < p[k] < 1 - EPSILON:
                left.append(k)
            else:
                p[k] = float(round(p[k]))
        active = left
    return np.array(p)


def turns(miss: float, change: np.ndarray) -> tuple[float, list[int]]:
    """The least miss left by at most two different ``change``s, and their places.

    For each change the best partner is a neighbour of what it leaves open, in
    the changes by size.  Fewer changes win ties.
    """
    best = (abs(miss), [])
    if not len(change):
        return best
    one = int(np.argmin(np.abs(miss + change)))
    best = min(best, (abs(miss + change[one]), [one]), key=lambda x: x[0])
    order = np.argsort(change, kind="stable")
    ranked, rank = change[order], np.empty(len(change), dtype=np.int64)
    rank[order] = np.arange(len(change))
    at = np.searchsorted(ranked, -(miss + change))
    for near in (-2, -1, 0, 1):  # a change is no partner of its own
        j = at + near
        ok = (j >= 0) & (j < len(change)) & (j != rank)
        left = np.where(ok, np.abs(miss + change + ranked[np.clip(j, 0, len(change) - 1)]), np.inf)
        i = int(np.argmin(left))
        if left[i] < best[0]:
            best = (float(left[i]), [i, int(order[j[i]])])
    return best


def land(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last (at most two) probabilities so that the words are missed least.

    Each rounding may be mended by turning up to two more documents of the block
    in or out, so the miss is about the gap between sums of two sizes.
    """
    last = np.flatnonzero((pi > 0) & (pi < 1))
    best: tuple | None = None
    for m in range(1 << len(last)):
        tried = pi.copy()
        tried[last] = [(m >> k) & 1 for k in range(len(last))]
        miss = float(((tried - pi) * size).sum())
        left, which = turns(miss, np.where(tried > 0, -size, size).astype(float))
        if best is None or left < best[0]:
            tried[which] = 1 - tried[which]
            best = (left, tried)
    return best[1]


def _decider(seed: int, level: int, last: bool):
    """One block's flight, and on the last level its landing."""

    def decide(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["id", "h", "copy"], kind="stable", na_position="last")
        size = batch["size"].to_numpy(dtype=np.int64)
        rng = np.random.default_rng([seed, level, int(key[0]), int(key[1])])
        pi = flight(batch["pi"].to_numpy(), size, rng)
        return batch.drop(columns="block").assign(pi=land(pi, size) if last else pi)

    return decide


def _with_copy(sized: DataFrame) -> DataFrame:
    """``copy`` numbers equal rows from 0, each part of the table by itself and the parts
    by their counts, so that a row that is repeated often is not one task."""
    keyed = sized.withColumn("k", F.xxhash64("source", "id", "h")).withColumn(
        "part", F.shiftright("no", 33)
    )
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "k", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    ).where("start > 0")
    within = F.row_number().over(Window.partitionBy("k", "part").orderBy("no")) - 1
    return keyed.withColumn("copy", within).join(starts, ["k", "part"], "left").withColumn(
        "copy", F.col("copy") + F.coalesce("start", F.lit(0))
    ).drop("k", "part", "start", "no")


def mix_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    max_repeat: int = 3,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = 4096,
    seed: int = 2,
    row: str | None = None,
) -> DataFrame:
    """One row per document: ``id, size, source_size, target, copies, taken``.

    ``weights`` repeat over the sources by code point.  ``row`` names a column
    to carry along unchanged.
    """
    spark = docs.sparkSession
    carried = [F.col(row).alias("row")] if row else []
    sized = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source).alias("source"),
            F.regexp_count(whole_text(text), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(whole_text(text)).alias("h"),
            F.monotonically_increasing_id().alias("no"),
            *carried,
        ),
        "mix-sizes",
    )
    sources = (  # one row for each source
        sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("source").asc_nulls_last()).collect()
    )
    sizes = [r.words for r in sources]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], max_repeat)
    plan = spark.createDataFrame(
        [
            (r.source, no, r.n, r.words, t, t / r.words if r.words else 0.0)
            for no, (r, t) in enumerate(zip(sources, targets))
        ],
        "plan_source string, source_no int, n long, source_size long, target double, rate double",
    )
    same = F.col("source").eqNullSafe(F.col("plan_source"))
    units = _with_copy(sized).join(F.broadcast(plan), same).select(
        "id", "h", "copy", "size", "source_size", "target", "source_no", "n",
        F.floor("rate").cast("int").alias("whole"),
        (F.col("rate") - F.floor("rate")).alias("pi"),
        *(["row"] if row else []),
    )
    undecided = (F.col("pi") > EPSILON) & (F.col("pi") < 1 - EPSILON)
    schema = units.schema
    decided = [units.where(~undecided)]
    left = units.where(undecided)
    largest, level = max((r.n for r in sources), default=0), 0
    most = largest
    while most:
        blocks = -(-most // block)
        last = blocks == 1

        # a source has blocks in proportion to its documents, so a small one has few
        own = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(blocks / largest)))
        spread = F.pmod(F.xxhash64("id", "h", "copy", F.lit(level)), own.cast("long")).cast("int")
        flown = materialize(
            left.withColumn("block", spread).groupBy("source_no", "block")
            .applyInPandas(_decider(seed, level, last), schema),
            "mix-flight",
        )
        decided.append(flown.where(~undecided))
        left = flown.where(undecided)
        if last:
            break
        most, level = 2 * blocks, level + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = F.col("whole") + F.round("pi").cast("int")
    return out.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
        *([F.col("row").alias(row)] if row else []),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, columns unchanged."""
    whole = materialize(  # written, so that a row has one number in all jobs
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
            F.monotonically_increasing_id().alias("mix_row"),
        ),
        "numbered",
        "zstd",
    )
    names = {k: options.pop(k, k) for k in ("text", "source")} | {
        "id": options.pop("id_col", "doc_id")
    }
    keys = whole.select("mix_row", *[F.col(f"doc.{c}").alias(a) for a, c in names.items()])
    taken = mix_documents(keys, id_col="id", row="mix_row", **options).select("mix_row", "copies")
    return (
        whole.join(taken.where("copies > 0"), "mix_row")
        .select("doc", F.explode(F.sequence(F.lit(1), "copies")))
        .select("doc.*")
    )


def op2_cube_mixing(spark, sf_dir):
    return mix_documents(documents(spark, sf_dir)).drop("copies")

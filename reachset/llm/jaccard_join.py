"""Exact n-gram Jaccard join and its groups, by vertical partitioning.

A document is the set of its word n-grams, as 64-bit hashes.  Equal sets are
one class and take part once.  All n-grams have one global order: those that
a sample of the sets shows to be frequent come last, by their count, the
others by hash.  The order only steers the cost; the result is the same under
any order.

The order is cut into fragments.  The rare end of every set (its prefix, long
enough that two sets over the threshold must share an n-gram of it) is the
fragment that proposes pairs; sizes and the places of the shared n-gram bound
the overlap of a pair, and pairs that cannot reach the threshold go at once.
The overlaps of the pairs left are counted fragment by fragment, each as an
equi-join on (set, fragment), and summed per pair.

Pairs are proposed in two rounds.  First every list of sets that share a prefix
n-gram is linked through one of its members only, which is linear in the list;
verified links give components.  Then all pairs of *different* components that
share a prefix n-gram are checked, so no group is lost: a group of thousands of
copies costs about as many pairs as it has members.  That is all that
``jaccard_groups`` and ``keep_one`` need.

The join (``jaccard_join``) gives every link with its overlap, or for each set
the number of its links.  Links lie inside components, so the sets of each
component are compared there, all with all: a large component is cut into
blocks of ``SPREAD`` sets, and every two blocks meet in a task, which finds the
overlaps by one product of matrices.  A group of k different near copies has
about k * k / 2 links.  All are found; where only their numbers are wanted,
they are counted in the task and are never rows.

Defined results: a null text is empty, has no set and is linked with nothing,
its group is its own id; fewer than ``n`` words are one n-gram; ids may repeat
or be null (a group's id is its smallest id, null if it has none); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize
from .components import connected_components

#: Fragments of the rare part of the order; the frequent n-grams are one more.
FRAGMENTS = 4
#: One set in so many is looked at for the order.
ORDER_SAMPLE = 8
#: N-grams that the order can hold as frequent (16 bytes each in every task).
FREQUENT = 200_000
#: Bitmaps of the filter of candidate sets (4096 bytes each); its size is fixed.
BLOCKS = 4096
#: Sets of one n-gram, or of one component, that are paired with others in one task.
SPREAD = 256
#: N-grams of the sets of a component's block, about (8 bytes each).
BLOCK_GRAMS = 1 << 20
#: N-grams that a product of matrices takes at once (4 bytes for each set of two blocks).
COLUMNS = 4096
#: Words of 64 parity bits kept for each set.
PARITY = 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word runs (A-Z lower-cased, blanks split)."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(n, len(w))
    h = w[: len(w) - span + 1].copy()
    for i in range(1, span):
        h ^= h >> np.uint64(29)
        h *= _ODD
        h += w[i : len(w) - span + 1 + i]
    if span < n:
        h += np.uint64(span) * _ODD
    h ^= h >> np.uint64(32)
    return np.unique(h)


def set_id(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def required(size: int, percent: int) -> int:
    """The least overlap of a set of this size with any set it is linked to."""
    return -(-percent * size // 100)


class Order:
    """The global order: frequent n-grams (sorted by hash) with their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        at = np.argsort(grams)
        self.grams, self.counts = grams[at], counts[at]

    def weight(self, grams: np.ndarray) -> np.ndarray:
        """0 for a rare n-gram, else its count."""
        if not len(self.grams):
            return np.zeros(len(grams), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.counts[at], 0)

    def sort(self, grams: np.ndarray) -> np.ndarray:
        return grams[np.lexsort((grams, self.weight(grams)))]

    def fragment(self, grams: np.ndarray) -> np.ndarray:
        rare = (grams >> np.uint64(62)).astype(np.int64) * FRAGMENTS // 4
        return np.where(self.weight(grams) > 0, FRAGMENTS, rare)


def _signed(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.int64)


def parity(grams: np.ndarray) -> np.ndarray:
    """``PARITY`` words: for each slot, whether an odd number of n-grams falls in it."""
    slots = (grams % np.uint64(64 * PARITY)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=64 * PARITY) & 1).view(np.int64)


_PARITIES = [f"p{k}" for k in range(PARITY)]


def summaries(text: str, n: int) -> Column:
    """``set_id, n_shingles`` and the parity words of each text's set."""
    schema = "set_id long, n_shingles long, " + ", ".join(f"{p} long" for p in _PARITIES)

    @F.pandas_udf(schema)
    def summary(texts: pd.Series) -> pd.DataFrame:
        sets = [ngrams(t, n) for t in texts]
        words = np.array([parity(s) for s in sets], dtype=np.int64).reshape(-1, PARITY)
        out = pd.DataFrame(words, columns=_PARITIES)
        out.insert(0, "n_shingles", np.array([len(s) for s in sets], dtype=np.int64))
        out.insert(0, "set_id", np.array([set_id(s) for s in sets], dtype=np.int64))
        return out

    return summary(F.col(text))


def find_order(docs: DataFrame, text: str, n: int) -> Order:
    """Counts over one set in ``ORDER_SAMPLE``, the most frequent ``FREQUENT`` n-grams."""

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch["text"]:
                s = ngrams(t, n)
                if len(s) and set_id(s) % ORDER_SAMPLE == 0:
                    yield pd.DataFrame({"gram": _signed(s)})

    counts = docs.select(F.col(text).alias("text")).mapInPandas(sampled, "gram long").groupBy(
        "gram"
    ).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    top = counts.orderBy(F.desc("n"), "gram").limit(FREQUENT).toPandas()
    return Order(
        top["gram"].to_numpy(dtype=np.int64).view(np.uint64), top["n"].to_numpy(dtype=np.int64)
    )


def prefix_lists(
    docs: DataFrame, text: str, n: int, percent: int, order: Order
) -> DataFrame:
    """``gram, id, size, place``: the prefixes of all sets, where another set has the
    n-gram in its prefix too."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(order)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams, ids, sizes, places, seen = [], [], [], [], set()
            for t in batch["text"]:
                s = ngrams(t, n)
                if not len(s) or (i := set_id(s)) in seen:
                    continue
                seen.add(i)
                p = len(s) - required(len(s), percent) + 1
                grams.append(_signed(sent.value.sort(s)[:p]))
                ids.append(np.full(p, i))
                sizes.append(np.full(p, len(s), dtype=np.int32))
                places.append(np.arange(p, dtype=np.int32))
            if grams:
                yield pd.DataFrame(
                    {"gram": np.concatenate(grams), "id": np.concatenate(ids),
                     "size": np.concatenate(sizes), "place": np.concatenate(places)}
                )

    lists = docs.select(F.col(text).alias("text")).mapInPandas(
        prefixes, "gram long, id long, size int, place int"
    )
    by_gram = Window.partitionBy("gram")
    shared = lists.withColumn("least", F.min("id").over(by_gram)).withColumn(
        "most", F.max("id").over(by_gram)
    ).where("least != most").drop("least", "most")
    return materialize(shared.dropDuplicates(["gram", "id"]), "prefix-lists")


def parities(sets: DataFrame) -> DataFrame:
    """``id, n`` and the parity words of every set that is not empty, once."""
    return sets.where("n_shingles > 0").groupBy(F.col("set_id").alias("id")).agg(
        F.max("n_shingles").alias("n"), *[F.max(p).alias(p) for p in _PARITIES]  # alike in all rows
    )


def _room(size_a: Column, size_b: Column, a: str, b: str, percent: int) -> Column:
    """Whether the parities leave room for the threshold: twice the overlap is both sizes less
    the n-grams in which the sets differ, and these are at least the slots of odd difference."""
    differ = F.lit(0)
    for p in _PARITIES:
        differ = differ + F.bit_count(F.col(f"{a}_{p}").bitwiseXOR(F.col(f"{b}_{p}")))
    both = size_a + size_b
    return (both - differ) * (100 + percent) >= 2 * percent * both


def _can_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and the places of a shared n-gram leave room for the threshold."""
    size_a, size_b = F.col(f"{a}_size"), F.col(f"{b}_size")
    most = F.least(size_a - F.col(f"{a}_place"), size_b - F.col(f"{b}_place"))
    # overlap / (a + b - overlap) >= t  <=>  (100 + p) * overlap >= p * (a + b)
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & (
        most * (100 + percent) >= percent * (size_a + size_b)
    )


def with_room(pairs: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose parities leave room for the threshold."""
    of = lambda x: words.select(*[F.col(c).alias(x if c == "id" else f"{x}_{c}") for c in words.columns])
    joined = pairs.join(of("u"), "u").join(of("v"), "v")
    return joined.where(_room(F.col("u_n"), F.col("v_n"), "u", "v", percent)).select("u", "v")


_CARRIED = ("id", "size", "place")


def _side(lists: DataFrame, name: str, *more: str) -> DataFrame:
    return lists.select("gram", *[F.col(c).alias(f"{name}_{c}") for c in (*_CARRIED, *more)])


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(
        F.least("a_id", "b_id").alias("u"), F.greatest("a_id", "b_id").alias("v")
    ).distinct()


def through_hubs(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's members paired with one of them: the one with the fewest n-grams before
    the shared one.  Edits make rare n-grams, which come first, so among copies this is the
    least edited one, to which most others link (and the same one in most lists)."""
    first = F.struct(F.col("place").alias("before"), F.xxhash64("id").alias("tie"), *_CARRIED)
    hubs = lists.groupBy("gram").agg(F.min(first).alias("hub"))
    hubs = hubs.select("gram", *[F.col(f"hub.{c}").alias(f"a_{c}") for c in _CARRIED])
    pairs = _side(lists, "b").join(hubs, "gram").where("a_id != b_id")
    return _pairs(pairs.where(_can_link("a", "b", percent)))


def across_components(
    lists: DataFrame, stars: DataFrame, tested: DataFrame, percent: int
) -> DataFrame:
    """All pairs of sets of different components that share a prefix n-gram.

    One side of a long list is cut into slices, the other goes to each of them.
    """
    labelled = lists.join(stars.withColumnRenamed("u", "id"), "id", "left").select(
        "gram", *_CARRIED, F.coalesce("v", "id").alias("comp")
    )
    split = labelled.groupBy("gram").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    left = labelled.join(split.where("x != y").select("gram"), "gram", "left_semi")
    slices = left.groupBy("gram").agg(
        F.ceil(F.count(F.lit(1)) / SPREAD).cast("int").alias("slices")
    ).where("slices > 1")
    left = materialize(
        left.join(slices, "gram", "left").withColumn("slices", F.coalesce("slices", F.lit(1))),
        "lists",
    )
    a = _side(left, "a", "comp", "slices").withColumn(
        "slice", F.pmod(F.xxhash64("a_id"), F.col("a_slices")).cast("int")
    )
    b = _side(left, "b", "comp", "slices").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("b_slices") - 1))
    )
    found = a.join(b, ["gram", "slice"]).where(
        (F.col("a_comp") < F.col("b_comp")) & _can_link("a", "b", percent)
    )
    return _pairs(found).join(tested, ["u", "v"], "left_anti")


def _places(i, shift) -> list[tuple]:
    """Two (bitmap, bit) places of an id, which is a hash itself; ``i``: a column or a number."""
    return [(shift(i, 15), shift(i, 0)), (shift(i, 42), shift(i, 27))]


def id_filter(ids: DataFrame) -> np.ndarray:
    """The ids as ``BLOCKS`` bitmaps, two bits each: of fixed size, however many there are."""
    bits = _places(F.col("id"), F.shiftright)
    place = lambda block, bit: F.struct(
        block.bitwiseAND(F.lit(BLOCKS - 1)).alias("block"), bit.bitwiseAND(F.lit(32767)).alias("bit")
    )
    rows = ids.select(F.explode(F.array(*[place(*p) for p in bits])).alias("p")).select("p.*")
    out = np.zeros((BLOCKS, 4096), dtype=np.uint8)
    for r in rows.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[r.block] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def maybe_in(bitmaps: np.ndarray, i: int) -> bool:
    """Whether the filter may hold the id: all that it holds, and few others."""
    return all(
        bitmaps[block % BLOCKS, bit % 32768 // 8] >> (bit % 8) & 1
        for block, bit in _places(i, lambda x, by: x >> by)
    )


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("id"))


def cut_sets(
    docs: DataFrame, base: DataFrame, ids: DataFrame, text: str, n: int, order: Order
) -> DataFrame:
    """``id, fragment, size, grams``: the sets of these ids (distinct ones), by fragment.
    Of the texts of a set one is cut up again, the others are passed over by their hash."""
    keys = base.join(ids.withColumnRenamed("id", "set_id"), "set_id").groupBy("set_id").agg(
        F.min("key").alias("id")
    )
    sent = docs.sparkSession.sparkContext.broadcast((order, id_filter(keys)))

    def fragments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, wanted = sent.value
        for batch in batches:
            rows, seen = [], set()
            for key, t in zip(batch["key"].tolist(), batch["text"]):
                if key in seen or not maybe_in(wanted, key):
                    continue
                seen.add(key)
                s = ngrams(t, n)
                if not len(s):
                    continue
                i, f = set_id(s), order.fragment(s)
                rows += [
                    (i, k, len(s), _signed(s[f == k])) for k in range(FRAGMENTS + 1) if (f == k).any()
                ]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "fragment", "size", "grams"])

    cut = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("key")).mapInPandas(
        fragments, "id long, fragment int, size int, grams array<long>"
    )
    # the few that passed the filter by chance go here
    cut = cut.join(ids, "id", "left_semi").dropDuplicates(["id", "fragment"])
    return materialize(cut, "fragments")


def overlaps(cut: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs over the threshold: overlaps by fragment, summed per pair."""
    u = cut.select(F.col("id").alias("u"), "fragment", F.col("size").alias("u_size"),
                   F.col("grams").alias("u_grams"))
    v = cut.select(F.col("id").alias("v"), "fragment", F.col("size").alias("v_size"),
                   F.col("grams").alias("v_grams"))
    partial = pairs.join(u, "u").join(v, ["v", "fragment"]).select(
        "u", "v", "u_size", "v_size",
        F.size(F.array_intersect("u_grams", "v_grams")).alias("part"),
    )
    total = partial.groupBy("u", "v", "u_size", "v_size").agg(F.sum("part").alias("overlap"))
    union = F.col("u_size") + F.col("v_size") - F.col("overlap")
    return total.where(100 * F.col("overlap") >= percent * union).select("u", "v", "overlap")


def inside_components(
    cut: DataFrame, stars: DataFrame, percent: int, counts: bool
) -> DataFrame:
    """The links ``u, v, overlap`` of the sets of each component, or (``counts``)
    ``set_id, n_links`` in parts, to be summed.  ``cut`` holds all these sets."""
    member = stars.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        stars.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    )
    rows = materialize(cut.join(member, "id"), "members")
    weight = rows.select("comp", "id", "size").distinct().groupBy("comp").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / SPREAD), F.ceil(F.sum("size") / BLOCK_GRAMS)
        ).cast("int").alias("blocks")
    ).where("blocks > 1")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # at most one component in SPREAD sets, or in BLOCK_GRAMS n-grams, is large
    dealt = rows.join(F.broadcast(weight), "comp", "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    ).select(
        "comp", "id", "size", "grams", block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "comp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "block", "id", "size", "grams",
    )

    def compare(found: pd.DataFrame) -> pd.DataFrame:
        x, y = int(found["x"].iloc[0]), int(found["y"].iloc[0])
        sets = found.drop_duplicates("id").sort_values("id")
        ids, size, at = (sets[c].to_numpy() for c in ("id", "size", "block"))
        overlap = common(np.searchsorted(ids, found["id"].to_numpy()), found["grams"].tolist(),
                         np.flatnonzero(at == x), np.flatnonzero(at == y))
        a, b = ids[at == x], ids[at == y]
        both = size[at == x].astype(np.int64)[:, None] + size[at == y]
        linked = 100 * overlap >= percent * (both - overlap)
        if x == y:
            np.fill_diagonal(linked, False)
        if counts:
            n_links = [linked.sum(axis=1)] + [linked.sum(axis=0)] * (x != y)
            return pd.DataFrame(
                {"set_id": np.concatenate([a, b][: len(n_links)]), "n_links": np.concatenate(n_links)}
            )
        i, k = np.nonzero(np.triu(linked) if x == y else linked)
        return pd.DataFrame(
            {"u": np.minimum(a[i], b[k]), "v": np.maximum(a[i], b[k]), "overlap": overlap[i, k]}
        )

    schema = "set_id long, n_links long" if counts else "u long, v long, overlap long"
    dealt = dealt.repartition("comp", "x", "y")  # the blocks of a component are spread over tasks
    return dealt.groupBy("comp", "x", "y").applyInPandas(compare, schema)


def common(owner: np.ndarray, grams: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many n-grams each set of ``a`` has in common with each of ``b``; the set of number
    ``owner[k]`` has the n-grams ``grams[k]`` (and those of its other places)."""
    lengths = [len(g) for g in grams]
    _, column, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    again = times > 1  # the others are in one set only
    column = np.where(again, np.cumsum(again) - 1, -1)[column]
    row = np.repeat(owner, lengths)[column >= 0]
    column = column[column >= 0]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    shared = int(again.sum())
    for first in range(0, shared, COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        has = np.zeros((int(owner.max()) + 1, min(COLUMNS, shared - first)), dtype=np.float32)
        has[row[lo:hi], column[lo:hi] - first] = 1
        out += (has[a] @ has[b].T).astype(np.int64)
    return out


def _sets(docs: DataFrame, n: int, id_col: str, text: str, row: str | None = None) -> DataFrame:
    carried = [F.col(row).alias("row")] if row else []
    return materialize(
        docs.select(
            F.col(id_col).cast("long").alias("id"), *carried, F.xxhash64(text).alias("key"),
            summaries(text, n).alias("s"),
        ).select("id", *(["row"] if row else []), "key", "s.*"),
        "sets",
    )


def _grouped(named: DataFrame, id_col: str, *more: Column) -> DataFrame:
    """``named`` has ``id, n_shingles`` and ``comp``, the component of the set."""
    smallest = named.where("n_shingles > 0").groupBy("comp").agg(F.min("id").alias("least"))
    return named.join(smallest, "comp", "left").select(
        F.col("id").alias(id_col),
        *more,
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def _components(sets: DataFrame, stars: DataFrame) -> DataFrame:
    return sets.join(stars.withColumnRenamed("u", "set_id"), "set_id", "left").withColumn(
        "comp", F.coalesce("v", "set_id")
    ).drop("v")


def _linked_sets(
    docs: DataFrame, base: DataFrame, n: int, percent: int, text: str
) -> tuple[DataFrame, DataFrame]:
    """The components of the sets, as stars ``u, v``, and the cut sets of all their members."""
    order = find_order(docs, text, n)
    lists, words = prefix_lists(docs, text, n, percent, order), materialize(parities(base), "parities")
    tested = materialize(through_hubs(lists, percent), "pairs")
    first = materialize(with_room(tested, words, percent), "pairs")
    ids = materialize(ends(first).distinct(), "ids")
    cut = cut_sets(docs, base, ids, text, n, order)
    links = materialize(overlaps(cut, first, percent), "links")
    stars = connected_components(links.select("u", "v"))
    rest = across_components(lists, stars, tested, percent)
    rest = materialize(with_room(rest, words, percent), "pairs")
    new = materialize(ends(rest).distinct().join(ids, "id", "left_anti"), "ids")
    if not new.isEmpty():
        cut = cut.unionByName(cut_sets(docs, base, new, text, n, order))
    more = materialize(overlaps(cut, rest, percent), "links")
    return connected_components(stars.unionByName(more.select("u", "v"))), cut


def jaccard_join(
    docs: DataFrame,
    n: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text: str = "text",
    counts: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The members ``id, set_id, n_shingles, comp`` (every row of ``docs``, with the component
    of its set) and the links ``u, v, overlap``: every two different sets over the threshold,
    once, ``u < v``.  With ``counts``, in place of the links ``set_id, n_links``: for each set
    that has links their number."""
    base = _sets(docs, n, id_col, text)
    stars, cut = _linked_sets(docs, base, n, percent, text)
    links = inside_components(cut, stars, percent, counts)
    if counts:
        links = links.groupBy("set_id").agg(F.sum("n_links").alias("n_links"))
    members = _components(base.select("id", "set_id", "n_shingles"), stars)
    return members, materialize(links, "links")


def linked_documents(
    docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id, n_links`` for every row; ``n_links``: the number of
    different sets that its set is linked to (rows of equal sets have the same links)."""
    sets, links = jaccard_join(docs, n, percent, id_col, text, counts=True)
    named = sets.join(links, "set_id", "left")
    return _grouped(named, id_col, F.coalesce("n_links", F.lit(0)).alias("n_links")).select(
        id_col, "n_shingles", "component_id", "n_links"
    )


def jaccard_groups(
    docs: DataFrame,
    n: int = 4,
    percent: int = 85,
    id_col: str = "doc_id",
    text: str = "text",
    row: str | None = None,
) -> DataFrame:
    """``id, n_shingles, component_id`` for every row (``row``: a column to carry along)."""
    base = _sets(docs, n, id_col, text, row)
    stars, _ = _linked_sets(docs, base, n, percent, text)
    sets = base.select("id", *(["row"] if row else []), "set_id", "n_shingles")
    return _grouped(_components(sets, stars), id_col, *([F.col("row").alias(row)] if row else []))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, **options) -> DataFrame:
    """The rows of ``docs`` without all but the first row (smallest id) of each group."""
    whole = materialize(  # written, so that a row has one number in all jobs
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "numbered",
        "zstd",
    )
    keys = whole.select(
        "row", F.col(f"doc.{options.get('id_col', 'doc_id')}").alias("id"),
        F.col(f"doc.{options.get('text', 'text')}").alias("text"),
    )
    groups = materialize(
        jaccard_groups(keys, n, percent, id_col="id", text="text", row="row"), "groups"
    )
    stays = groups.where("n_shingles > 0").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    )
    gone = groups.where("n_shingles > 0").select("row").join(
        stays.select(F.col("first.row").alias("row")), "row", "left_anti"
    )
    return whole.join(gone, "row", "left_anti").select("doc.*")


def op7_ngram_jaccard_join(spark, sf_dir):
    return linked_documents(documents(spark, sf_dir).select("doc_id", "text"))

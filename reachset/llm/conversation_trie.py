"""Prefix trie of conversations, as balanced parentheses per shard.

*Rebuilding.*  Turns are hashed to 128 bits and two numbers; texts go no
further.  They are range-partitioned by conversation and turn, so a long
conversation is spread over tasks, and places count on from one partition to
the next.  A conversation's first turns may come from another one.

*Paths.*  A turn's step is a hash of its place and content, and the key of a
prefix is the exclusive or of its steps, so keys of pieces compose.  A
conversation becomes segments of at most ``SEGMENT`` turns, each hung under
the key of the prefix before it (its anchor); equal segments are grouped with
a count and the smallest id before anything else, so a conversation held by
many is one row.

*Shards.*  The distinct paths are range-partitioned in the order of their
steps: a shard is a run of neighbouring paths.  It becomes one row of a table:
the forest of its paths as balanced parentheses, packed to bits, the smallest
and largest excess of each block, and each node's step, bytes, count and
smallest id in preorder.

*Sums.*  ``find_close`` delimits every subtree; the rank of ``()`` pairs counts
its childless nodes; cumulative arrays over the preorder give its members and
savings.  Paths shared with the shard before are told from the boundary rows,
so each node's bytes and each childless node count in one shard only.  What
remains is additive: the spines that shards share are merged by a grouping of
their rows, other nodes are whole as they are.  Segments are done from the
deepest level up, and what hangs under an anchor is added to its node above.

Defined results: rows without a conversation id belong to no conversation; a
null turn comes first, turns with the same number follow a hash of role and
text; repeated rows are turns of their own; a null role or text is empty; an
empty table gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .parentheses import Parentheses, block_ranges, pack, range_min, unpack

#: Turns of a segment, and nodes of a shard, at most (about).
SEGMENT = 1 << 16
SHARD_NODES = 1 << 18
#: Ids of one piece of a node's list of ends.
_PIECE = 512
#: At most this many first turns come from another conversation.
_HEAD = 8

TRIE = (
    "shard int, first array<long>, last array<long>, nodes int, parens binary, low binary, "
    "high binary, steps binary, bytes binary, ends binary, least binary, below binary"
)
NODE = (
    "k1 long, k2 long, p1 long, p2 long, depth int, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, shared boolean, parent_shared boolean, parent_conv_id long"
)
_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


# ---- rebuilding ---------------------------------------------------------------------------


def _hash(seed: int, *cols) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def numbered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 1)``, h1, h2, bytes`` of every turn with a conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = materialize(
        rows.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn",
            _hash(1, role, text).alias("h1"), _hash(2, role, text).alias("h2"),
            F.octet_length(text).cast("long").alias("bytes"),
            F.monotonically_increasing_id().alias("row"),  # equal rows can be told apart
        ),
        "turns",
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "h1", "h2", "row"]
    number = F.monotonically_increasing_id()
    placed = materialize(
        turns.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "h1", "h2", "bytes", F.spark_partition_id().alias("part"), number.alias("at")),
        "turns-in-order",
    )
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(
        runs.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        "turn-runs",
    )
    place = F.col("at") - F.col("first") + F.col("before") + 1
    return materialize(
        placed.join(runs, ["conv_id", "part"]).select("conv_id", place.alias("place"), "h1", "h2", "bytes"),
        "numbered-turns",
    )


def rebuilt_turns(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """``conv_id, place, h1, h2, bytes`` after the change of first turns, and a row of place 0 each.

    ``heads``: ``conv_id, base, h``, one row per conversation: its first ``h``
    turns (``_HEAD`` at most) give way to those of ``base``.
    """
    given = materialize(turns.where(F.col("place") <= _HEAD).withColumnRenamed("conv_id", "base"), "heads")
    have = given.groupBy("base").agg(F.max("place").alias("have"))
    heads = materialize(
        heads.join(have, "base", "left")
        .select("conv_id", "base", "h", F.least("h", F.coalesce("have", F.lit(0))).alias("got")),
        "head-counts",
    )
    columns = ["conv_id", "place", "h1", "h2", "bytes"]
    front = heads.join(given, "base").where(F.col("place") <= F.col("h")).select(*columns)
    own = (
        turns.join(heads, "conv_id").where(F.col("place") > F.col("h"))
        .withColumn("place", F.col("place") - F.col("h") + F.col("got")).select(*columns)
    )
    root = heads.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in columns[1:]])
    return reduce(DataFrame.unionByName, [front, own, root])


# ---- paths --------------------------------------------------------------------------------


def segments(rebuilt: DataFrame, segment: int) -> DataFrame:
    """``conv_id, seg, x1, x2, rows``: at most ``segment`` turns each, and the key of these alone."""
    steps = rebuilt.select(
        "conv_id", "place", "bytes",
        F.floor(F.greatest(F.col("place") - 1, F.lit(0)) / segment).cast("int").alias("seg"),
        *[F.when(F.col("place") > 0, _hash(i, "place", "h1", "h2")).otherwise(0).alias(f"s{i}") for i in (1, 2)],
    )
    rows = F.sort_array(F.collect_list(F.struct("place", "s1", "s2", "bytes")))
    return steps.groupBy("conv_id", "seg").agg(
        F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"), rows.alias("rows")
    )


def anchored(cut: DataFrame, last: int) -> DataFrame:
    """``conv_id, seg, e1, e2, steps, bytes``: the segments with their anchors; ``last``: the last number.

    ``steps`` holds the two halves of the anchor and of each step, ``bytes`` a 0
    for the anchor; ``e1, e2`` is the key at the end.
    """
    # the first segment has its anchor, the root, in the row of place 0
    zero = F.lit(0).cast("long")
    whole = cut.where("seg = 0").withColumns({"k1": zero, "k2": zero})
    if last:
        before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
        carried = cut.select("conv_id", "seg", *[F.bit_xor(f"x{i}").over(before).alias(f"k{i}") for i in (1, 2)])
        whole = whole.unionByName(
            cut.where("seg > 0").join(materialize(carried.where("seg > 0"), "anchors"), ["conv_id", "seg"])
        )
    path = F.flatten(F.transform("rows", lambda r: F.array(r["s1"], r["s2"])))
    weights = F.transform("rows", lambda r: r["bytes"])
    return whole.select(
        "conv_id", "seg",
        *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"e{i}") for i in (1, 2)],
        F.when(F.col("seg") == 0, path).otherwise(F.concat(F.array("k1", "k2"), path)).alias("steps"),
        F.when(F.col("seg") == 0, weights).otherwise(F.concat(F.array(zero), weights)).alias("bytes"),
    )


def distinct_paths(cut: DataFrame, below: DataFrame | None) -> DataFrame:
    """Equal segments as one row, with what hangs under its end."""
    paths = cut.groupBy("e1", "e2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"),
        F.first(F.struct("steps", "bytes")).alias("path"),
    )
    paths = paths.select("e1", "e2", "n", "least", "path.steps", "path.bytes")
    names = ["n_children", "n_leaves", "saved_tokens"]
    if below is None:
        return paths.withColumn("below", F.array(*[F.lit(0).cast("long")] * 3))
    hung = below.select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.array(*names).alias("below"))
    none = F.array(*[F.lit(0).cast("long")] * 3)
    return paths.join(hung, ["e1", "e2"], "left").withColumn("below", F.coalesce("below", none))


# ---- shards -------------------------------------------------------------------------------


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def encode_shard(steps: list[np.ndarray] | np.ndarray, sizes: np.ndarray, **values) -> dict:
    """A forest of paths in order: ``steps`` (two per node, all paths on end), ``sizes`` nodes each."""
    ends = np.cumsum(sizes)
    start = ends - sizes
    step = np.asarray(steps).reshape(-1, 2)
    row = np.repeat(np.arange(len(sizes)), sizes)
    depth = np.arange(len(row)) - start[row]
    # steps that a path has in common with the one before
    prev = np.maximum(row - 1, 0)
    both = (row > 0) & (depth < sizes[prev])
    same = both & (step == step[np.where(both, start[prev] + depth, 0)]).all(1)
    common = np.minimum.reduceat(np.where(same, len(row), depth), start)  # paths differ and a prefix comes first
    new = depth >= common[row]
    closes = np.concatenate([[0], sizes[:-1] - common[1:]])
    runs = np.stack([closes, sizes - common], 1).ravel()
    opens = np.repeat(np.tile([False, True], len(sizes)), runs)
    opens = np.concatenate([opens, np.zeros(int(sizes[-1]), bool)])
    low, high = block_ranges(opens)
    at_end = np.cumsum(sizes - common) - 1  # the node that each path ends in
    nodes = int(new.sum())
    count, least = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max)
    below = np.zeros((nodes, 3), np.int64)
    count[at_end], least[at_end], below[at_end] = values["n"], values["least"], values["below"]
    return {
        "nodes": nodes, "parens": pack(opens), "low": low.tobytes(), "high": high.tobytes(),
        "steps": step[new].tobytes(), "bytes": values["bytes"][new].tobytes(),
        "ends": count.tobytes(), "least": least.tobytes(), "below": below.tobytes(),
    }


def encode_shards(paths: DataFrame, shard_nodes: int) -> DataFrame:
    """One row per shard (``TRIE``)."""

    def encode(batches: Iterable[pa.RecordBatch]):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        sizes = np.diff(column["bytes"].offsets.to_numpy())
        shard = encode_shard(
            _flat(column["steps"]), sizes, bytes=_flat(column["bytes"]), n=column["n"].to_numpy(),
            least=column["least"].to_numpy(), below=_flat(column["below"]).reshape(-1, 3),
        )
        shard |= {
            "shard": TaskContext.get().partitionId(),
            "first": column["steps"][0].as_py(), "last": column["steps"][-1].as_py(),
        }
        kinds = {"int": pa.int32(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
        fields = [(f.split()[0], kinds[f.split()[1]]) for f in TRIE.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard[c]], k) for c, k in fields], schema=pa.schema(fields)
        )

    total = paths.agg(F.sum(F.size("bytes"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_nodes))
    order = paths.select("steps", "bytes", "n", "least", "below")
    return order.repartitionByRange(shards, "steps").sortWithinPartitions("steps").mapInArrow(encode, TRIE)


def _in_common(a: str, b: str) -> Column:
    """Steps that two paths have in common, the anchor counted."""
    alike = F.zip_with(a, b, lambda x, y: x == y)
    apart = F.array_position(F.transform(alike, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))
    return F.floor(F.when(apart > 0, apart - 1).otherwise(F.size(alike)) / 2).cast("int")


def with_neighbours(tries: DataFrame) -> DataFrame:
    """``tries`` and ``left, right``: steps shared with the shards before and after; ``extended``."""
    order = Window.orderBy("shard")  # a number per shard
    numbers = tries.select("shard").withColumn("next", F.lead("shard").over(order)).where("next is not null")
    pairs = (
        numbers.join(tries.select("shard", "last"), "shard")
        .join(tries.select(F.col("shard").alias("next"), "first"), "next")
        .select("shard", "next", _in_common("last", "first").alias("common"),
                (F.size("last") / 2).cast("int").alias("size"))
    )
    right = pairs.select("shard", F.col("common").alias("right"), (F.col("common") == F.col("size")).alias("extended"))
    left = pairs.select(F.col("next").alias("shard"), F.col("common").alias("left"))
    return (  # a few numbers for each shard
        tries.drop("first", "last").join(F.broadcast(left), "shard", "left").join(F.broadcast(right), "shard", "left")
        .withColumns({
            "left": F.coalesce("left", F.lit(0)), "right": F.coalesce("right", F.lit(0)),
            "extended": F.coalesce("extended", F.lit(False)),
        })
    )


def shard_nodes(trie: dict, top: int) -> dict[str, np.ndarray]:
    """Every node of a shard with the shard's part of its sums; ``top``: the anchors' depth."""
    n = trie["nodes"]
    tree = Parentheses(
        unpack(trie["parens"], n), np.frombuffer(trie["low"], np.int32), np.frombuffer(trie["high"], np.int32)
    )
    step = np.frombuffer(trie["steps"], np.int64).reshape(-1, 2)
    weight, ends = np.frombuffer(trie["bytes"], np.int64), np.frombuffer(trie["ends"], np.int64)
    below = np.frombuffer(trie["below"], np.int64).reshape(-1, 3)
    node, close = np.arange(n), tree.find_close()
    depth = tree.excess[tree.start] - 1
    stop = node + (close - tree.start + 1) // 2  # the subtree is node..stop-1

    def subtree(values: np.ndarray) -> np.ndarray:
        cumulative = np.concatenate([[0], np.cumsum(values)])
        return cumulative[stop] - cumulative[node]

    # a node's parent is the last one before it that is a step higher
    by_depth = np.argsort(depth, kind="stable")
    ranked = depth[by_depth].astype(np.int64) * n + by_depth
    parent = by_depth[np.maximum(np.searchsorted(ranked, (depth.astype(np.int64) - 1) * n + node) - 1, 0)]
    parent[depth == 0] = node[depth == 0]

    # the key of a prefix is the exclusive or of its steps
    key = np.array(step)
    for i in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)[1:]:
        key[i] ^= key[parent[i]]

    path = np.full(int(depth.max()) + 1, -1)
    path[depth] = node  # of each depth the last: the path that ends the shard
    owned, shared = np.ones(n, bool), np.zeros(n, bool)
    owned[: trie["left"]] = False
    shared[: trie["left"]] = True
    shared[path[: trie["right"]]] = True

    members = subtree(ends)
    children = np.bincount(parent[owned & (depth > 0)], minlength=n) + below[:, 0]
    inner = below[:, 0] > 0  # not childless, though no child is in this shard
    inner[n - 1] |= bool(trie["extended"])
    pair = stop == node + 1
    leaves = tree.leaves(tree.start, close) + subtree(below[:, 1] - (inner & pair))
    saved = subtree(members * weight - owned * weight + below[:, 2])
    least = range_min(np.frombuffer(trie["least"], np.int64), node, stop - node)
    return {
        "k1": key[:, 0], "k2": key[:, 1], "p1": key[parent, 0], "p2": key[parent, 1],
        "depth": (depth + top).astype(np.int32), "conv_id": least, "n_convs": members,
        "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "shared": shared, "parent_shared": shared[parent] & (depth > 0), "parent_conv_id": least[parent],
    }


def _summed(tries: DataFrame, top: int) -> DataFrame:
    def nodes(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = shard_nodes(row, top)
                columns = [pa.array(v) for v in found.values()]
                whole = pa.RecordBatch.from_arrays(columns, names=list(found))
                for at in range(0, whole.num_rows, 1 << 16):
                    yield whole.slice(at, 1 << 16)

    return tries.drop("shard").mapInArrow(nodes, NODE)


def _level(cut: DataFrame, below: DataFrame | None, top: int, shard_size: int) -> DataFrame:
    """The whole nodes of one level of segments, the anchors among them (as far as the level goes)."""
    paths = materialize(distinct_paths(cut, below), "paths")
    tries = materialize(encode_shards(paths, shard_size), "tries")
    rows = materialize(_summed(with_neighbours(tries), top), "trie-rows")
    spine = materialize(
        rows.where("shared").groupBy("k1", "k2", "p1", "p2", "depth")
        .agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _SUMS]),
        "spines",
    )
    parents = spine.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["k1", "k2", "p1", "p2", "depth", "conv_id", "parent_conv_id", *_SUMS]
    whole = rows.where("not shared")
    done = whole.where("not parent_shared").select(columns)
    under = whole.where("parent_shared").drop("parent_conv_id").unionByName(
        spine.where(F.col("depth") > top), allowMissingColumns=True
    )
    found = under.join(parents, ["p1", "p2"]).select(columns)
    anchors = spine.where(F.col("depth") == top).withColumn("parent_conv_id", F.lit(None).cast("long"))
    return materialize(done.unionByName(found).unionByName(anchors.select(columns)), "trie-level")


# ---- ends ---------------------------------------------------------------------------------


def ends_digests(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256`` of the nodes that conversations end in.

    The ids are range-partitioned by node and id, so a node's ids come in
    order from many tasks, as texts of ``_PIECE`` ids; one stream per node
    hashes the texts, with nothing held but the state.
    """
    piece = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    digest = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def pieces(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, ids = (batch.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
            change = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
            run = np.concatenate([[0], change])
            long = np.diff(np.concatenate([run, [len(ids)]]))
            at = np.concatenate([np.arange(r, r + n, _PIECE) for r, n in zip(run, long)])
            text = [str(i) for i in ids.tolist()]
            stop = np.minimum(np.concatenate([at[1:], [len(ids)]]), at + _PIECE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[at]), pa.array(k2[at]), pa.array(ids[at]),
                 pa.array([",".join(text[a:b]) for a, b in zip(at, stop)])],
                schema=piece,
            )

    def digests(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=digest)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], schema=digest)

    order = ["k1", "k2", "conv_id"]
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        pieces, "k1 long, k2 long, first long, ids string"
    )
    one = texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return one.mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


# ---- the operator -------------------------------------------------------------------------


def prefix_trie(
    turns: DataFrame, heads: DataFrame | None = None, segment: int = SEGMENT, shard_size: int = SHARD_NODES
) -> DataFrame:
    """Every node of the trie of the conversations in ``turns`` (``conv_id, turn, role, text``).

    ``heads`` (``conv_id, base, h``) makes the rebuilt conversations of
    :func:`rebuilt_turns`; without it they are taken as they are.
    """
    numbered = numbered_turns(turns)
    if heads is None:
        none = F.lit(0).cast("long")
        heads = numbered.select("conv_id").distinct().select("conv_id", F.col("conv_id").alias("base"), none.alias("h"))
    rebuilt = materialize(rebuilt_turns(numbered, heads), "rebuilt-turns")
    cut = materialize(segments(rebuilt, segment), "segments")
    last = cut.agg(F.max("seg")).first()[0] or 0
    cut = materialize(anchored(cut, last), "paths-of-conversations")
    levels: list[DataFrame] = []
    below = None
    for seg in range(last, -1, -1):
        level = _level(cut.where(F.col("seg") == seg), below, seg * segment, shard_size)
        below = level.where(F.col("depth") == seg * segment)
        levels.insert(0, level)

    nodes = levels[0]
    for seg, level in enumerate(levels[1:], 1):  # a level's first steps hang on nodes of the level above
        under = level.where(F.col("depth") > seg * segment)
        first = F.col("depth") == seg * segment + 1
        above = levels[seg - 1].where(F.col("depth") == seg * segment).select(
            F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
        )
        nodes = nodes.unionByName(under.where(~first)).unionByName(
            under.where(first).drop("parent_conv_id").join(above, ["p1", "p2"])
        )
    final = F.max(F.struct("seg", "e1", "e2"))
    ends = cut.groupBy("conv_id").agg(final.alias("end")) if last else cut.select("conv_id", F.struct("e1", "e2").alias("end"))
    digests = ends_digests(ends.select(F.col("end.e1").alias("k1"), F.col("end.e2").alias("k2"), "conv_id"))
    empty = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(digests, ["k1", "k2"], "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        *[F.col(c) for c in _SUMS], F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )


def exchanged_heads(turns: DataFrame) -> DataFrame:
    """The first ``crc32(decimal c) mod 9`` turns of conversation ``c`` are those of ``c - c % 5``."""
    c = F.col("conv_id")
    return turns.select(c.cast("long").alias("conv_id")).where(c.isNotNull()).distinct().select(
        "conv_id", (c - c % 5).alias("base"), (F.crc32(F.encode(c.cast("string"), "UTF-8")) % 9).alias("h")
    )


def op13_conversation_trie(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return prefix_trie(turns, exchanged_heads(turns))


OP13_SQL = """
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), crc as (
  select conv_id, xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
      lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end))) as crc
  from (select distinct conv_id from t)
), heads as (
  select c.conv_id, c.conv_id - c.conv_id % 5 as base, crc % 9 as h, least(crc % 9, coalesce(n, 0)) as got
  from crc c left join (select conv_id as base, count(*) as n from t group by conv_id) b
    on b.base = c.conv_id - c.conv_id % 5
), rebuilt as (
  select h.conv_id, t.place, t.role, t.text from heads h join t on t.conv_id = h.base and t.place <= h.h
  union all
  select t.conv_id, t.place - h.h + h.got, t.role, t.text from t join heads h using (conv_id) where t.place > h.h
), keyed as (
  select conv_id, place as depth, text,
         string_agg(md5(role) || md5(text), '') over (partition by conv_id order by place) as k
  from rebuilt
  union all select conv_id, 0, '', '' from heads
), nodes as (
  select k, depth, min(conv_id) as conv_id, count(*) as n_convs, strlen(any_value(text)) as bytes
  from keyed group by k, depth
), children as (
  select left(k, 64 * (depth - 1)) as k, count(*) as n from nodes where depth > 0 group by 1
), own as (
  select n.*, coalesce(c.n, 0) as n_children, left(n.k, 64 * (n.depth - 1)) as parent
  from nodes n left join children c using (k)
), sums as (
  select left(k, 64 * up) as k, count(*) filter (where n_children = 0) as n_leaves,
         sum((n_convs - 1) * bytes)::bigint as saved_tokens
  from (select *, unnest(range(depth + 1)) as up from own) group by 1
), ends as (
  select k, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(k, depth) as k from keyed group by conv_id) group by k
)
select o.conv_id, o.depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from own o join sums s using (k) left join ends e using (k)
left join nodes p on p.k = o.parent and o.depth > 0
"""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reachset.llm.conversation_trie import exchanged_heads, prefix_trie
from reachset.llm.parentheses import Parentheses, block_ranges, pack, range_min, unpack

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, place long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)


def paths(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}


def exchanged(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(own):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        for d in range(len(own[c]) + 1):
            members[tuple(own[c][:d])].append(c)
        ends[tuple(own[c])].append(c)
    below, children = defaultdict(list), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
        if node:
            children[node[:-1]] += 1
    out = []
    for node, convs in members.items():
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in below[node] if u)
        out.append((
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node],
            sum(not children[u] for u in below[node]), saved,
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(seed, n=60, vocabulary=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(2 * n), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice("ua"), "é" * rng.randrange(vocabulary)))
    rng.shuffle(rows)
    return rows


HARD = [
    (0, 1, "user", "b"), (0, None, "user", "a"), (0, 2, None, None), (0, 2, None, None),
    (3, 1, "user", "Öl"), (3, 2, "assistant", "x" * 20_000),
    (4, 1, "user", ""), (4, 1, "user", ""), (4, 2, "", None),
    (5, 1, "user", "a"), (None, 1, "user", "lost"), (None, None, None, None),
    (11, 1, "user", "a"), (12, 1, "user", "a"), (13, 7, "user", "a"), (1, 1, "user", "a"),
]


def test_hard_rows(spark):
    turns = frame(spark, HARD).repartition(3)
    assert got(prefix_trie(turns)) == brute(paths(HARD))
    assert got(prefix_trie(turns, exchanged_heads(turns))) == brute(exchanged(paths(HARD)))


@pytest.mark.parametrize("segment, shard_size", [(1 << 16, 1 << 18), (1 << 16, 25), (3, 40)])
def test_shards_and_segments_change_nothing(spark, segment, shard_size):
    rows = conversations(segment + shard_size)
    turns = frame(spark, rows).repartition(4)
    heads = exchanged_heads(turns)
    assert got(prefix_trie(turns, heads, segment, shard_size)) == brute(exchanged(paths(rows)))


def test_one_conversation_with_a_third_of_the_turns(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(400)]
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(200) for t in range(4)]
    got_rows = got(prefix_trie(frame(spark, rows).repartition(4), segment=64, shard_size=100))
    assert got_rows == brute(paths(rows))


def test_a_third_of_the_conversations_alike(spark):
    rows = [(c, t, "user", "same") for c in range(700) for t in range(2)]
    rows += [(10_000 + c, t, "user", f"{c % 50} {t}") for c in range(400) for t in range(3)]
    assert got(prefix_trie(frame(spark, rows).repartition(4), shard_size=60)) == brute(paths(rows))


def test_no_rows(spark):
    turns = frame(spark, [])
    assert prefix_trie(turns, exchanged_heads(turns)).count() == 0


@given(st.lists(st.integers(0, 6), max_size=400), st.randoms())
@settings(max_examples=150, deadline=None)
def test_find_close_and_ranks(depths, rng):
    # a forest from a walk: each node opens, then some of the open ones close
    opens, stack, want, leaves = [], [], {}, []
    for d in depths:
        while len(stack) > d:
            want[stack.pop()] = len(opens)
            opens.append(False)
        stack.append(len(opens))
        opens.append(True)
    while stack:
        want[stack.pop()] = len(opens)
        opens.append(False)
    if not opens:
        return
    bits = np.array(opens)
    assert (unpack(pack(bits), len(depths)) == bits).all()
    tree = Parentheses(bits, *block_ranges(bits))
    close = tree.find_close()
    assert close.tolist() == [want[i] for i in np.flatnonzero(bits)]
    for start, stop in zip(tree.start, close):
        leaves.append(sum(opens[i] and not opens[i + 1] for i in range(start, stop)))
    assert tree.leaves(tree.start, close).tolist() == leaves


@given(st.lists(st.integers(-9, 9), min_size=1, max_size=70), st.data())
@settings(max_examples=100, deadline=None)
def test_range_min(values, data):
    pairs = data.draw(st.lists(st.tuples(st.integers(0, len(values) - 1), st.integers(1, len(values))), min_size=1))
    pairs = [(a, min(n, len(values) - a)) for a, n in pairs]
    first, size = np.array(pairs).T
    assert range_min(np.array(values), first, size).tolist() == [min(values[a : a + n]) for a, n in pairs]

from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reachset.llm.mixing import flight, land, mix_documents, mixed_rows, water_fill

from .conftest import ROWS


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_share_all_words_under_the_cap(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    targets = water_fill(sizes, weights, 3)
    assert abs(sum(targets) - sum(sizes)) < 1e-6 * (1 + sum(sizes))
    assert all(0 <= t <= 3 * s + 1e-9 for t, s in zip(targets, sizes))
    free = [t / w for t, w, s in zip(targets, weights, sizes) if s and t < 3 * s * (1 - 1e-9)]
    assert not free or max(free) - min(free) < 1e-6 * max(free)


@settings(deadline=None)
@given(st.integers(1, 200), st.integers(0, 10_000))
def test_flight_keeps_both_sums(n, seed):
    rng = np.random.default_rng(seed)
    pi, size = rng.random(n), rng.integers(0, 50, n)
    done = flight(pi, size, rng)
    assert abs(done.sum() - pi.sum()) < 1e-6
    assert abs((done * size).sum() - (pi * size).sum()) < 1e-4
    assert ((done > 0) & (done < 1)).sum() <= 2
    landed = land(done, size)
    assert set(landed) <= {0.0, 1.0}
    assert abs(((landed - pi) * size).sum()) <= 50


def test_inclusion_is_fair():
    pi, size = np.array([0.2, 0.5, 0.7, 0.6, 0.4, 0.6]), np.array([5, 9, 2, 7, 3, 4])
    taken = sum(flight(pi, size, np.random.default_rng(k)) for k in range(4000)) / 4000
    assert np.abs(taken - pi).max() < 0.04


def test_sources_come_near_their_targets(make):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(n), "en", f"s{min(i % 9, 4)}") for i, n in enumerate(rng.integers(1, 90, 3000))]
    docs = make(rows).repartition(4)
    got = mix_documents(docs, block=64).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    total, size, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r.doc_id]
        assert r.taken in [k * r.size for k in range(4)] and r.size == rows[r.doc_id][1].count("w")
        total[s] += r.taken
        size[s] += r.size
        target[s] = r.target
    assert {r.source_size for r in got} == set(size.values())
    assert target == dict(zip(sorted(size), water_fill([size[s] for s in sorted(size)], [1, 2, 3, 1, 2], 3)))
    assert all(abs(total[s] - target[s]) <= 3 for s in size)
    again = mix_documents(docs.repartition(7), block=64).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_edge_rows(edge_docs):
    got = mix_documents(edge_docs).collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(
        ((i, len((t or "").split())) for i, t, *_ in ROWS), key=repr
    )
    rows = mixed_rows(edge_docs)
    assert rows.columns == edge_docs.columns
    assert rows.count() == sum(r.copies for r in got)
    words = sum(len((r.text or "").split()) for r in rows.collect())
    assert words == sum(r.taken for r in got)


def test_no_rows(no_docs):
    assert mix_documents(no_docs).count() == 0
    assert mixed_rows(no_docs).count() == 0


def test_landing_turns_the_best_pair():
    from itertools import combinations

    import numpy as np

    from reachset.llm.mixing import land, turns

    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 9, 40):
        for _ in range(20):
            change = rng.choice([-1, 1], n) * rng.integers(0, 500, n).astype(float)
            miss = float(rng.normal(0, 400))
            left, which = turns(miss, change)
            sets = [()] + [(i,) for i in range(n)] + list(combinations(range(n), 2))
            assert abs(left - min(abs(miss + sum(change[list(x)])) for x in sets)) < 1e-6
            assert len(set(which)) == len(which) and abs(abs(miss + change[which].sum()) - left) < 1e-6
    size = np.array([2_000, 900, 850, 40, 30, 20, 700, 650])
    pi = np.array([0.1, 1, 1, 0, 1, 0, 0, 0.5])
    taken = land(pi, size)
    assert set(taken) <= {0.0, 1.0} and abs(((taken - pi) * size).sum()) < 60

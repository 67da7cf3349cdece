from collections import defaultdict

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reachset.llm.components import connected_components
from reachset.llm.jaccard_join import jaccard_groups, keep_one

from .conftest import ROWS


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def roots(nodes, links):
    top = {x: x for x in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows, n, percent):
    """Every pair of rows, compared."""
    sets = [shingles(t, n) for _, t in rows]
    links = [
        (a, b)
        for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = roots(range(len(rows)), links)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        out.append((i, len(sets[k]), min(least[root[k]], default=None) if sets[k] else i))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_edge_rows(edge_docs):
    rows = [r[:2] for r in ROWS]
    assert got(jaccard_groups(edge_docs)) == brute(rows, 4, 85)
    assert got(jaccard_groups(edge_docs, n=2, percent=30)) == brute(rows, 2, 30)


def near_copies(seed, groups=12, members=9, length=60):
    """Groups around a base, with chains, passages that all share, and loners."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 5000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(length)] + passage * (g % 2)
        for m in range(members):
            text = list(base)
            for _ in range(rng.integers(0, 5)):
                text[rng.integers(0, len(text))] = word()
            if m % 3 == 2:
                base = text  # a chain: the next ones start from here
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, " ".join(passage + [word()])) for k in range(8)]
    return rows


def test_groups_equal_all_pairs(make):
    for seed, n, percent in ((1, 4, 85), (2, 5, 80), (3, 3, 60)):
        rows = near_copies(seed)
        assert got(jaccard_groups(make(rows).repartition(5), n=n, percent=percent)) == brute(rows, n, percent)


def test_one_large_group(make):
    rng = np.random.default_rng(7)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for i in range(250):
        text = list(base)
        for _ in range(rng.integers(0, 3)):
            text[rng.integers(0, 80)] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(text)))
    assert got(jaccard_groups(make(rows).repartition(5))) == brute(rows, 4, 85)


def test_one_of_each_group_stays(make, edge_docs):
    rows = near_copies(5, groups=6)
    kept = {r.doc_id for r in keep_one(make(rows)).collect()}
    groups = [eval(r) for r in brute(rows, 5, 80)]
    assert kept == {g for _, _, g in groups}
    out = keep_one(edge_docs)
    assert out.columns == edge_docs.columns
    # empty documents stay; equal sets leave one row, the smallest id's
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(
        ["3", "9", "4", "7", "11", "12", "14", "None"]
    )


def test_no_rows(no_docs):
    assert jaccard_groups(no_docs).count() == 0
    assert keep_one(no_docs).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=50))
def test_components(spark, links):
    stars = connected_components(spark.createDataFrame(links, "u long, v long"))
    root = roots(range(41), links)
    assert {(r.u, r.v) for r in stars.collect()} == {(x, r) for x, r in root.items() if x != r}


def test_a_long_path_is_one_component(spark):
    stars = connected_components(spark.range(1, 200).selectExpr("id as u", "id - 1 as v"))
    assert {(r.u, r.v) for r in stars.collect()} == {(k, 0) for k in range(1, 200)}

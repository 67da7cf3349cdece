from collections import Counter

import numpy as np
import pytest

from reachset.llm import jaccard_join as op

from .conftest import ROWS
from .test_jaccard_join import brute, near_copies, shingles


def links(rows, n, percent):
    """Every pair of different sets, compared: the overlap by pair."""
    sets = sorted({shingles(t, n) for _, t in rows} - {frozenset()}, key=sorted)
    return {
        frozenset((a, b)): len(a & b)
        for k, a in enumerate(sets) for b in sets[:k]
        if 100 * len(a & b) >= percent * len(a | b)
    }


def check(docs, rows, n, percent):
    want = links(rows, n, percent)
    members, found = op.jaccard_join(docs, n=n, percent=percent)
    found = found.collect()
    assert members.count() == len(rows) and all(r.u < r.v for r in found)
    assert len({(r.u, r.v) for r in found}) == len(found) == len(want)
    assert Counter(r.overlap for r in found) == Counter(want.values())
    degree = Counter(s for pair in want for s in pair)
    expected = Counter((i, degree[shingles(t, n)]) for i, t in rows)
    got = op.linked_documents(docs, n=n, percent=percent).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == expected
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute(rows, n, percent)


@pytest.mark.parametrize("spread", [3, 256])
def test_no_link_inside_a_group_is_lost(make, monkeypatch, spread):
    monkeypatch.setattr(op, "SPREAD", spread)
    rng = np.random.default_rng(4)
    base = [f"b{k}" for k in range(80)]
    rows = near_copies(1, groups=4)
    for i in range(60):
        text = list(base)
        for _ in range(rng.integers(0, 4)):
            text[rng.integers(0, 80)] = f"x{rng.integers(0, 10**6)}"
        rows += [(1000 + i, " ".join(text))] * (1 + i % 3)
    check(make(rows).repartition(5), rows, 4, 85)


def test_links_of_edge_rows(edge_docs):
    check(edge_docs, [r[:2] for r in ROWS], 2, 30)


def test_the_filter_of_sets_loses_none(spark):
    from pyspark.sql import functions as F

    from reachset.llm.jaccard_join import id_filter, maybe_in

    ids = spark.range(30_000).select(F.xxhash64("id").alias("id"))
    found = id_filter(ids)
    assert found.nbytes == 1 << 24
    assert all(maybe_in(found, r.id) for r in ids.collect())
    others = spark.range(30_000).select(F.xxhash64(F.col("id") + 90_000).alias("id"))
    assert sum(maybe_in(found, r.id) for r in others.collect()) < 10
    assert not id_filter(ids.where("false")).any()


def test_links_of_a_large_group_are_counted_without_a_row_each(make, monkeypatch):
    made, write = [], op.materialize

    def counted(df, *names):
        out = write(df, *names)
        made.append(out.count())
        return out

    monkeypatch.setattr(op, "materialize", counted)
    monkeypatch.setattr(op, "SPREAD", 40)
    base = [f"b{k}" for k in range(60)]
    rows = []
    for i in range(150):  # any two differ in two words: 49 of 65 n-grams at least in common
        rows.append((i, " ".join([*base[: i % 50], f"x{i}", *base[i % 50 + 1 :]])))
    want = Counter(s for pair in links(rows, 4, 70) for s in pair)
    assert sum(want.values()) > 20_000
    got = op.linked_documents(make(rows).repartition(5), percent=70).collect()
    assert Counter(r.n_links for r in got) == Counter(want.values())
    assert {r.component_id for r in got} == {0}
    assert max(made) < 30 * len(rows)

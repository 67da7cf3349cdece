import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from reachset.llm.exact_dedup import dedup_table, drop_copies, heavy_digests, text_digest

from .conftest import ROWS


def digest(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    out = []
    for d, ids in groups.items():
        named = sorted(x for x in ids if x is not None)
        order = named + [None] * (len(ids) - len(named))
        out += [(x, order[0], len(ids), k == 0, d) for k, x in enumerate(order)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows(edge_docs):
    assert got(dedup_table(edge_docs)) == brute([r[:2] for r in ROWS])
    # every digest may be a heavy one, and none
    for support in (0.05, 1.0):
        assert got(dedup_table(edge_docs, support=support)) == brute([r[:2] for r in ROWS])


def test_hot_group_is_decided_on_the_map_side(make):
    rows = [(i, "hot text") for i in range(1000, 0, -1)] + [(5000 + i, f"t{i // 2}") for i in range(2000)]
    docs = make(rows).repartition(7)
    assert got(dedup_table(docs)) == brute(rows)
    rows_of = docs.select(F.col("doc_id").alias("id"), text_digest().alias("digest"), F.monotonically_increasing_id().alias("row"))
    heavy = heavy_digests(rows_of)
    assert [(r.digest, r.heavy_keep, r.heavy_size) for r in heavy.collect()] == [(digest("hot text"), 1, 1000)]


def test_kept_rows_have_their_columns(edge_docs):
    kept = drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    want = sorted(((i, d) for i, _, _, k, d in brute([r[:2] for r in ROWS]) if k), key=repr)
    assert sorted(((r.doc_id, digest(r.text)) for r in kept.collect()), key=repr) == want


def test_no_rows(no_docs):
    assert dedup_table(no_docs).count() == 0
    assert drop_copies(no_docs).count() == 0


def test_a_third_of_the_rows_alike_whatever_their_ids(make):
    for hot in (None, 7):
        rows = [(hot, "hot text")] * 1500 + [(5000 + i, f"t{i // 2}") for i in range(3000)]
        docs = make(rows).repartition(6)
        assert got(dedup_table(docs)) == brute(rows)
        assert drop_copies(docs).count() == 1501
        rows_of = docs.select(F.col("doc_id").alias("id"), text_digest().alias("digest"), F.monotonically_increasing_id().alias("row"))
        (heavy,) = heavy_digests(rows_of).collect()
        assert (heavy.heavy_keep, heavy.heavy_size) == (hot, 1500)  # one row of it is left to the shuffle

import hashlib

import numpy as np
from pyspark.sql import functions as F

from reachset.llm.fingerprints import fingerprint_documents, likeness, op10_i_match

from .conftest import ROWS


def edited(text, following):
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def test_edited_texts_and_likeness(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in op10_i_match(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    prints = {}
    for (i, text), (j, following) in zip(rows, rows[1:] + rows[:1]):
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited(text, following).encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if got[j].fingerprint == r.fingerprint:
            assert r.near_next == 1
    near = np.array([(r.near_edited, r.near_next) for r in got.values()])
    assert near[:, 0].mean() > 0.25 > 0.1 > near[:, 1].mean()
    assert (near[:, 0] > near[:, 1]).mean() > 0.9


def test_edge_rows(edge_docs):
    got = fingerprint_documents(edge_docs, buckets=5).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    # descending ids, null last; after the null row comes the first again
    by = {r.doc_id: r for r in got}
    text = {r[0]: r[1] or "" for r in ROWS}
    for i, j in ((14, 12), (12, 11), (11, 9), (9, 7), (7, 5), (4, 3), (None, 14)):
        assert by[i].edited_sha256 == hashlib.sha256(edited(text[i], text[j]).encode()).hexdigest()
    assert by[9].fingerprint == by[4].fingerprint and by[9].near_edited == 1.0
    one = fingerprint_documents(edge_docs.where("doc_id = 12"), buckets=5).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_no_rows(no_docs):
    assert fingerprint_documents(no_docs).count() == 0


def test_likeness_of_informative_subsets(spark):
    row = spark.range(1).select(
        likeness(F.array(*map(F.lit, [42, 1, 2, 42, 3])), F.array(*map(F.lit, [42, 1, 5, 7, 3]))).alias("a"),
        likeness(F.array(F.lit(42)), F.array(F.lit(42))).alias("b"),
        likeness(F.array(*map(F.lit, [1, 2, 3])), F.array(*map(F.lit, [1, 9, 9])), informative=1).alias("c"),
    ).first()
    assert tuple(row) == (0.5, 1.0, 1.0)

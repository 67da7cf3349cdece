"""Keyword attribution by the phrase join against a brute-force scan."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_keyword_brute_force import PIECES, WORDS, brute

from reachset.functions.predicates import keyword_any
from reachset.operators.phrase_join import keyword_hits, phrase_table
from reachset.plans.any_signal import TECH_KEYWORDS


texts = st.lists(
    st.lists(st.sampled_from(PIECES), min_size=0, max_size=10).map("".join), min_size=1, max_size=30
)


def _hits(spark, rows, words, schema="doc_id int, text string"):
    df = spark.createDataFrame(rows, schema)
    return {(r.doc_id, r.keyword) for r in keyword_hits(df, phrase_table(spark, words)).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=texts, words=st.sampled_from([WORDS, list(TECH_KEYWORDS), ["a  a", "c#", ".net", "ti"]]))
def test_equals_brute_force(spark, texts, words):
    names = {w.strip() for w in words}
    want = {(i, w) for i, t in enumerate(texts) for w in names if brute(t, [w])}
    assert _hits(spark, list(enumerate(texts)), words) == want


@pytest.mark.parametrize(
    "text, words",
    [
        ("xa  a a", ["a  a"]),  # the pair before is inside a word
        ("a  a a", ["a  a", "a a"]),
        ("c#java c# C#", ["c#", "java"]),
        ("...NET", [".net", "net"]),
        ("a" + "." * 500 + "net", [".net", "a.net"]),
        ("x" * 5000 + " tech " + "y" * 5000, ["tech", "x"]),
        ("ſoftware K", ["software", "k"]),  # long s, Kelvin sign
        ("\u212bngstr\u00f6m STRA\u1e9eE", ["\u00e5ngstr\u00f6m", "stra\u00dfe"]),
        ("", ["tech"]),
    ],
)
def test_agrees_with_the_word_search(spark, text, words):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    want = {(1, w) for w in words if df.where(keyword_any("text", [w])).count()}
    assert _hits(spark, [(1, text)], words) == want


def test_nulls_repeats_and_other_columns(spark):
    rows = [(None, "tech", "k"), (None, "tech", "k"), (2, None, "k"), (3, "Tech tech", "k")]
    got = _hits(spark, rows, ["tech", " tech "], "doc_id int, text string, keyword string")
    assert got == {(None, "tech"), (3, "tech")}
    assert _hits(spark, [], ["tech"]) == set()


def test_lists_that_cannot_be_joined(spark):
    with pytest.raises(ValueError):
        _hits(spark, [(1, "a")], ["++"])
    with pytest.raises(ValueError):
        _hits(spark, [(1, "a")], [" "])


def test_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _hits(spark, [(1, "java e c#"), (2, "javas")], WORDS) == {
            (1, "java"), (1, "c#"), (2, "javas")
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_documents_that_a_keyword_hits_are_those_of_the_word_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = keyword_hits(docs, phrase_table(spark, TECH_KEYWORDS))
    ids = {r.doc_id for r in got.collect()}
    assert ids
    assert ids == {r.doc_id for r in docs.where(keyword_any("text", TECH_KEYWORDS)).collect()}

"""Whole-word keyword search (prefix-tree regex in the JVM) against a
brute-force Python scan, on random texts built from keyword fragments."""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reachset.functions.predicates import keyword_any, keyword_forms
from reachset.plans.any_signal import TECH_KEYWORDS

WORDS = ["tech", "technology", "ti", "tic", "java", "javas", "desenvolvedor", "desenvolvedor c#",
         "c#", "analista de bi", "analista", "júnior", "senior"]
PIECES = WORDS + ["TECH", "Ti", "x", "de", "bi", "c", "#", "é", "ê", ".", "-", " ", "  ", "9",
                  "́", "â", "flutter", "sistemas", "analista de sistemas sênior"]


def _word_char(ch: str) -> bool:
    return unicodedata.category(ch)[0] in "LMN"


def brute(text: str, words) -> bool:
    low = text.lower()
    for w in keyword_forms(words):
        lw = w.lower()
        start = low.find(lw)
        while start != -1:
            end = start + len(lw)
            before_ok = start == 0 or not _word_char(text[start - 1])
            after_ok = end == len(text) or not _word_char(text[end])
            if before_ok and after_ok:
                return True
            start = low.find(lw, start + 1)
    return False


texts = st.lists(
    st.lists(st.sampled_from(PIECES), min_size=1, max_size=8).map("".join), min_size=1, max_size=40
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=texts, words=st.sampled_from([WORDS, list(TECH_KEYWORDS), ["ti", "tic", "tech"]]))
def test_words_mode_equals_brute_force(spark, texts, words):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i for r in df.where(keyword_any("t", words)).collect()}
    want = {i for i, t in enumerate(texts) if brute(t, words)}
    assert got == want

"""Keyword attribution by a phrase join (F7): which keyword hit which row.

``keyword_any`` answers *whether* any keyword occurs, with one regular
expression that grows with the list.  Here the texts are cut into tokens (runs
of letters, marks and digits), every token and every pair of neighbours is a
key, and the keys are equi-joined with the first one or two tokens of the
keywords.  A key brings along the few tokens around it, so what the join finds
is checked exactly, by the same rule as ``mode="words"``, without the text.
The work on a text does not depend on the number of keywords; it is meant for
search strings and long lists.  To know only whether one of a few dozen
keywords occurs in whole documents, ``keyword_any`` is cheaper.

Spark broadcasts the keywords while its own size estimate allows it; a longer
list is shuffled by key with the keys of the texts.

Defined results: a null or empty text has no hit; a keyword is found in both
Unicode forms and in any case, as a whole word; keywords are trimmed, repeated
ones count once; rows with equal ids are one (null ids too); an empty table
gives an empty result; the result has the id and ``keyword`` only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import keyword_forms, keyword_pattern

_WORD = r"[\p{L}\p{M}\p{N}]"
_REST = r"[^\p{L}\p{M}\p{N}]"


# Letters that are capitals of a letter which has another capital too.
_CAPITALS, _SMALL = "\u0130\u212a\u212b\u2126\u1e9e\u03f4", "ik\u00e5\u03c9\u00df\u03b8"


def _fold(text: Column) -> Column:
    """One spelling for all that a case-insensitive match takes as equal."""
    return F.upper(F.translate(text, _CAPITALS, _SMALL))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({_WORD}+)"), F.lit(1))


def phrase_table(spark: SparkSession, keywords: Iterable[str]) -> DataFrame:
    """``keyword, pattern, n_tokens, length, key``: a row for each Unicode form of each keyword."""
    words = dict.fromkeys(w.strip() for w in keywords)
    rows = [(w, keyword_pattern([w]), form) for w in words if w for form in keyword_forms([w])]
    tokens = _tokens(_fold(F.col("form")))
    table = spark.createDataFrame(rows, "keyword string, pattern string, form string").select(
        "keyword", "pattern", tokens.alias("tokens"), F.length("form").alias("length")
    )
    return table.select(
        "keyword", "pattern", F.size("tokens").alias("n_tokens"), "length",
        F.array_join(F.slice("tokens", 1, 2), " ").alias("key"),
    ).distinct()


def keyword_hits(
    df: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, keyword``: every keyword of ``phrases`` (:func:`phrase_table`) with each row it hits.

    A keyword needs a letter or digit; without one it has no key to join on
    and a ``ValueError`` says so.
    """
    bound = phrases.agg(
        F.min("n_tokens").alias("least"), F.max("n_tokens").alias("n_tokens"),
        F.max("length").alias("length"),
    ).first()
    if bound.least is None:
        raise ValueError("keyword list is empty")
    if bound.least == 0:
        raise ValueError("a keyword needs a letter or a digit")
    # the gap before a token, the token, the tokens a keyword can reach and the gap after them
    token = f"{_REST}*+{_WORD}++"
    near = f"(?=((?:{token}){{1,{bound.n_tokens}}}{_REST}*+)){token}"
    parts = df.select(
        F.col(id_col).alias("id"),
        F.regexp_extract_all(F.col(text), F.lit(near), F.lit(1)).alias("near"),
        _tokens(_fold(F.col(text))).alias("one"),
    )
    zipped = F.arrays_zip("near", "one", F.slice("one", 2, F.greatest(F.size("one"), F.lit(1))).alias("two"))
    places = parts.select("id", F.posexplode(zipped).alias("at", "p"))
    keys = places.select(
        "id", "at", F.col("p.near").alias("near"),
        F.explode(F.array("p.one", F.concat("p.one", F.lit(" "), "p.two"))).alias("key"),
    )
    found = keys.where(F.col("key").isNotNull()).join(
        phrases.select("key", "keyword", "pattern"), "key"
    )
    # a token stands before all but the first; its stand-in is longer than any keyword, so no
    # match starts with it
    before = F.when(F.col("at") > 0, F.lit("x" * (bound.length + 1))).otherwise(F.lit(""))
    return found.where(F.regexp_like(F.concat(before, "near"), F.col("pattern"))).select(
        F.col("id").alias(id_col), "keyword"
    ).distinct()

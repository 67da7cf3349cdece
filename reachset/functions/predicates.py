"""Row predicates.

Every function returns a :class:`~pyspark.sql.Column`, so the predicates
compose with ``&``/``|`` and stay inside whole-stage codegen.  Equality,
inequality, comparison and ``isin`` need no wrapper: write ``F.col(c) == v``
and Catalyst pushes them to the Parquet scan.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(*preds: Column) -> Column:
    """Conjunction; the event-store language's juxtaposition (F8)."""
    if not preds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, preds)


def any_of(*preds: Column) -> Column:
    """Disjunction (F8)."""
    if not preds:
        return F.lit(False)
    return reduce(lambda a, b: a | b, preds)


def non_empty(c: ColumnOrName) -> Column:
    """``c != ''``; null is not kept either."""
    return _c(c) != F.lit("")


def id_key(c: ColumnOrName) -> Column:
    """An id stored as text or number, as bigint; '', 'abc', overflow -> null."""
    return _c(c).try_cast("bigint")


def positive_id(c: ColumnOrName) -> Column:
    """Id greater than zero, for ids stored as text or number.

    ``try_cast`` turns '', 'abc' and overflow into null, so the predicate is
    false for them instead of failing the job.
    """
    return id_key(c) > F.lit(0)


# --------------------------------------------------------------------------
# regular expressions
# --------------------------------------------------------------------------

_PREFIX = re.compile(r"^((?:[^\\.^$|?*+()\[\]{}]|\\[\\.^$|?*+()\[\]{}])+)\.\*$")


def literal_prefix(pattern: str) -> str | None:
    """The literal ``p`` if ``pattern`` is exactly ``p.*``, else None."""
    m = _PREFIX.match(pattern)
    if not m:
        return None
    return re.sub(r"\\(.)", r"\1", m.group(1))


def matches(c: ColumnOrName, pattern: str) -> Column:
    """Full match of a Java regular expression (the ``=~`` operator, F6/D6).

    ``rlike`` is a *find*; anchoring with ``\\A(?s:...)\\z`` makes it a full
    match (``$`` would also accept a trailing newline).  ``.`` matches any
    character, line breaks included, so a pattern that is a plain prefix
    followed by ``.*`` is exactly ``startswith`` -- which Spark pushes to the
    Parquet reader instead of running a regex per row.
    """
    prefix = literal_prefix(pattern)
    if prefix is not None:
        return _c(c).startswith(prefix)
    return _c(c).rlike(f"\\A(?s:{pattern})\\z")


def _escape_java(word: str) -> str:
    # \Q...\E quoting; a literal \E inside the word must be split out
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def keyword_forms(words: Iterable[str]) -> list[str]:
    """Trimmed, de-duplicated keywords in both Unicode forms (NFC and NFD)."""
    seen: dict[str, None] = {}
    for w in words:
        w = w.strip()
        if not w:
            continue
        for form in (unicodedata.normalize("NFC", w), unicodedata.normalize("NFD", w), w):
            seen.setdefault(form, None)
    if not seen:
        raise ValueError("keyword list is empty")
    return list(seen)


def _trie_alternation(words: Iterable[str]) -> str:
    """One regex alternation shaped as a prefix tree of the literal words.

    ``tech|technology|ti`` becomes ``t(?:ech(?:nology)?|i)``: at each text
    position the matcher tests a handful of first characters instead of
    every keyword, which is what makes whole-document search affordable.
    Greedy optional tails try the longer keyword first and backtrack to the
    shorter one, so every keyword can still match.
    """
    trie: dict = {}
    for w in words:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        branches = []
        for ch in sorted(k for k in node if k):
            lit, sub = ch, node[ch]
            while len(sub) == 1 and "" not in sub:
                (nxt, sub), = sub.items()
                lit += nxt
            branches.append(_escape_java(lit) + emit(sub))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if "" in node else body

    return emit(trie)


_WORD_CHAR = "[\\p{L}\\p{M}\\p{N}]"


def keyword_pattern(words: Iterable[str]) -> str:
    """Whole-word, case-insensitive search for any of the literal keywords.

    Each keyword is trimmed; duplicates and blanks are dropped; both Unicode
    forms (composed NFC and decomposed NFD) are included, so text in either
    form matches.  Word boundaries are letters, marks and digits, not ``\\b``
    (``\\b`` cannot end a keyword such as ``c#``).
    """
    body = _trie_alternation(keyword_forms(words))
    return f"(?iu)(?<!{_WORD_CHAR})(?:{body})(?!{_WORD_CHAR})"


def keyword_any(c: ColumnOrName, words: Iterable[str] | str, mode: str = "words") -> Column:
    """Free-text keyword search.

    ``mode="words"``  (default) any keyword as a whole word, ignoring case.
    ``mode="contains"`` any keyword as a substring, case as given.
    ``mode="pattern"`` ``words`` is one raw regular expression, full match --
    the reading of the reference's pattern as written.
    """
    col = _c(c)
    if mode == "pattern":
        if not isinstance(words, str):
            raise TypeError("mode='pattern' takes one pattern string")
        return matches(col, words)
    if isinstance(words, str):
        words = words.split("|")
    words = list(words)
    if mode == "words":
        return col.rlike(keyword_pattern(words))
    if mode == "contains":
        ws = list(dict.fromkeys(w for w in words if w))
        if not ws:
            raise ValueError("keyword list is empty")
        return any_of(*(col.contains(w) for w in ws))
    raise ValueError(f"unknown mode {mode!r}")


# --------------------------------------------------------------------------
# multi-valued fields
# --------------------------------------------------------------------------


def any_value_in(c: ColumnOrName, values: Iterable, scalar: bool = False) -> Column:
    """Multi-valued ``IN``: true when any element is one of ``values``.

    ``scalar=True`` for a field stored as one value; :func:`is_multivalued`
    tells from a frame's schema.
    """
    vals = list(dict.fromkeys(values))
    if not vals:
        return F.lit(False)
    col = _c(c)
    if scalar:
        return col.isin(*vals)
    if len(vals) == 1:
        return F.array_contains(col, F.lit(vals[0]))
    return F.arrays_overlap(col, F.array(*[F.lit(v) for v in vals]))


def none_value_is(c: ColumnOrName, value, scalar: bool = False) -> Column:
    """Multi-valued ``!=``: no element equals ``value`` (F2 on arrays).

    A missing (null) list has no elements, so it passes, by the rule of
    :func:`not_equal`.
    """
    if scalar:
        return not_equal(c, value)
    return ~F.coalesce(F.array_contains(_c(c), F.lit(value)), F.lit(False))


def is_multivalued(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, ArrayType)


def not_equal(c: ColumnOrName, *values) -> Column:
    """``!=`` (and ``NOT IN``): a missing field equals nothing, so it passes (F2).

    One rule for scalar and multi-valued fields (SURVEY §1.4); ``!= ''`` is
    the exception, it asks for a value (:func:`non_empty`).
    """
    col = _c(c)
    differs = col != F.lit(values[0]) if len(values) == 1 else ~col.isin(*values)
    return col.isNull() | differs


# --------------------------------------------------------------------------
# country / language codes
# --------------------------------------------------------------------------


def two_letter_code(c: ColumnOrName) -> Column:
    """Trimmed value is exactly two ASCII letters (D4, as a row predicate)."""
    return F.trim(_c(c)).rlike("\\A[A-Za-z]{2}\\z")


def same_code(c: ColumnOrName, code: str, case: str = "lower") -> Column:
    """Compare a code column with a parameter in a stated case.

    ``case="lower"``/``"upper"`` trims and normalises the column, as
    :func:`two_letter_code` does, and the parameter; ``case="as_is"`` compares
    the stored value with the trimmed parameter only, which keeps the predicate
    pushable to Parquet (for data normalised at read).
    """
    code = code.strip()
    if case == "lower":
        return F.lower(F.trim(_c(c))) == F.lit(code.lower())
    if case == "upper":
        return F.upper(F.trim(_c(c))) == F.lit(code.upper())
    if case == "as_is":
        return _c(c) == F.lit(code)
    raise ValueError(f"unknown case {case!r}")


def check_code(name: str, value: str) -> str:
    """Parameter check for country/language codes: two letters after trim."""
    v = str(value).strip()
    if len(v) != 2 or not v.isalpha() or not v.isascii():
        raise ValueError(f"{name} must be two letters, got {value!r}")
    return v

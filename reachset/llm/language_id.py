"""Language identification in two steps: family, then one-versus-one inside it.

Features are hashed byte trigrams (and bigrams) of the lower-cased letters of
the whole text, damped, of unit length.  Families are found from the training
rows: languages with the most similar mean vectors are merged until about
``sqrt(languages)`` families are left.  A linear support vector machine per
family (one against the rest) names the family; inside it one machine per
pair of languages votes, ties going to the larger sum of margins.

The machines are fitted on a bounded sample: ``per_language`` labelled rows
of each language (by a hash of the id), each whole and as ``SNIPPETS`` short
stretches, so that short texts are learned as well.

Defined results: ``und`` with score 0 for a null text and for one without a
letter, and for every text if no row is labelled; empty tables give empty
results; ids, repeated rows and other columns play no part in a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from .common import documents, in_fold

DIMENSIONS = 4096
#: Lengths, in characters, of the stretches that a training row adds.
SNIPPETS = (24, 80, 300)
LETTER = regex.compile(r"\p{L}")
#: ASCII letters and all bytes of longer characters stay, others become a blank.
_KEEP = np.array([c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)], dtype=np.uint32)


def features(text: str) -> np.ndarray:
    """Unit vector of hashed byte bigrams and trigrams."""
    b = _KEEP[np.frombuffer((" " + text.lower() + " ").encode(), dtype=np.uint8)]
    pairs = b[:-1] << np.uint32(8) | b[1:]
    triples = pairs[:-1] << np.uint32(8) | b[2:]
    codes = np.concatenate([pairs | np.uint32(1 << 24), triples])
    slots = (codes * np.uint32(2654435761)) >> np.uint32(20)
    v = np.sqrt(np.bincount(slots, minlength=DIMENSIONS)).astype(np.float32)
    return v / np.linalg.norm(v)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a squared-hinge linear machine; ``y`` is -1 or 1."""
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x1.shape[1], dtype=np.float32)
    ahead, rate = w.copy(), 1.0 / (1.0 / c + 4.0)
    for k in range(rounds):  # accelerated gradient steps
        slack = np.maximum(0, 1 - y * (x1 @ ahead))
        grad = ahead / c - 2 * (x1.T @ (weight * y * slack).astype(np.float32))
        new = ahead - rate * grad
        ahead = new + (k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    families: list[list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, v: np.ndarray) -> tuple[str, float]:
        v1 = np.append(v, np.float32(1))
        score, best = 1.0, 0
        if len(self.families) > 1:
            margins = self.family_weights @ v1
            best = int(np.argmax(margins))
            score = _squash(margins[best])
        langs = self.families[best]
        votes = dict.fromkeys(langs, (0, 0.0))
        for i, a in enumerate(langs):
            for b in langs[i + 1 :]:
                m = float(self.pair_weights[a, b] @ v1)
                for lang, mine in ((a, m), (b, -m)):
                    n, s = votes[lang]
                    votes[lang] = (n + (mine > 0), s + mine)
        lang = max(langs, key=lambda x: votes[x])
        if len(langs) > 1:
            score *= _squash(votes[lang][1] / (len(langs) - 1))
        return lang, score


def _squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-4.0 * np.clip(margin, -10, 10))))


def find_families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Average-linkage merging by cosine down to about ``sqrt(languages)`` families."""
    centre = np.mean(list(means.values()), axis=0)
    unit = {k: (v - centre) / (np.linalg.norm(v - centre) + 1e-12) for k, v in means.items()}
    groups = [[k] for k in sorted(means)]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        like = {
            (i, j): np.mean([unit[a] @ unit[b] for a in groups[i] for b in groups[j]])
            for i in range(len(groups)) for j in range(i)
        }
        i, j = max(like, key=like.get)
        groups[j] = sorted(groups[j] + groups[i])
        del groups[i]
    return groups


def fit(x: np.ndarray, langs: np.ndarray) -> Model | None:
    names = sorted(set(langs.tolist()))
    if not names:
        return None
    families = find_families({k: x[langs == k].mean(axis=0) for k in names})
    family_of = {k: i for i, f in enumerate(families) for k in f}
    number = np.array([family_of[k] for k in langs])
    family_weights = np.array(
        [linear_svm(x, np.where(number == i, 1.0, -1.0)) for i in range(len(families))]
        if len(families) > 1 else []
    )
    pairs = {}
    for f in families:
        for i, a in enumerate(f):
            for b in f[i + 1 :]:
                rows = (langs == a) | (langs == b)
                pairs[a, b] = linear_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0))
    return Model(families, family_weights, pairs)


@F.pandas_udf(ArrayType(BinaryType()))
def _training_vectors(text: pd.Series, at: pd.Series) -> pd.Series:
    """The whole text's vector and those of stretches that start at a hashed place."""
    out = []
    for t, k in zip(text, at):
        cuts = [t] + [t[(s := k % max(1, len(t) - n)) : s + n] for n in SNIPPETS]
        out.append([features(c).tobytes() for c in cuts if LETTER.search(c)])
    return pd.Series(out)


def train(
    docs: DataFrame, usable: Column, id_col: str, text: str, lang: str, per_language: int = 250
) -> Model | None:
    """Fit on at most ``per_language`` of the ``usable`` rows of each language."""
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text), F.lit(9)).bitwiseAND((1 << 40) - 1).alias("h"),
    )
    different = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    counts = {r.lang: r.n for r in different.collect()}
    if not counts:
        return None
    share = F.create_map(
        *[F.lit(v) for k, n in counts.items() for v in (k, 1.2 * per_language / n)]
    )
    sample = rows.where(F.col("h") < F.element_at(share, F.col("lang")) * float(1 << 40))
    # equal rows count once, and no more rows than are used reach the driver
    first = Window.partitionBy("lang").orderBy("h")
    sample = sample.dropDuplicates(["lang", "h"]).withColumn("no", F.row_number().over(first))
    sample = sample.where(F.col("no") <= per_language)
    got = sample.select("lang", "h", _training_vectors("text", "h").alias("v")).collect()
    x, y, taken = [], [], dict.fromkeys(counts, 0)
    for r in sorted(got, key=lambda r: (r.lang, r.h)):
        if taken[r.lang] < per_language:
            taken[r.lang] += 1
            x += [np.frombuffer(v, dtype=np.float32) for v in r.v]
            y += [r.lang] * len(r.v)
    return fit(np.array(x), np.array(y)) if x else None


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [
            model.predict(features(t)) if model and t and LETTER.search(t) else ("und", 0.0)
            for t in texts
        ]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.withColumn("lang_found", predict(F.col(text)))


def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = in_fold("doc_id", 4, 2)
    model = train(docs, ~held_out, "doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_found.*")

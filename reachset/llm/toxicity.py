"""Toxicity by compression distance: two zstandard dictionaries, one per class.

Labelled training rows, whole texts, a bounded number of each class
(``toxic_rows``, ``ordinary_rows``), give two dictionaries.  The ordinary one is
trained on windows of the ordinary rows (at most ``PLAIN_WINDOWS``, by hash).
The toxic one is trained on the windows of one or two words of the toxic rows,
each as often as its contrast weighs: how much likelier it is in several
contexts of toxic text than in ordinary text, measured against what chance
gives among so many windows; windows of no weight are left out, as they would
fill the dictionary with ordinary prose.  Words of any length, pairs of ordinary
words and rare words count.  Counting, weighing and measuring the training rows
are Spark jobs; the driver holds the units that weigh, the ordinary windows and
a few numbers per training row, never texts.

Every text is cut into windows of about ``window`` bytes at blanks, whole, to the
end.  A window is compressed with the ordinary dictionary and with the toxic one
in front of it; the bytes that the toxic one saves are its distance.  A logistic
function of the distances (largest, largest three, their sum, share of windows
over ``SAVED``, mean, number of windows), calibrated on training rows the
dictionaries have not seen, is the score; ``threshold`` on it decides.

Defined results: null and empty texts are one empty window and score like
any text without savings; without labelled rows of both classes every score
is 0; ids, repeated rows, label rows without a document and other columns
play no part in a score; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, in_fold, materialize

THRESHOLD = 0.7
WINDOW = 32
#: Bytes of a trained dictionary.
DICTIONARY = 4096
#: A window that the toxic dictionary makes this many bytes shorter counts as toxic.
SAVED = 4
#: How much more often than in ordinary text a word or pair must recur to weigh.
CONTRAST = 8.0
#: A gain below this weighs nothing: ``int(4 * gain ** 3)`` is 0.
LEAST_GAIN = 0.62
#: Ordinary windows that go to the trainer, about, at most.
PLAIN_WINDOWS = 250_000
#: Parts of the training rows; each is measured with dictionaries of the others.
FOLDS = 3
LEVEL = 12
_EDGES = b".,;:!?\"'()[]*%$&|<>"


def words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The whole text as runs of words of at least ``size`` bytes (the last may be shorter)."""
    out, run, n = [], [], 0
    for w in words(text or ""):
        run.append(w)
        n += len(w) + 1
        if n >= size:
            out.append(b" " + b" ".join(run) + b" ")
            run, n = [], 0
    if run or not out:
        out.append(b" " + b" ".join(run) + b" ")
    return out


def _runs(text: str) -> list[tuple[bytes, bytes, bytes]]:
    """``word, pair, context`` all along a text: each word, with the word before it, and
    the word before both."""
    out, a, b = [], b"", b""
    for w in words(text):
        w = w.strip(_EDGES)
        out.append((w, b + b" " + w, a))
        a, b = b, w
    return out


def _first_units(text: str) -> dict[bytes, bytes]:
    """Each word and pair of words of a text, with what comes before its first place."""
    first: dict[bytes, bytes] = {}
    for w, pair, before in _runs(text):
        first.setdefault(w, pair)
        first.setdefault(pair, before)
    return first


def _contexts(texts: list[str]) -> Counter:
    """Of each word and pair of words, how many different words it follows where a text
    first has it.

    One long text, or copies of one passage, don't make a word recur.
    """
    seen: dict[bytes, set[int]] = defaultdict(set)
    for t in texts:
        for unit, context in _first_units(t).items():
            seen[unit].add(zlib.crc32(context))
    return Counter({u: len(s) for u, s in seen.items()})


def _contrast(mine: Counter, theirs: Counter, ratio: float) -> dict[bytes, float]:
    """The log-likelihood gain of each unit that recurs ``CONTRAST`` times more than
    ordinary text lets expect, in parts of what chance gives among so many units."""
    chance = np.log(1 + len(mine))
    gain = {}
    for unit, c in mine.items():
        expected = ratio * (theirs[unit] + 0.5)
        if c > max(1.0, CONTRAST * expected) and unit.strip():
            gain[unit] = (c * np.log(c / expected) - (c - expected)) / chance
    return gain


def _train(units: list[bytes], size: int, rng: np.random.Generator) -> bytes:
    """A trained dictionary of shuffled training windows, ten to a sample."""
    units = [units[i] for i in rng.permutation(len(units))]
    samples = [b" " + b" ".join(units[i : i + 10]) + b" " for i in range(0, len(units), 10)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: it is the dictionary itself
        return b"".join(samples)[-size:]


def _marked(text: str, gain: dict[bytes, float]) -> Counter:
    """How often each word or pair of a toxic text goes to the trainer."""
    out: Counter = Counter()
    for w, pair, _ in _runs(text):
        own, both = gain.get(w, 0.0), gain.get(pair, 0.0)
        if weight := min(20, int(4 * max(own, both) ** 3)):
            out[w if own >= both else pair.strip()] += weight
    return out


def _dictionaries(marked: Counter, plain: list[bytes]) -> tuple[bytes, bytes]:
    rng = np.random.default_rng(6)
    units = [u for u in sorted(marked) for _ in range(marked[u])]
    return _train(units, DICTIONARY, rng), _train(plain, DICTIONARY, rng)


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The dictionaries of texts at hand; :func:`train` makes the same ones in Spark."""
    gain = _contrast(_contexts(toxic), _contexts(ordinary), len(toxic) / len(ordinary))
    marked: Counter = Counter()
    for t in toxic:
        marked += _marked(t, gain)
    return _dictionaries(marked, [w for t in ordinary for w in windows(t)])


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
        write_checksum=False, write_dict_id=False,
    )
    given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    given.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=given, compression_params=how)


@dataclass
class Distance:
    """Bytes saved in each window; compressors are made where they are used."""

    toxic: bytes
    ordinary: bytes

    def __post_init__(self):
        self._both = None

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "_both": None}

    def saved(self, text: str | None) -> np.ndarray:
        if self._both is None:
            # the ordinary part is last in both, so ordinary text costs the same in either
            self._both = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
        plain, primed = (c.compress for c in self._both)
        return np.array([len(plain(w)) - len(primed(w)) for w in windows(text)])

    def features(self, text: str | None) -> list[float]:
        d = self.saved(text)
        top = np.sort(d)[::-1]
        return [
            float(top[0]), float(top[:3].sum()), float(np.log1p(d[d >= SAVED - 1].sum())),
            float((d >= SAVED).mean()), float(d.clip(0).mean()), float(np.log(len(d))),
        ]


@dataclass
class Model:
    distance: Distance
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        z = np.append((np.array(self.distance.features(text)) - self.mean) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(z @ self.weights, -50, 50))))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weighted logistic regression by Newton steps, lightly damped."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    b = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (weight * (y - p)) - 0.05 * b
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(b))
        b = b + np.linalg.solve(bend, slope)
    return mean, scale, b


def fit(toxic: list[str], ordinary: list[str], folds: int = FOLDS) -> Model | None:
    """:func:`train` for texts at hand."""
    if len(toxic) < folds or len(ordinary) < folds:
        return None
    x, y = [], []
    for k in range(folds):
        rest = [[t for i, t in enumerate(side) if i % folds != k] for side in (toxic, ordinary)]
        distance = Distance(*train_dictionaries(*rest))
        for label, side in ((1.0, toxic), (0.0, ordinary)):
            x += [distance.features(t) for t in side[k::folds]]
            y += [label] * len(side[k::folds])
    x, y = np.array(x), np.array(y)
    return Model(Distance(*train_dictionaries(toxic, ordinary)), *_calibrate(x, y, _balance(y)))


def _balance(y: np.ndarray) -> np.ndarray:
    """Ordinary rows weigh as if there were four for each toxic one."""
    return np.where(y > 0, 1.0, 4.0 * y.sum() / (1 - y).sum())


def training_rows(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text: str,
    toxic_rows: int, ordinary_rows: int,
) -> DataFrame:
    """``toxic, fold, text``: the labelled texts to learn from, one row for each chosen id."""
    rows = (
        labels.where(usable & F.col("toxic").isin(0, 1))
        .select(F.col(id_col).alias("id"), "toxic").distinct()
        .withColumn("h", F.xxhash64("id", F.lit(6)))
    )
    chosen = rows.where("toxic = 1").orderBy("h", "id").limit(toxic_rows).unionByName(
        rows.where("toxic = 0").orderBy("h", "id").limit(ordinary_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(
        "text is not null"
    ).join(F.broadcast(chosen), "id")  # toxic_rows + ordinary_rows ids
    # one row for each id, however often it is repeated
    one = texts.groupBy("id", "toxic", "h").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    return materialize(
        one.select(F.col("toxic").cast("int").alias("toxic"), F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold"), "text"),
        "toxic-training",
    )


def contrasts(rows: DataFrame, sizes: dict[tuple[int, int], int]) -> list[dict[bytes, float]]:
    """The gains of the units that weigh: for each fold without its rows, and last for all.

    Contexts are counted in Spark, a row for each unit, class and context; units
    that weigh in no model stay there.  ``sizes``: rows by class and fold.
    """

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                first = _first_units(r.text)
                yield pd.DataFrame(
                    {"toxic": r.toxic, "fold": r.fold, "unit": list(first),
                     "context": [zlib.crc32(c) for c in first.values()]}
                )

    found = rows.mapInPandas(units, "toxic int, fold int, unit binary, context long")
    folds = found.groupBy("unit", "toxic", "context").agg(
        F.bit_or(F.expr("shiftleft(1, fold)")).alias("folds")
    )
    models = [[k for k in range(FOLDS) if k != left] for left in range(FOLDS + 1)]
    sets = [sum(1 << k for k in m) for m in models]
    counts = [
        F.count_if((F.col("toxic") == label) & (F.col("folds").bitwiseAND(F.lit(m)) != 0)).alias(f"{name}{i}")
        for i, m in enumerate(sets) for label, name in ((1, "mine"), (0, "theirs"))
    ]
    counted = materialize(folds.groupBy("unit").agg(*counts), "units")
    known = counted.agg(*[F.count_if(F.col(f"mine{i}") > 0).alias(f"n{i}") for i in range(len(models))]).first()
    gains = []
    for i, m in enumerate(models):
        ratio = sum(sizes.get((1, k), 0) for k in m) / max(1, sum(sizes.get((0, k), 0) for k in m))
        mine, expected = F.col(f"mine{i}"), ratio * (F.col(f"theirs{i}") + 0.5)
        gain = (mine * F.log(mine / expected) - (mine - expected)) / float(np.log(1 + known[f"n{i}"]) or 1)
        weighs = (mine > F.greatest(F.lit(1.0), CONTRAST * expected)) & F.col("unit").isNotNull()
        gains.append(F.when(weighs, gain).otherwise(0.0).alias(f"gain{i}"))
    best = counted.select("unit", *gains).where(F.greatest(*[F.col(f"gain{i}") for i in range(len(models))]) >= LEAST_GAIN)
    out: list[dict[bytes, float]] = [{} for _ in models]
    for r in best.collect():  # units that recur in training rows, of which there is a bounded number
        unit = bytes(r["unit"])
        for i in range(len(models)):
            if r[f"gain{i}"] and unit.strip():
                out[i][unit] = r[f"gain{i}"]
    return out


def _plain_windows(rows: DataFrame, limit: int) -> list[tuple[int, bytes]]:
    """``fold, window`` of the ordinary rows: all, or about ``limit`` of them by hash."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield pd.DataFrame({"fold": r.fold, "window": windows(r.text)})

    found = rows.where("toxic = 0").mapInPandas(cut, "fold int, window binary")
    total = found.count()
    if total > limit:
        h = F.pmod(F.xxhash64("window", "fold"), F.lit(1 << 20))
        found = found.where(h < int(limit / total * (1 << 20)))
    got = found.toArrow()
    return sorted(zip(got["fold"].to_pylist(), got["window"].to_pylist()))


def _marked_units(rows: DataFrame, gains: list[dict[bytes, float]]) -> list[Counter]:
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                for i, gain in enumerate(gains):
                    if r.fold != i and (units := _marked(r.text, gain)):
                        yield pd.DataFrame({"model": i, "unit": list(units), "n": list(units.values())})

    found = rows.where("toxic = 1").mapInPandas(mark, "model int, unit binary, n long")
    out = [Counter() for _ in gains]
    for r in found.groupBy("model", "unit").agg(F.sum("n").alias("n")).collect():
        out[r.model][bytes(r.unit)] = r.n
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text: str = "text",
    toxic_rows: int = 1500,
    ordinary_rows: int = 3000,
    plain_windows: int = PLAIN_WINDOWS,
) -> Model | None:
    """Fit on a bounded sample of the ``usable`` label rows (by a hash of the id).

    Dictionaries of all rows; the threshold is calibrated on rows measured by
    dictionaries of the other folds, so none has seen what it is calibrated on.
    """
    rows = training_rows(docs, labels, usable, id_col, text, toxic_rows, ordinary_rows)
    sizes = {(r.toxic, r.fold): r["count"] for r in rows.groupBy("toxic", "fold").count().collect()}
    if any(sum(n for (t, _), n in sizes.items() if t == label) < FOLDS for label in (0, 1)):
        return None
    gains = contrasts(rows, sizes)
    marked, plain = _marked_units(rows, gains), _plain_windows(rows, plain_windows)
    models = [
        Distance(*_dictionaries(units, [w for fold, w in plain if fold != i])) for i, units in enumerate(marked)
    ]

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series, folds: pd.Series) -> pd.Series:
        return pd.Series([models[k].features(t) for t, k in zip(texts, folds)])

    got = rows.select("toxic", measured("text", "fold").alias("x")).collect()  # six numbers a row
    got.sort(key=lambda r: (r.toxic, r.x))
    x, y = np.array([r.x for r in got]), np.array([float(r.toxic) for r in got])
    return Model(models[-1], *_calibrate(x, y, _balance(y)))


def score(model: Model | None, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) if model else 0.0 for t in texts], dtype="float64")

    return scored(F.col(text))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id, held_out, score, predicted`` of every row; a third of the ids is never learned from."""
    held_out = in_fold(id_col, 3, 1)
    model = train(docs, labels, ~held_out, id_col, text)
    scored = docs.select(id_col, held_out.alias("held_out"), score(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` scored under the threshold."""
    model = train(docs, labels, ~in_fold(id_col, 3, 1), id_col, text)
    return docs.where(score(model, text) < threshold)


def op6_zstd_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return judge(documents(spark, sf_dir).select("doc_id", "text"), labels)

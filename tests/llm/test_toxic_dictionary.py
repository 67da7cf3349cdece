import numpy as np
import pytest

from reachset.llm.toxicity import (
    FOLDS,
    LEAST_GAIN,
    _contexts,
    _contrast,
    _marked,
    _marked_units,
    contrasts,
    fit,
    train_dictionaries,
)


def texts(seed, n, mark=None):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        words = [f"word{k}" for k in rng.integers(0, 400, 60)]
        if mark:
            for at in rng.choice(58, 5, replace=False):
                words[at : at + len(mark)] = mark
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("mark", [["xqz"], ["word7", "word11"]])
def test_short_words_and_phrases_of_ordinary_words_are_learned(mark):
    model = fit(texts(1, 150, mark), texts(2, 300))
    scores = lambda rows: np.array([model.score(t) for t in rows])
    assert (scores(texts(3, 60, mark)) >= 0.7).mean() > 0.7
    assert (scores(texts(4, 100)) >= 0.7).mean() < 0.05


def test_counts_in_spark_equal_counts_at_hand(spark):
    toxic, ordinary = texts(1, 40, ["xqz"]), texts(2, 70)
    folded = [(1, i % FOLDS, t) for i, t in enumerate(toxic)] + [(0, i % FOLDS, t) for i, t in enumerate(ordinary)]
    rows = spark.createDataFrame(folded, "toxic int, fold int, text string").repartition(4)
    sizes = {(t, k): sum((a, b) == (t, k) for a, b, _ in folded) for t in (0, 1) for k in range(FOLDS)}
    gains = contrasts(rows, sizes)
    marked = _marked_units(rows, gains)
    for left in range(FOLDS + 1):
        mine = [t for i, t in enumerate(toxic) if i % FOLDS != left]
        theirs = [t for i, t in enumerate(ordinary) if i % FOLDS != left]
        want = _contrast(_contexts(mine), _contexts(theirs), len(mine) / len(theirs))
        want = {u: g for u, g in want.items() if g >= LEAST_GAIN}
        assert b"xqz" in want and {u: g for u, g in gains[left].items() if g >= LEAST_GAIN} == pytest.approx(want)
        assert marked[left] == sum((_marked(t, want) for t in mine), type(marked[left])())
    assert train_dictionaries(toxic, ordinary)[0].count(b"xqz") > 0

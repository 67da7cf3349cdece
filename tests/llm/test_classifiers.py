from pyspark.sql import functions as F

from reachset.llm.common import in_fold
from reachset.llm.language_id import Model, find_families, fit, identify, op9_language_id, train
from reachset.llm.toxicity import judge, op6_zstd_toxicity, windows

from .conftest import ROWS

SF = "/root/testdata/sf0.01"


def test_languages_of_unseen_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op9_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    right = F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))
    r = got.where("held_out").agg(right, F.min("score"), F.max("score"), F.count("*")).first()
    assert r[0] > 0.98 and 0 <= r[1] <= r[2] <= 1 and r[3] > 100
    assert got.count() == docs.count()


def test_language_edge_rows(spark, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs, ~in_fold("doc_id", 4, 2), "doc_id", "text", "lang", per_language=40)
    assert isinstance(model, Model) and sorted(x for f in model.families for x in f) == ["de", "en", "es", "fr"]
    got = identify(edge_docs, model).select("text", "lang_found.*").collect()
    assert len(got) == len(ROWS)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1


def test_language_without_training_rows(spark, no_docs, edge_docs):
    assert train(no_docs, F.lit(True), "doc_id", "text", "lang") is None
    assert {r.lang_found.lang_pred for r in identify(edge_docs, None).collect()} == {"und"}
    assert identify(no_docs, None).count() == 0


def test_close_languages_share_a_family():
    import numpy as np

    rng = np.random.default_rng(0)
    unit = lambda v: (v / np.linalg.norm(v)).astype(np.float32)
    stem = {k: rng.normal(size=50) for k in "ab"}
    means = {x + y: unit(stem[x] + 0.5 * rng.normal(size=50)) for x in "ab" for y in "ab"}
    assert find_families(means) == [["aa", "ab"], ["ba", "bb"]]
    x = np.vstack([unit(means[k] + 0.02 * rng.normal(size=50)) for k in means for _ in range(20)])
    names = np.repeat(list(means), 20)
    model = fit(x, names)
    assert [model.predict(v)[0] for v in x] == names.tolist()


def test_windows_hold_the_whole_text():
    text = "Some words, and others\nand a verylongword" + "x" * 300 + " end"
    assert b" ".join(w.strip() for w in windows(text)).split() == text.lower().encode().split()
    assert all(len(w) >= 32 for w in windows(text)[:-1])
    assert len(windows(None)) == len(windows(" \n")) == 1


def test_toxicity_of_unseen_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    got = op6_zstd_toxicity(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.where("(score >= 0.7) != (predicted = 1) or score < 0 or score > 1").count() == 0
    r = {
        x.toxic: x.p
        for x in got.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    }
    assert r[1] > 0.6 and r[0] < 0.04


def test_toxicity_edge_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = judge(edge_docs, none).collect()
    assert len(got) == len(ROWS) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    labels = spark.createDataFrame(
        [(i, 1, i % 2) for i in (3, 4, 5, 7, 9, 11, 12, 14, 99)] + [(None, 1, 1), (5, 1, None), (5, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    assert len(judge(edge_docs, labels).collect()) == len(ROWS)
    assert judge(no_docs, labels).count() == 0

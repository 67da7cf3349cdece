from pyspark.sql import functions as F

from reachset.llm import language_id, toxicity


def test_a_repeated_label_id_is_one_training_row(make, spark):
    docs = make([(1, f"bad text {k}") for k in range(50)] + [(2, "a"), (3, "b")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, F.lit(True), "doc_id", "text", 1500, 3000)
    assert sorted(r.toxic for r in rows.collect()) == [0, 0, 1]


def test_language_rows_that_share_an_id_are_cut_in_spark(make, spark, monkeypatch):
    sent = []
    monkeypatch.setattr(language_id, "fit", lambda x, langs: sent.append(len(langs)))
    frame = type(spark.range(0))
    collected = []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    docs = make([(None, f"some text {k % 40}", "en", "s") for k in range(400)])
    language_id.train(docs, F.lit(True), "doc_id", "text", "lang", per_language=10)
    assert 1 < max(map(len, collected)) <= 10 and max(sent) <= 10 * (1 + len(language_id.SNIPPETS))

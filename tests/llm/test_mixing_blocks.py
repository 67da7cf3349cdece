from pyspark.sql import functions as F

from reachset.llm import mixing


def test_blocks_of_equal_rows_are_bounded(make, monkeypatch):
    rows = [(None, "same words here", "en", f"s{k % 2}") for k in range(1200)]
    rows += [(k, "w " * (1 + k % 7), "en", f"s{k % 2}") for k in range(200)]
    docs = make(rows).repartition(3)
    numbered = mixing._with_copy(
        docs.select("source", F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"),
                    F.monotonically_increasing_id().alias("no"))
    )
    got = numbered.where("id is null").groupBy("source").agg(
        F.countDistinct("copy").alias("n"), F.max("copy").alias("most")
    ).collect()
    assert [(r.n, r.most) for r in got] == [(600, 599)] * 2
    mine = sorted(map(repr, mixing.mix_documents(docs, block=64).collect()))
    assert mine == sorted(map(repr, mixing.mix_documents(docs.repartition(5), block=64).collect()))

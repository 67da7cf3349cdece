from collections import Counter

import pytest

from reachset.llm.jaccard_join import keep_one
from reachset.llm.mixing import mix_documents, mixed_rows


@pytest.fixture
def splits(spark):
    """Sets how many bytes of files one task reads, as a change of the cluster would."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
             "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in names}

    def put(size):
        for k, v in zip(names, (size, "0", "1")):
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(make, tmp_path, rows):
    path = str(tmp_path / "docs")
    make(rows).repartition(6).write.parquet(path)
    return path


def test_one_of_each_group_stays_on_other_splits(spark, make, tmp_path, splits):
    rows = [(i, f"text {i % 20} " + " ".join(f"w{i % 20}x{k}" for k in range(30))) for i in range(60)]
    path = written(make, tmp_path, rows)
    splits("1g")
    kept = keep_one(spark.read.parquet(path))
    splits("1k")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_the_mix_repeats_its_documents_on_other_splits(spark, make, tmp_path, splits):
    rows = [(i, "w " * (1 + i % 17), "en", f"s{i % 3}") for i in range(120)]
    path = written(make, tmp_path, rows)
    splits("1g")
    docs = spark.read.parquet(path)
    copies = {r.doc_id: r.copies for r in mix_documents(docs).collect() if r.copies}
    mixed = mixed_rows(docs)
    splits("1k")
    got = Counter(r.doc_id for r in mixed.collect())
    assert got.keys() <= set(range(120)) and sum(got.values()) == sum(copies.values())
    assert got == copies

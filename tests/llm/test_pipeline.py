import corpus_pipeline
import pytest

from reachset.llm.mixing import mix_documents

from .test_exact_dedup import digest
from .test_jaccard_join import brute
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept, written and reread as the driver does."""
    out = [("documents", spark.read.parquet(f"{SF}/documents.parquet"))]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1][1], SF).write.parquet(path)
        out.append((name, spark.read.parquet(path)))
    return dict(out)


def test_stages_return_the_columns_of_documents(stages):
    assert list(stages) == ["documents", "toxicity", "exact_dedup", "ngram_jaccard", "mixing", "best_fit_packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS


def test_toxic_documents_go_and_others_stay(spark):
    # sf0.001 has six toxic rows to learn from; this takes the next size
    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "toxic")
    kept = corpus_pipeline.toxicity(spark, docs, larger)
    assert kept.columns == COLUMNS
    total = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    left = {r.toxic: r["count"] for r in kept.join(labels, "doc_id").groupBy("toxic").count().collect()}
    assert left[0] > 0.95 * total[0] and left[1] < 0.5 * total[1]


def test_one_row_of_equal_texts_stays(stages):
    first = {}
    for r in sorted(stages["toxicity"].collect(), key=lambda r: r.doc_id):
        first.setdefault(digest(r.text), r.doc_id)
    assert sorted(r.doc_id for r in stages["exact_dedup"].collect()) == sorted(first.values())


def test_one_document_of_each_near_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages["exact_dedup"].collect()]
    want = {eval(x)[2] for x in brute(rows, 5, 80)}
    assert sorted(r.doc_id for r in stages["ngram_jaccard"].collect()) == sorted(want)


def test_the_mix_repeats_and_drops_rows(stages):
    copies = {r.doc_id: r.copies for r in mix_documents(stages["ngram_jaccard"]).collect()}
    got = {r.doc_id: r["count"] for r in stages["mixing"].groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in copies.items() if n}


def test_the_mix_is_packed(stages):
    rows = [(r.doc_id, r.text) for r in stages["mixing"].collect()]
    mine, best = check_packing(rows, stages["best_fit_packing"].collect(), 4096)
    assert mine <= best + 1


def test_run_applies_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.piece, r.ids_crc32) for r in df.collect())
    assert key(got) == key(stages["best_fit_packing"])


def test_no_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0

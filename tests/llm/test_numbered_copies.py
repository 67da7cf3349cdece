import pytest

from reachset.llm import exact_dedup, jaccard_join, mixing

from .test_jaccard_join import near_copies


@pytest.mark.parametrize(
    "module, call",
    [(exact_dedup, "drop_copies"), (jaccard_join, "keep_one"), (mixing, "mixed_rows")],
)
def test_copies_of_whole_texts_are_compressed_well(make, monkeypatch, module, call):
    written, materialize = {}, module.materialize

    def kept(df, name, *codec):
        written[name] = materialize(df, name, *codec)
        return written[name]

    monkeypatch.setattr(module, "materialize", kept)
    out = getattr(module, call)(make(near_copies(3, groups=2)))
    assert out.count() and written["numbered"].inputFiles()
    assert all(f.endswith(".zstd.parquet") for f in written["numbered"].inputFiles())

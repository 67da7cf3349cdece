import pytest

# columns that the operators use inside, here as extra columns of the input
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, digest string, row int, size int, kept int, bucket string, h int"
)

LONG = " ".join(f"w{i % 977}" for i in range(20_000))
ROWS = [
    (5, "the cat  sat on the mat and saw another cat there", "en", "a"),
    (3, "the cat sat on\tthe mat and saw another cat there", "en", "a"),
    (3, "the cat sat on the mat and saw another cat there", "en", None),
    (9, None, None, "b"),
    (4, "", "en", "b"),
    (7, " \n ", "fr", ""),
    (11, LONG, "en", "b"),
    (12, "Ärger über Öl – 123 😀 … ça va", "de", "c"),
    (None, "a row without an id", "en", "c"),
    (14, "12345 67890 !!!", None, None),
    (5, "the cat  sat on the mat and saw another cat there", "en", "a"),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), 1, "x", 2, 3, 4, "y", 5) for r in rows], SCHEMA
    )


@pytest.fixture(scope="session")
def edge_docs(spark):
    return frame(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, [(*r, "en", "s")[:4] if len(r) < 4 else r for r in rows])

import random
from collections import defaultdict

from pyspark.sql import functions as F

from reachset.llm.line_dedup import dedup_lines, drop_repeated_lines, line_keys

from .conftest import ROWS

BLANKS = " \t\n\v\f\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars=10, min_docs=2):
    def lines(text):
        return [(x, x.strip(BLANKS).translate(UPPER)) for x in (text or "").split("\n")]

    holders = defaultdict(list)
    for i, t in rows:
        for key in {k for _, k in lines(t) if len(k) >= min_chars}:
            holders[key].append(i)
    out = []
    for i, t in rows:
        stay = []
        for line, key in lines(t):
            ids = holders.get(key, [])
            named = [x for x in ids if x is not None]
            if len(ids) < min_docs or not named or i == min(named):
                stay.append(line)
        out.append((i, len(lines(t)), len(lines(t)) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


HARD = [
    (4, "A common line here\nown line of four\n\n  a COMMON line here\t"),
    (2, "a common line here\nshort\nown line of two\r\n"),
    (9, "short\nA common line here"),
    (None, "a common line here\nonly null ids hold this one"),
    (None, "only null ids hold this one\nÄRGER über Öl"),
    (7, "ÄRGER über Öl\närger über öl\nÄrger ÜBER Öl"),
    (8, "\n\n\n"),
    (8, "\n\n\n"),
    (9, "short\nA common line here"),
    (11, "123456789\n 1234567890\nÉÉÉÉÉÉÉÉÉÉ"),
    (12, "123456789\n1234567890 \nÉÉÉÉÉÉÉÉÉÉ\n" + "long " * 20_000),
    (13, None),
]


def test_hard_rows(make):
    assert got(dedup_lines(make(HARD).repartition(3))) == brute(HARD)
    assert got(dedup_lines(make(HARD), min_docs=3, min_chars=5)) == brute(HARD, 5, 3)


def test_edge_rows(edge_docs):
    assert got(dedup_lines(edge_docs)) == brute([r[:2] for r in ROWS])


def test_random_texts(make):
    rng = random.Random(3)
    pool = [" ".join(rng.choices(["Alpha", "beta", "gamma", "Über"], k=3)) for _ in range(40)]
    rows = [(rng.randrange(60), "\n".join(rng.choices(pool, k=rng.randrange(1, 8)))) for _ in range(80)]
    assert got(dedup_lines(make(rows).repartition(5))) == brute(rows)


def test_frequent_line_and_repeated_row(make, spark):
    rows = [(i, f"a line that all documents hold\nown line number {i}") for i in range(1500)]
    rows += [(5000, "the same row again and again\nwith two lines of text")] * 700
    docs = make(rows).repartition(8)
    assert got(dedup_lines(docs)) == brute(rows)
    keys = line_keys(docs, "doc_id", "text", 10)
    # one row per row and distinct key, with nothing of the text
    assert keys.columns == ["doc", "id", "h", "places"] and keys.count() == 1500 * 2 + 700 * 2


def test_other_columns_stay(edge_docs, make):
    docs = make(HARD).withColumn("lost", F.lit("x")).withColumn("whole", F.lit(1))
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    texts = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr)
    assert texts == sorted(((i, x) for i, _, _, x in brute(HARD)), key=repr)
    assert sum(r.text is None for r in kept.collect()) == 1
    assert {r.lost for r in kept.collect()} == {"x"}


def test_no_rows(no_docs):
    assert dedup_lines(no_docs).count() == 0
    assert drop_repeated_lines(no_docs).count() == 0

"""Ranked lexical search, term at a time with limited accumulators.

A block of items gives a set of query terms, which goes to the tasks.  One
pass over the documents writes, in the documents' own partitions, each
document's length and the query terms it holds with their counts: an index of
what the items ask for, with no shuffle.  The corpus counts (documents, terms,
documents holding a term) are aggregated from it over all documents.

A second pass reads the index in shards of at most ``shard_rows`` documents and
answers every item in each shard term at a time, rarest term first:

* a document gets an accumulator when a term first meets it;
* before each term, what an unseen document could still reach is at most the
  sum of the remaining terms' weights times their largest share in the shard;
  once that is below the k-th best score known (from the shard's partial
  scores or from the shards before), no accumulator is made any more;
* the remaining terms still update the accumulators that exist, exactly.

A document without an accumulator scores less than k others, so the k best
are exact, ties included.  Each task hands on k rows an item; these are
merged in two levels, so no group grows with the number of tasks.

Scores: with N documents with at least one term, L terms in all, n terms in
the document, df documents holding the term and tf its count there,
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, ``m = 75 + 25 n N div L`` and the
score is the sum of ``w * (10^9 tf div (1000 tf + 12 m))``, repeats included.

Defined results: a null text has no terms, such a document is not counted and
never ranked; an item without terms, or whose terms no document holds, has no
rows; every row of the item table is an item of its own, also if its id is
null or repeated; documents that score alike are ranked by id, a null id last,
rows with the same id in any order; an empty table on either side gives no
rows; other columns are ignored.  Items are taken in blocks of about
``block_bytes`` of text (one item at least), so what goes to the driver and
to a task does not grow with the number of items.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialize, whole_text

#: A-Z lower-cased; every other ASCII byte that is no digit or letter separates.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
#: Documents, and postings, of a shard at most.
SHARD_ROWS = 1 << 16
SHARD_POSTINGS = 1 << 22
BLOCK_BYTES = 4 << 20
#: Groups of tasks in the first level of the merge.
_MERGES = 256


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_TERMS).split()


def index_terms(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text: str) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: its length, and the asked terms in it."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]
    )

    def held(batches):
        number = numbers.get
        for batch in batches:
            rows = []
            for doc, whole in zip(batch.column("id"), batch.column("text")):
                words = terms(whole.as_py())
                if words:
                    tf = Counter(map(number, words))
                    tf.pop(None, None)
                    rows.append((doc.as_py(), len(words), list(tf), list(tf.values())))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.encode(whole_text(text), "UTF-8").alias("text")
    )
    return rows.mapInArrow(held, "id long, n long, terms array<int>, tfs array<long>")


class Shard:
    """Postings by term of a run of documents."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 n_terms: int, n_docs: int, total: int):
        m = 75 + 25 * n * n_docs // total
        doc = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(terms, kind="stable")
        self.doc, tf = doc[order], tfs[order]
        self.share = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc])
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.size = len(n)

    def top(self, item: list[tuple[int, int]], k: int, known: int) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, scores)`` of all that may be among the item's k best.

        ``item``: its terms with weights, heaviest first; ``known``: a score
        that k other documents reach, 0 if there is none.
        """
        lists = [(w, *self.bounds[t : t + 2]) for t, w in item]
        most = [w * int(self.share[a:b].max()) if b > a else 0 for w, a, b in lists]
        left = np.cumsum([0, *most[::-1]])[::-1]  # what the terms from here on can add
        scores = np.zeros(self.size, dtype=np.int64)
        making = True
        for (w, a, b), rest, after in zip(lists, left, left[1:]):
            making = making and rest >= known
            docs, add = self.doc[a:b], w * self.share[a:b]
            if making:
                scores[docs] += add
                known = self._kth(scores, k, known, after)
            else:
                has = scores[docs] > 0
                scores[docs[has]] += add[has]
        found = np.flatnonzero(scores >= max(known, 1))
        return found, scores[found]

    @staticmethod
    def _kth(scores: np.ndarray, k: int, known: int, after: int) -> int:
        """The k-th best partial score, looked up only if it may end the making."""
        if len(scores) < k or scores.max() <= max(after, known):
            return known
        return max(known, int(np.partition(scores, -k)[-k]))


def _best(rows: list[tuple], k: int) -> list[tuple]:
    """The k best of ``(score, null id, id)`` rows."""
    return sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:k]


def search_index(
    index: DataFrame, items: list[list[tuple[int, int]]], n_terms: int, n_docs: int, total: int,
    k: int, shard_rows: int = SHARD_ROWS, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """``item, part, id, score``: the k best of each task for each item."""

    def shards(batches):
        """Batches cut and joined to shards within the bounds."""
        held, postings = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                size = len(piece.column("terms").flatten())
                if held and (postings + size > shard_postings or 1024 * (len(held) + 1) > shard_rows):
                    yield pa.Table.from_batches(held)
                    held, postings = [], 0
                held.append(piece)
                postings += size
        if held:
            yield pa.Table.from_batches(held)

    def search(batches):
        best: list[list[tuple]] = [[] for _ in items]
        for table in shards(batches):
            table = table.combine_chunks()
            column = {c: table.column(c).combine_chunks() for c in table.column_names}
            shard = Shard(
                column["n"].to_numpy(), np.diff(column["terms"].offsets.to_numpy()),
                column["terms"].flatten().to_numpy(), column["tfs"].flatten().to_numpy(),
                n_terms, n_docs, total,
            )
            null = np.asarray(column["id"].is_null())
            ids = column["id"].fill_null(0).to_numpy()
            for i, item in enumerate(items):
                known = best[i][-1][0] if len(best[i]) == k else 0
                docs, scores = shard.top(item, k, known)
                if len(docs) > k:  # all that reach the k-th score, then the first ids
                    docs_of = scores >= np.partition(scores, -k)[-k]
                    docs, scores = docs[docs_of], scores[docs_of]
                best[i] = _best(
                    best[i] + list(zip(scores.tolist(), null[docs].tolist(), ids[docs].tolist())), k
                )
        rows = [(i, None if r[1] else r[2], r[0]) for i, found in enumerate(best) for r in found]
        columns = zip(*rows) if rows else [[]] * 3
        types = [("item", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(columns, types)], schema=pa.schema(types)
        )

    found = index.mapInArrow(search, "item int, id long, score long")
    return found.withColumn("part", F.spark_partition_id() % _MERGES)


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _weights(items: list[list[bytes]], numbers: dict[bytes, int], df: dict[int, int], n: int):
    """Each item's ``(term, weight times repeats)``, heaviest first; terms that no document holds go."""
    out = []
    for words in items:
        found = [
            (numbers[t], math.floor(1000 * math.log((2 * n + 2) / (2 * df[numbers[t]] + 1))) * c)
            for t, c in Counter(words).items()
            if numbers[t] in df
        ]
        out.append(sorted(found, key=lambda x: -x[1]))
    return out


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    k: int = 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item, rank, id, score`` of the k best documents of every item."""
    spark = docs.sparkSession
    asked = materialize(
        items.select(
            F.col(item_col).alias("item_id"),
            F.encode(whole_text(item_text), "UTF-8").alias("text"),
            F.monotonically_increasing_id().alias("no"),
        ),
        "items",
    )
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b)
        rows = block.select("no", "text").collect()  # about block_bytes
        words = [terms(bytes(r.text)) for r in rows]
        numbers = {t: i for i, t in enumerate(dict.fromkeys(t for x in words for t in x))}
        if not numbers:
            continue
        index = materialize(index_terms(docs, numbers, id_col, text), "asked-terms")
        n, total = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            continue
        held = index.select(F.explode("terms").alias("t")).groupBy("t").count()
        df = {r["t"]: r["count"] for r in held.collect()}  # the block's terms at most
        best = search_index(index, _weights(words, numbers, df, n), len(numbers), n, total, k)
        nos = spark.createDataFrame([(i, r.no) for i, r in enumerate(rows)], "item int, no long")
        ranked = _ranked(_ranked(best, ["item", "part"], k).drop("rank"), ["item"], k)
        named = nos.join(block.select("no", "item_id"), "no")  # the block's items
        found.append(ranked.join(named, "item").select("item_id", "rank", "id", "score"))
    if not found:
        kind = items.schema[item_col].dataType.simpleString()
        return spark.createDataFrame([], f"{item_col} {kind}, rank int, {id_col} long, score long")
    return reduce(DataFrame.unionByName, found).toDF(item_col, "rank", id_col, "score")


def op12_lexical_search(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return rank_documents(documents(spark, sf_dir), items)


_TERM_LIST = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP12_SQL = f"""
with held as (
  select doc_id, unnest({_TERM_LIST}) as term from documents
), tf as (
  select doc_id, term, count(*) as tf from held group by doc_id, term
), lengths as (
  select doc_id, sum(tf)::bigint as n from tf group by doc_id
), corpus as (
  select count(*) as nd, sum(n)::bigint as l from lengths
), df as (
  select term, count(*) as df from tf group by term
), asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest({_TERM_LIST}) as term from benchmark) group by item_id, term
), weighted as (
  select item_id, term,
         times * floor(1000 * ln((2 * nd + 2)::double / (2 * df + 1)))::bigint as w
  from asked join df using (term) cross join corpus
), scored as (
  select w.item_id, t.doc_id,
         sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * n.n * c.nd) // c.l))))::bigint as score
  from weighted w join tf t using (term) join lengths n using (doc_id) cross join corpus c
  group by w.item_id, t.doc_id
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
         doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

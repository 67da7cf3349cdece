"""Line dedup: lines that many documents share stay in the first of them only.

Every text is split at ``\\n``; a line's key is the line stripped of blanks at
both ends with A-Z lower-cased.  One Arrow pass explodes the texts into one
row per document and distinct key: the key's 128-bit hash and the places of
its lines, never the text.  A map-side-combined count finds the hashes held
by ``min_docs`` documents or more and the smallest id holding each; the rows
of these hashes in other documents are lost lines.  Their places are gathered
per document, and the text is put together again from the places that stay.

No step holds more than a task's share of a frequent line: its rows are
counted on the map side, and both inputs of the join that finds them again
are written tables, so the optimizer splits a hash held by many documents.
Texts are shuffled once, to meet the places they lose.

Defined results: a null text is empty; a text without ``\\n`` is one line, an
empty one too; keys shorter than ``min_chars`` code points always stay; a row
is a document, and rows that share the smallest id all keep the line; a null
id comes after every id, and if all holders have a null id they all keep it;
all lines of a key go or stay together in a document; a document that loses
all its lines becomes empty; an empty table gives no rows; extra columns stay
as they are in :func:`drop_repeated_lines`, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize, whole_text

_BLANKS = b" \t\n\v\f\r"
#: Rows of a batch that a task hands back at once.
_ROWS = 1 << 16
_KEYS = pa.schema(
    [("doc", pa.binary()), ("id", pa.int64()), ("h", pa.binary()), ("places", pa.list_(pa.int32()))]
)


def _doc_key(id_col: str, text: str) -> Column:
    """A row's id and text, as 128 bits; rows alike in both lose the same lines."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.unhex(F.md5(F.encode(F.concat(name, F.lit(":"), whole_text(text)), "UTF-8")))


def places_of_keys(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """The places of the lines of each key that is long enough, by the key's hash."""
    found: dict[bytes, list[int]] = {}
    for place, line in enumerate(text.lower().split(b"\n")):  # bytes: A-Z only
        key = line.strip(_BLANKS)
        # a code point takes four bytes at most
        if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars:
            found.setdefault(xxhash.xxh3_128_digest(key), []).append(place)
    return found


def line_keys(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """``doc, id, h, places``: one row per row of ``docs`` and distinct key."""

    def keys(batches):
        for batch in batches:
            doc, ids, hashes, places, offsets = [], [], [], [], [0]
            for i in range(batch.num_rows):
                found = places_of_keys(batch.column("text")[i].as_py(), min_chars)
                doc += [batch.column("doc")[i].as_py()] * len(found)
                ids += [batch.column("id")[i].as_py()] * len(found)
                hashes += found
                for at in found.values():
                    places += at
                    offsets.append(len(places))
                if len(hashes) >= _ROWS or i == batch.num_rows - 1:
                    lists = pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(places, pa.int32())
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, pa.binary()), pa.array(ids, pa.int64()),
                         pa.array(hashes, pa.binary()), lists],
                        schema=_KEYS,
                    )
                    doc, ids, hashes, places, offsets = [], [], [], [], [0]

    rows = docs.select(
        _doc_key(id_col, text).alias("doc"),
        F.col(id_col).cast("long").alias("id"),
        F.encode(whole_text(text), "UTF-8").alias("text"),
    )
    return rows.mapInArrow(keys, "doc binary, id long, h binary, places array<int>")


def lost_places(docs: DataFrame, id_col: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """``doc, lost``: the places of the lines that a document loses, if any."""
    lines = materialize(line_keys(docs, id_col, text, min_chars), "lines")
    repeated = materialize(
        lines.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .where((F.col("n") >= min_docs) & F.col("first_id").isNotNull())
        .select("h", "first_id"),
        "repeated-lines",
    )
    lost = lines.join(repeated, "h").where(F.col("id").isNull() | (F.col("id") > F.col("first_id")))
    # rows alike in id and text bring the same places; a set of them is one document's
    return lost.groupBy("doc").agg(F.flatten(F.collect_set("places")).alias("lost"))


def _without(text: str, lost: str) -> Column:
    """The text's lines but those in the places ``lost``."""

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
        return F.concat_ws("\n", F.transform(stay, lambda i: F.get(lines, i)))

    # the split is bound to a variable, or it would be made again for each line
    split = F.array(F.split(F.col(text), "\n"))
    return F.when(F.col(lost).isNull(), F.col(text)).otherwise(F.get(F.transform(split, rest), F.lit(0)))


def _deduped(
    docs: DataFrame, id_col: str, text: str, min_chars: int, min_docs: int, keep: list[Column]
) -> DataFrame:
    lost = materialize(lost_places(docs, id_col, text, min_chars, min_docs), "lost-lines")
    rows = docs.select(
        _doc_key(id_col, text).alias("doc"), whole_text(text).alias("whole"), *keep
    )
    return rows.join(lost, "doc", "left").withColumn("kept", _without("whole", "lost"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """``id, n_lines, n_dropped, text`` of every document, the text without its repeated lines."""
    rows = _deduped(docs, id_col, text, min_chars, min_docs, [F.col(id_col).alias("name")])
    return rows.select(
        F.col("name").alias(id_col),
        F.size(F.split("whole", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.col("kept").alias(text),
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """``docs`` with all its columns; a text that loses lines is replaced by what stays."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = _deduped(docs, id_col, text, min_chars, min_docs, [row])
    changed = F.when(F.col("lost").isNull(), F.col(f"row.`{text}`")).otherwise(F.col("kept"))
    return rows.select(
        *[changed.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    )


def op11_line_dedup(spark, sf_dir):
    kept = dedup_lines(documents(spark, sf_dir))
    sha = F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", sha)


OP11_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents
), keyed as (
  select doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), repeated as (
  select key, min(doc_id) as first_id from keyed
  where length(key) >= 10 group by key having count(distinct doc_id) >= 2
), marked as (
  select k.doc_id, k.place, k.line, coalesce(k.doc_id > r.first_id, false) as lost
  from keyed k left join repeated r using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not lost), '')) as kept_sha256
from marked group by doc_id
"""

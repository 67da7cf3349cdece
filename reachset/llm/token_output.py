"""Token ids as Simple-8b words, written and read back through Spark.

Documents are range-partitioned by id and sorted, so file order is id order.
Each task encodes its documents and emits *runs*: consecutive whole documents
of about ``run_ids`` ids together.  A run is one row of the Parquet output::

    part, run          which task wrote it, and its number there
    first              ids of the part before this run
    doc_ids, lengths   the documents of the run and their ids, the end id counted
    words              little-endian uint64 Simple-8b words
    blocks             little-endian uint32, the first word of each 256-id block
    escapes            little-endian uint64, ids over 60 bits

A long document is a run of its own and is never cut.  Spark's committer
makes the write whole or absent, so a lost executor only repeats its task.

Defined results: a null text is empty and gives the end id alone; null ids
come first; repeated ids are ordered by a hash of the text, copies of a row by
their place in the input, so that they are spread over tasks; an empty table
gives no runs; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import simple8b
from .common import documents
from .tokens import default_tokenizer, encoder, slices

RUN = (
    "part int, run int, first long, doc_ids array<long>, lengths array<long>, "
    "words binary, blocks binary, escapes binary"
)


def encode_runs(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text: str, run_ids: int
) -> DataFrame:
    def encode(batches):
        part, run, first = TaskContext.get().partitionId(), 0, 0
        encode_texts = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            ids = [x + end for x in encode_texts(batch["text"])]
            lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            number = (np.cumsum(lengths) - 1) // run_ids
            names = [None if null else int(i) for i, null in zip(batch["id"], batch["no_id"])]
            rows = []
            for at in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(number)) + 1):
                flat = np.frombuffer(b"".join(ids[at[0] : at[-1] + 1]), dtype="<u4")
                words, blocks, escapes = simple8b.encode(flat)
                rows.append(
                    (part, run, first, names[at[0] : at[-1] + 1], lengths[at],
                     words.astype("<u8").tobytes(), blocks.astype("<u4").tobytes(),
                     escapes.astype("<u8").tobytes())
                )
                run, first = run + 1, first + len(flat)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RUN.split(", ")])

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(text).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the row's place in the input is last, so that copies of a row can be parted
    order = [F.col("no_id").desc(), F.col("id"), F.xxhash64("text"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInPandas(encode, RUN)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text: str = "text",
    run_ids: int = 1 << 16,
) -> None:
    """Write the ids of ``docs`` to ``path`` (must not exist)."""
    runs = encode_runs(docs, tokenizer or default_tokenizer(), end_id, id_col, text, run_ids)
    # the words are dense already
    runs.write.option("compression", "none").parquet(path)


def read_tokens(
    spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` (and ``ids``) of each document of the files."""
    schema = "id long, no_id boolean, start long, n_tokens long, ids_crc32 long" + (
        ", ids array<long>" if with_ids else ""
    )

    def decode(batches):
        for batch in batches:
            for run in batch.itertuples(index=False):
                lengths = np.asarray(run.lengths, dtype=np.int64)
                total = int(lengths.sum())
                ids = simple8b.decode(
                    np.frombuffer(run.words, "<u8"), np.frombuffer(run.blocks, "<u4"),
                    np.frombuffer(run.escapes, "<u8"), total,
                )
                stops = np.cumsum(lengths)
                small = ids.astype("<u4")
                names = pd.Series(list(run.doc_ids), dtype="Int64")
                out = pd.DataFrame(
                    {
                        "id": names.fillna(0),
                        "no_id": names.isna(),
                        "start": run.first + run.ids_before + stops - lengths,
                        "n_tokens": lengths,
                        "ids_crc32": [
                            zlib.crc32(small[b - n : b].tobytes()) for b, n in zip(stops, lengths)
                        ],
                    }
                )
                if with_ids:
                    out["ids"] = [ids[b - n : b].astype(np.int64) for b, n in zip(stops, lengths)]
                yield out

    runs = spark.read.schema(RUN).parquet(path)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # one row for each task of the write, which bounds the broadcast
        runs.select("part", total.alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ids_before"))
    )
    read = runs.join(F.broadcast(parts), "part").drop("part", "run").mapInPandas(decode, schema)
    doc = F.when(~F.col("no_id"), F.col("id")).alias(id_col)
    return read.select(doc, *[c for c in read.columns if c not in ("id", "no_id")])


def op1_simple8b_tokens(spark, sf_dir):
    path = shared_dir(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path, with_ids=False)

"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: The blanks of every text contract: space, tab, newline, VT, FF, CR.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Later passes read the files, so a lost executor costs a re-read and
    not a recomputation of everything upstream.  ``codec``: the compression of
    the files, the session's if not given; copies of whole texts take ``zstd``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def in_fold(doc_id: str, modulus: int, remainder: int) -> Column:
    """``crc32(doc_id as text) mod modulus = remainder``; a null id is in no fold."""
    crc = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))

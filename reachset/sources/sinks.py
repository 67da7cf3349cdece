"""Campaign outputs.

Both sinks write from the executors in parallel (one file per partition);
nothing is gathered on the driver.  JSON is one object per recipient with
every field present (nulls written as ``null``) so that an e-mail template
sees the same keys on every record.  The CSV keeps the e-mail column; the
JSON drops it (the reference's choice between the two outputs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PII_COLUMNS = ("emailAddress",)


def write_campaign_json(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    drop_pii: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """One JSON object per recipient, every field present; e-mail dropped.

    ``max_records_per_file`` caps file size for downstream senders that
    read files whole; the write stays parallel either way.
    """
    out = df.drop(*[c for c in PII_COLUMNS if c in df.columns]) if drop_pii else df
    writer = out.write.mode(mode).option("ignoreNullFields", "false")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(int(max_records_per_file)))
    writer.json(path)


#: Quotes are doubled, as common CSV readers expect; blanks and '' are data.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_campaign_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    max_records_per_file: int | None = None,
) -> None:
    """CSV with a header; every value reads back as it was.

    '' is written as ``""`` and null as nothing; outer blanks, quotes and
    line breaks are kept (quoted).  A field may span lines, so a reader
    cannot split a file: ``max_records_per_file`` keeps files small.
    """
    writer = df.write.mode(mode).options(**_CSV)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(int(max_records_per_file)))
    writer.csv(path)


def read_campaign_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_campaign_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    # "" reads back as '', nothing as null: the reader takes a value equal to
    # nullValue for null, so that must be one no field holds
    options = _CSV | {"multiLine": "true", "emptyValue": "", "nullValue": "\x00"}
    return spark.read.schema(schema).options(**options).csv(path)

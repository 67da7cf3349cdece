"""Audiences over event streams.

The reference builds audiences in batch only.  The same operators apply
to a streaming DataFrame: filters and windows are stateless, and the one
stateful step -- "distinct keys" (A1) -- becomes de-duplication within a
watermark, whose state lives in the query's checkpoint (a shared folder),
so a restarted or relocated task resumes from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType


def read_event_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A Parquet directory as an event stream (new files become new rows)."""
    reader = spark.readStream.format("parquet").schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def stream_audience(
    events: DataFrame,
    key: str,
    ts: str = "ts",
    watermark: str = "1 day",
    source: str | None = None,
) -> DataFrame:
    """Keys as they first appear in the stream (A1 for streams).

    Each key is emitted once per watermark horizon -- again if it comes back
    after that, so unlike the batch grouping a key may repeat over a long
    stream; the de-duplication state is bounded by the watermark.
    """
    col = F.col(source or key)
    event_time = F.col(ts)
    if isinstance(events.schema[ts].dataType, TimestampNTZType):
        # watermarks need TIMESTAMP; wall-clock time read in the session zone
        event_time = event_time.cast("timestamp")
    keyed = events.where(col.isNotNull()).select(col.alias(key), event_time.alias(ts))
    return keyed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def write_audience_stream(
    df: DataFrame,
    sink: Callable[..., None],
    out_path: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Append each micro-batch with a batch sink (e.g. ``write_campaign_json``).

    ``sink(batch_df, path, mode="overwrite")`` is called per micro-batch with
    a sub-folder of ``out_path`` named by the batch id, so a replayed batch
    overwrites its own output.  ``checkpoint`` is a shared folder of this
    stream's own: the same one on each start, or a restart resumes nothing.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(batch, f"{out_path.rstrip('/')}/batch={batch_id}", mode="overwrite")

    writer = df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()

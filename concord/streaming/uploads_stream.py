"""Uploads deduplicated across micro-batches.

State is keyed by (version, content hash): the first upload of a content makes an object,
every later one, in whatever file or after whatever restart, only counts as an upload. The
state of a key is one number, and it is dropped when the key has been silent for
``keep_days``: an upload of the same content after that makes the same object again, under
the same name and key. Time is the time of arrival, that of the micro-batch, which a batch
that is run again keeps; so no upload is ever late.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from concord.operators import uploads as U
from concord.streaming.rounds_stream import UPLOAD_SCHEMA, overwrite

KEEP_DAYS = 30
DAY_MS = 86_400_000
COUNTED = ("version int, content_hash string, object_name string, size long, "
           "sample_size long, n_uploads long, is_new boolean")


def counted(keep_days: int):
    """Per key: the object of its first upload, and its uploads so far."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
            ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = state.get[0] if state.exists else 0
        n, last = before, None
        for rows in frames:
            n += len(rows)
            row = rows.sort_values("doc_id").iloc[-1]
            last = row if last is None or row["doc_id"] > last["doc_id"] else last
        state.update((n,))
        state.setTimeoutTimestamp(int(last["arrived"].timestamp() * 1000) + keep_days * DAY_MS)
        yield pd.DataFrame({
            "version": [key[0]], "content_hash": [key[1]], "object_name": [last["object_name"]],
            "size": [last["size"]], "sample_size": [last["sample_size"]], "n_uploads": [n],
            "is_new": [before == 0]})
    return run


def deduplicated(records: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """A row for each key that a micro-batch brings: sample size of its last upload there,
    all uploads so far, and whether it is a new object."""
    rows = U.accepted(records).select(
        "doc_id", "version", "content_hash", "object_name", "size", "sample_size",
        F.current_timestamp().alias("arrived")).withWatermark("arrived", f"{keep_days} days")
    return rows.groupBy("version", "content_hash").applyInPandasWithState(
        counted(keep_days), COUNTED, "n long", "update", GroupStateTimeout.EventTimeTimeout)


def run_deduplicated(spark: SparkSession, bodies_path: str, out_path: str, checkpoint: str,
                     files_per_trigger: int = 1, keep_days: int = KEEP_DAYS) -> None:
    """Drive the stream over every available file: changes go to ``out_path`` by batch."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        overwrite(batch.withColumn("batch_id", F.lit(batch_id)), out_path, "batch_id")

    bodies = (spark.readStream.schema(UPLOAD_SCHEMA)
              .option("maxFilesPerTrigger", files_per_trigger).json(bodies_path))
    query = (deduplicated(bodies, keep_days).writeStream.outputMode("update").foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def objects(changes: DataFrame) -> DataFrame:
    """The objects of a folder of changes: one row a key, its uploads and last sample size."""
    return changes.groupBy("version", "content_hash").agg(
        F.any_value("object_name").alias("object_name"), F.any_value("size").alias("size"),
        F.max_by("sample_size", "batch_id").alias("sample_size"),
        F.max("n_uploads").alias("n_uploads"))

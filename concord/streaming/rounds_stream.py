"""Structured Streaming form of the round controller.

Requests arrive as files of round events, uploads as files of JSON bodies. Each
micro-batch runs the batch operators: admission is a projection, the pending
counter and the round number are two-level running sums, so a federation that
holds a third of all events is spread over many tasks. What passes from one
micro-batch to the next is one row per federation (counter, version and counts of
its open round), written beside the checkpoint under the batch's number.

Every sink is idempotent: closed rounds overwrite their own (federation, version),
rejects and uploads their own batch. A replayed batch, or a rerun from a new
checkpoint, writes the same rows again. Micro-batches run one after another, so
what one batch closes is published before the next one admits anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators import rounds as RD
from concord.operators import uploads as U
from concord.sources import fixtures

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

UPLOAD_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("body", T.StringType()),
])

STATE = "federation_id int, balance long, version int, n_fetches long, n_uploads long"


def admitted(events: DataFrame) -> DataFrame:
    """Event typing, request log and admission decision of raw events."""
    return RD.admission(fixtures.request_log(RD.round_events(events)))


def advance(decided: DataFrame, start: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed rounds, state after) of one batch of decided requests and the state before.

    A close has federation_id, version, event_id and the counts of its round, of
    which earlier batches may hold a part.
    """
    b = RD.barrier(decided, start=start)
    accepted = F.col("status") == "accepted"
    rows = b.select(
        "federation_id", "version", "delta", F.when(F.col("closes"), F.col("event_id")).alias("event_id"),
        ((F.col("op") == "fetch") & accepted).cast("bigint").alias("n_fetches"),
        ((F.col("op") == "upload") & accepted).cast("bigint").alias("n_uploads"))
    before = start.select("federation_id", "version", F.col("balance").alias("delta"),
                          F.lit(None).cast("bigint").alias("event_id"), "n_fetches", "n_uploads")
    rounds = rows.unionByName(before).groupBy("federation_id", "version").agg(
        F.max("event_id").alias("event_id"), F.sum("delta").alias("delta"),
        F.sum("n_fetches").alias("n_fetches"), F.sum("n_uploads").alias("n_uploads"))
    closed = rounds.filter("event_id IS NOT NULL").select(
        "federation_id", "event_id", "version", "n_fetches", "n_uploads")
    # the open round is the one after the last close, or the last one seen
    last = F.max_by(F.struct("event_id", "n_fetches", "n_uploads"), "version")
    after = rounds.groupBy("federation_id").agg(
        F.sum("delta").alias("balance"), F.max("version").alias("version"), last.alias("r"))
    done = F.col("r.event_id").isNotNull()
    count = lambda c: F.when(done, F.lit(0)).otherwise(F.col(f"r.{c}")).cast("bigint")
    state = after.select("federation_id", "balance",
                         (F.col("version") + done.cast("int")).alias("version"),
                         count("n_fetches").alias("n_fetches"),
                         count("n_uploads").alias("n_uploads"))
    return closed, state


def overwrite(rows: DataFrame, path: str, *keys: str) -> None:
    """Replace the partitions of ``path`` that the rows name."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def run_barrier(spark: SparkSession, events_path: str, out_path: str, checkpoint: str,
                files_per_trigger: int = 1) -> None:
    """Drive the stream over every available file, then stop.

    Writes ``out_path/closed`` by (federation, version) and ``out_path/rejected``
    by batch.
    """
    state_path = f"{checkpoint}/rounds"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        start = (session.read.schema(STATE).parquet(f"{state_path}/batch_id={batch_id - 1}")
                 if batch_id else session.createDataFrame([], STATE))
        decided = admitted(batch).persist()
        closed, state = advance(decided, start)
        state.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        overwrite(closed, f"{out_path}/closed", "federation_id", "version")
        overwrite(RD.rejects(decided).withColumn("batch_id", F.lit(batch_id)),
                  f"{out_path}/rejected", "batch_id")
        decided.unpersist()

    events = (spark.readStream.schema(EVENT_SCHEMA)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(events_path))
    query = (events.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def run_uploads(spark: SparkSession, bodies_path: str, out_path: str, checkpoint: str,
                files_per_trigger: int = 1) -> None:
    """JSON uploads; accepted ones go to ``out_path/accepted``, others to
    ``out_path/rejected``, each under its batch."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = U.ingest(batch).withColumn("batch_id", F.lit(batch_id)).persist()
        for status in ("accepted", "rejected"):
            overwrite(rows.filter(F.col("status") == status), f"{out_path}/{status}", "batch_id")
        rows.unpersist()

    bodies = (spark.readStream.schema(UPLOAD_SCHEMA)
              .option("maxFilesPerTrigger", files_per_trigger).json(bodies_path))
    query = (bodies.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()

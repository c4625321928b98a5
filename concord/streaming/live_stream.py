"""The live round as a stream (T01-T06, S07, S08): keyed state and publishing at a close.

Requests arrive as files in the order of their time. A stateful operator keyed by
federation holds the server's version, its counter and the end of a running merge and
evaluation, one small row a federation kept by the engine's state store; it judges each
request as it comes. What a micro-batch brings of one federation is sorted in one task
(``files_per_trigger`` bounds it).

Each micro-batch then feeds its sinks in a fixed order: requests, uploads, published
parameters, evaluations, history. Every sink overwrites its own keys: requests and uploads
those of the batch, the others those of the (federation, version) that the batch closes.
What a close publishes is computed from the stored uploads up to this batch and the
evaluation from the stored parameters, so a batch that fails between any two sinks and is
run again writes the same tables. A checkpoint belongs to one output folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from concord.operators import rounds as RD
from concord.plans import live_job as J
from concord.sources import fixtures
from concord.streaming.rounds_stream import EVENT_SCHEMA, overwrite

#: ``ready_at`` < 0: no merge or evaluation runs.
STATE = "version int, balance long, merged_at long, ready_at long"
JUDGED = ("federation_id int, event_id long, ts timestamp, client_id long, op string, "
          "sample_size long, claimed_version int, exists boolean, merge_us long, "
          "evaluate_us long, model_id long, server_version int, merging boolean, "
          "evaluating boolean, balance long")
UPLOADS = ("federation_id int, version int, batch_id long, event_id long, client_id long, "
           "sample_size long, content_hash string, values array<float>")
PARAMS = "federation_id int, version int, layer string, block_id int, values array<double>"
REPORT = ("federation_id int, version int, class string, precision double, recall double, "
          "f1 double, support long")
SINKS = ("requests", "uploads", "params", "evaluations", "history")


def advance(state: tuple, at: int, fetch: bool, claimed, exists: bool, merge_us: int,
            evaluate_us: int) -> tuple[tuple, tuple]:
    """(state after, (server_version, merging, evaluating, balance)) of one request."""
    version, balance, merged_at, ready_at = state
    if 0 <= ready_at <= at:
        version, merged_at, ready_at = version + 1, -1, -1
    busy, shown = ready_at >= 0, version
    merging = busy and at < merged_at
    if claimed == version and not busy and (exists or not fetch):
        balance += 1 if fetch else -1
        if not fetch and balance == 0:
            if merge_us + evaluate_us:
                merged_at, ready_at = at + merge_us, at + merge_us + evaluate_us
            else:
                version += 1
    return (version, balance, merged_at, ready_at), (shown, merging, busy and not merging, balance)


def judge(first_version: int):
    """The stateful function: requests of one federation against its state."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], group: GroupState
            ) -> Iterator[pd.DataFrame]:
        state = group.get if group.exists else (first_version, 0, -1, -1)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"], ignore_index=True)
        at = rows["ts"].astype("datetime64[us]").astype("int64")
        said = []
        for t, op, claimed, exists, merge_us, evaluate_us in zip(
                at, rows["op"], rows["claimed_version"], rows["exists"], rows["merge_us"],
                rows["evaluate_us"], strict=True):
            state, answer = advance(state, int(t), op == "fetch", claimed, bool(exists),
                                    int(merge_us), int(evaluate_us))
            said.append(answer)
        group.update(tuple(int(x) for x in state))
        out = pd.DataFrame(said, columns=["server_version", "merging", "evaluating", "balance"])
        yield pd.concat([rows, out], axis=1)[[c.split()[0] for c in JUDGED.split(", ")]]
    return run


def judged(requests: DataFrame, first_version: int = 0) -> DataFrame:
    """Decided requests of a stream of requests: as ``operators.live.decided`` gives them."""
    names = [c.split()[0] for c in JUDGED.split(", ")]
    given = requests.select(*(F.col(c).cast("timestamp") if c == "ts" else F.col(c)
                              for c in names if c in requests.columns))
    kept = given.groupBy("federation_id").applyInPandasWithState(
        judge(first_version), JUDGED, STATE, "append", GroupStateTimeout.NoTimeout)
    return closing(kept)


def closing(kept: DataFrame) -> DataFrame:
    """Status, details, delta and the closes of requests with their state."""
    decided = RD.admission(kept).withColumn("version", F.col("server_version"))
    closes = (F.col("op") == "upload") & (F.col("status") == "accepted") & (F.col("balance") == 0)
    return decided.withColumn("closes", closes)


def run_live(spark: SparkSession, events_path: str, models: DataFrame, test_rows: DataFrame,
             out: str, checkpoint: str, files_per_trigger: int = 1,
             before: Callable[[int, str], None] = lambda batch, sink: None) -> None:
    """Drive the stream over every available file, then stop.

    Writes the folders of ``SINKS`` below ``out``. ``before`` is called with the number of
    the batch and the name of each sink before it is written.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        decided = batch.persist()
        closed = decided.filter("closes").select(*J.ROUND, F.col("event_id").alias("close_event"))

        def stored(name: str, schema: str) -> DataFrame:
            return session.read.schema(schema).parquet(f"{out}/{name}")

        def objects() -> DataFrame:
            ups = stored("uploads", UPLOADS).filter(F.col("batch_id") <= batch_id)
            return J.stored_objects(ups.join(closed.select(*J.ROUND), J.ROUND, "left_semi"))

        def of_batch(rows: DataFrame) -> DataFrame:
            new = closed.select("federation_id", (F.col("version") + 1).alias("version"))
            return rows.join(new, J.ROUND, "left_semi")

        def requests():
            return decided.withColumn("batch_id", F.lit(batch_id)), ["batch_id"]

        def uploads():
            rows = J.uploaded(decided, models).withColumn("batch_id", F.lit(batch_id))
            return rows, [*J.ROUND, "batch_id"]

        def params():
            return J.published(objects(), closed), J.ROUND

        def evaluations():
            return J.evaluated(of_batch(stored("params", PARAMS)), test_rows), J.ROUND

        def history():
            return J.round_rows(objects(), closed, of_batch(stored("evaluations", REPORT))), J.ROUND

        for name, sink in zip(SINKS, (requests, uploads, params, evaluations, history),
                              strict=True):
            before(batch_id, name)
            rows, keys = sink()
            overwrite(rows, f"{out}/{name}", *keys)
        decided.unpersist()

    events = (spark.readStream.schema(EVENT_SCHEMA)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(events_path))
    requests = fixtures.live_requests(RD.round_events(events))
    query = (judged(requests).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()

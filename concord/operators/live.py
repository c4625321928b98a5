"""Round control against the live version.

A request names the version its client holds. It is judged by the version that the
server has at that moment, which moves when a round closes, which depends on what was
admitted before: the events of a federation form one chain of states. The chain is
folded in parallel:

* In round v only requests that claim v count, so the counter within the round is a
  running sum over the requests that claim v, less its value where the round starts.
* An upload u that closes round v - 1 starts round v when its model is merged and
  evaluated. The close of v is then the first upload claiming v after that moment at which
  the running sum is back at its value of that moment. So every upload has one possible
  successor, found for all uploads at once by sorted lookups; this is the transition of
  one close to the next.
* The closes that really happen are those reached from the first round. Transitions are
  composed with themselves (1, 2, 4, ... closes at a step), so reaching all rounds takes
  as many steps as the number of rounds has binary digits.

The rounds found give the version of each request (a running count of starts) and, by an
interval join, whether a merge or an evaluation was running; admission and counter follow.

Requests: federation_id, event_id (unique), ts, client_id, op, sample_size,
claimed_version, exists, merge_us and evaluate_us (what merging and evaluating would take
if this upload closed its round). Requests with a NULL claim match no version. All sums
and lookups are two-level (time buckets, then rows of a bucket), so a federation with a
third of all requests is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.operators import rounds as RD
from concord.operators.intervals import BEFORE_ALL, bucket_of, in_intervals
from concord.session import cut_lineage

FED = "federation_id"
BUSY = ["merging", "evaluating"]


def timed(requests: DataFrame) -> DataFrame:
    """Requests with their place in time: ``at`` (microseconds) and ``seq``."""
    return requests.withColumns({"at": F.unix_micros(F.col("ts").cast("timestamp")),
                                 "seq": F.col("event_id").cast("bigint")})


def started(at: Column, closed_at: Column, close_event: Column) -> Column:
    """The ``seq`` of a moment: right after the close if no time passed, else before all
    events of its time."""
    return F.when(at == closed_at, close_event).otherwise(F.lit(BEFORE_ALL))


def next_marked(df: DataFrame, partition: list[str], marked: Column, value: str, out: str,
                bucket_seconds: int) -> DataFrame:
    """``value`` of the next marked row after each row, in the order (at, seq) of its partition.

    Two levels: the next marked row of the same time bucket, else the first one of the next
    bucket that has any.
    """
    rows = df.withColumns({"_b": bucket_of(F.col("at"), bucket_seconds),
                           "_v": F.when(marked, F.col(value))})
    heads = rows.filter(marked).groupBy(*partition, "_b").agg(
        F.min_by("_v", F.struct("at", "seq")).alias("_head"))
    back = [F.desc("at"), F.desc("seq")]
    inside = Window.partitionBy(*partition, "_b").orderBy(*back).rowsBetween(
        Window.unboundedPreceding, -1)
    # every bucket of a partition, with the head of the next one that has a marked row
    later = Window.partitionBy(*partition).orderBy(F.desc("_b")).rowsBetween(
        Window.unboundedPreceding, -1)
    buckets = rows.select(*partition, "_b").distinct().join(heads, [*partition, "_b"], "left")
    ahead = buckets.select(*partition, "_b", F.last("_head", ignorenulls=True).over(later)
                           .alias("_ahead"))
    near = rows.withColumn("_near", F.last("_v", ignorenulls=True).over(inside))
    return (near.join(ahead, [*partition, "_b"])
            .withColumn(out, F.coalesce("_near", "_ahead"))
            .drop("_b", "_v", "_near", "_ahead"))


def transitions(requests: DataFrame, first_version: int, bucket_seconds: int
                ) -> tuple[DataFrame, DataFrame]:
    """(first closes, (federation_id, node, next)): which upload closes the round after the
    one that an upload closes, if it does close one."""
    upload = F.col("op") == "upload"
    delta = F.when(upload, -1).when(F.col("exists"), 1).otherwise(0)
    moves = timed(requests).select(
        FED, F.col("claimed_version").cast("int").alias("version"), "at", "seq",
        delta.alias("delta"), upload.alias("closer"),
        (F.col("at") + F.coalesce("merge_us", F.lit(0)) + F.coalesce("evaluate_us", F.lit(0)))
        .alias("ready")).filter("delta <> 0 AND version IS NOT NULL")
    asked = moves.filter("closer").select(
        FED, (F.col("version") + 1).alias("version"), F.col("ready").alias("at"),
        started(F.col("ready"), F.col("at"), F.col("seq")).alias("seq"), F.lit(0).alias("delta"),
        F.lit(False).alias("closer"), F.col("seq").alias("node"))
    rows = moves.drop("ready").withColumn("node", F.lit(None).cast("bigint")).unionByName(asked)
    rows = rows.withColumn("_ts", F.timestamp_micros("at"))
    summed = cut_lineage(RD.running_sum(rows, [FED, "version"], F.col("delta"), "pending",
                                        bucket_seconds, ts="_ts", order=["at", "seq"]))
    first = summed.filter((F.col("version") == first_version) & F.col("closer")
                          & (F.col("pending") == 0)).groupBy(FED).agg(
        F.min_by("seq", F.struct("at", "seq")).alias("node"))
    steps = next_marked(summed, [FED, "version", "pending"], F.col("closer"), "seq", "next",
                        bucket_seconds)
    return first, steps.filter("node IS NOT NULL AND next IS NOT NULL").select(FED, "node", "next")


def reached(first: DataFrame, steps: DataFrame) -> DataFrame:
    """(federation_id, node): what the transitions reach from the first closes.

    After k rounds of the loop all closes at a distance below 2 ** k are known, and
    ``steps`` leaps over 2 ** k closes.
    """
    known, steps = cut_lineage(first), cut_lineage(steps)
    while True:
        more = cut_lineage(known.join(steps, [FED, "node"]).select(
            FED, F.col("next").alias("node")))
        if more.isEmpty():
            return known
        known = cut_lineage(known.unionByName(more))
        onward = steps.select(FED, F.col("node").alias("next"), F.col("next").alias("far"))
        steps = cut_lineage(steps.join(onward, [FED, "next"]).select(
            FED, "node", F.col("far").alias("next")))


def closed_rounds(requests: DataFrame, first_version: int = 0, bucket_seconds: int = 3600
                  ) -> DataFrame:
    """(federation_id, version, close_event, closed_at, merged_at, ready_at): the rounds that
    close, with the microseconds of their close, the end of their merge and of their
    evaluation, when the next version starts."""
    nodes = reached(*transitions(requests, first_version, bucket_seconds))
    merged = F.col("at") + F.coalesce("merge_us", F.lit(0))
    rows = timed(requests).withColumn("node", F.col("seq")).join(nodes, [FED, "node"])
    return rows.select(
        FED, F.col("claimed_version").cast("int").alias("version"),
        F.col("seq").alias("close_event"), F.col("at").alias("closed_at"),
        merged.alias("merged_at"), (merged + F.coalesce("evaluate_us", F.lit(0))).alias("ready_at"))


def status_intervals(closed: DataFrame) -> DataFrame:
    """(federation_id, kind, lo_at, lo_seq, hi_at): when merges and evaluations ran."""
    merging = F.struct(F.lit("merging").alias("kind"), F.col("closed_at").alias("lo_at"),
                       F.col("close_event").alias("lo_seq"), F.col("merged_at").alias("hi_at"))
    evaluating = F.struct(
        F.lit("evaluating").alias("kind"), F.col("merged_at").alias("lo_at"),
        started(F.col("merged_at"), F.col("closed_at"), F.col("close_event")).alias("lo_seq"),
        F.col("ready_at").alias("hi_at"))
    return closed.select(FED, F.inline(F.array(merging, evaluating)))


def decided(requests: DataFrame, closed: DataFrame, first_version: int = 0,
            bucket_seconds: int = 3600) -> DataFrame:
    """Every request judged by the live version, with the counter after it.

    Adds server_version (also ``version``, the round it belongs to), merging, evaluating,
    status, details, delta, balance and closes.
    """
    rows = timed(requests)
    starts = closed.select(
        FED, F.col("ready_at").alias("at"),
        started(F.col("ready_at"), F.col("closed_at"), F.col("close_event")).alias("seq"),
        F.lit(1).alias("kind"))
    line = rows.select(FED, "at", "seq", F.lit(0).alias("kind")).unionByName(starts).withColumn(
        "_ts", F.timestamp_micros("at"))
    counted = RD.running_sum(line, [FED], F.col("kind"), "n", bucket_seconds, ts="_ts",
                             order=["at", "seq", "kind"]).filter("kind = 0")
    version = (F.col("n") + first_version).cast("int")
    rows = rows.join(counted.select(FED, "seq", version.alias("server_version")), [FED, "seq"])
    flagged = in_intervals(rows, status_intervals(closed), [FED], BUSY, bucket_seconds)
    judged = RD.admission(flagged).withColumn("version", F.col("server_version"))
    judged = RD.running_sum(judged, [FED], F.col("delta"), "balance", bucket_seconds)
    closes = (F.col("op") == "upload") & (F.col("status") == "accepted") & (F.col("balance") == 0)
    return judged.withColumn("closes", closes).drop("at", "seq")


def live(requests: DataFrame, first_version: int = 0, bucket_seconds: int = 3600) -> DataFrame:
    """The decided requests of a whole request log."""
    requests = cut_lineage(requests)
    closed = cut_lineage(closed_rounds(requests, first_version, bucket_seconds))
    return decided(requests, closed, first_version, bucket_seconds)


def hold_offs(judged: DataFrame) -> DataFrame:
    """Per round, the requests of the right version held off by a merge or evaluation,
    which did not move the counter."""
    held = judged.filter(F.col("status") == "busy")
    n = lambda c: F.sum(c.cast("bigint")).alias
    return held.groupBy(FED, "version").agg(
        n(F.col("op") == "fetch")("n_fetches"), n(F.col("op") == "upload")("n_uploads"),
        n(F.col("merging"))("n_merging"), n(F.col("evaluating"))("n_evaluating"),
        F.sum("delta").alias("delta"))

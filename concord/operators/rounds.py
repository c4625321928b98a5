"""Round control as relational operators over an event table.

An event is a fetch (+1 pending work when admitted) or an upload (-1 when
admitted). The pending counter is a running sum per federation in event
order; an admitted upload that brings it to 0 closes the round, and the
round number (= model version) of an event is the count of earlier closes.

Running sums never use a per-federation window: one federation may carry a
third of all events. ``running_sum`` cuts the event order into time buckets,
prefix-sums the small per-bucket totals, and runs the row window inside
each (federation, bucket) only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions.names import STATUS_SCHEMA

# Event types of the driver's events table, by role.
FETCH_EVENTS = ("view", "click")
UPLOAD_EVENTS = ("purchase", "signup")
N_FEDERATIONS = 16

# Response details of the admission decisions.
DETAILS = {
    "fetch_wrong_version": "Requested version is unavailable",
    "fetch_missing": "Could not find resource",
    "fetch_busy": "Served, but not counted: the next model is in the making",
    "upload_wrong_version": "Upload request is for a bad version",
    "upload_busy": "Upload request denied",
    "fetch_accepted": "Sending global model",
    "upload_accepted": "Successfully saved client model",
}

ORDER = ["ts", "event_id"]


def round_events(events: DataFrame, n_federations: int = N_FEDERATIONS) -> DataFrame:
    """``(federation_id, event_id, ts, client_id, op, sample_size)``.

    fetch = view / click, upload = purchase / signup, other types are
    ignored (dropped). The sample size of an upload is the ``k`` entry of
    the JSON ``props`` map.
    """
    op = (F.when(F.col("event_type").isin(*FETCH_EVENTS), F.lit("fetch"))
          .when(F.col("event_type").isin(*UPLOAD_EVENTS), F.lit("upload")))
    props = F.from_json(F.col("props"), "map<string,bigint>")
    typed = events.filter(F.col("event_type").isin(*FETCH_EVENTS, *UPLOAD_EVENTS))
    return (typed.select(
        (F.col("user_id") % n_federations).cast("int").alias("federation_id"),
        "event_id", "ts", F.col("user_id").alias("client_id"), op.alias("op"),
        F.element_at(props, F.lit("k")).alias("sample_size"))
        .filter(F.col("op").isNotNull()))


def admission(requests: DataFrame) -> DataFrame:
    """P10: classify each request; ``delta`` is its effect on pending work.

    ``requests`` hold op, claimed_version, server_version, merging, evaluating and
    exists (whether the server has the model). A fetch of another version or of a
    missing model is refused; a fetch during a merge or evaluation is served but
    not counted. An upload of another version or during a merge is refused. A NULL
    claim is no version of the server; busy is either of the two flags.
    """
    fetch, upload = F.col("op") == "fetch", F.col("op") == "upload"
    right = F.col("claimed_version").eqNullSafe(F.col("server_version"))
    kind = (F.when(~right, F.lit("wrong_version"))
            .when(fetch & ~F.col("exists"), F.lit("missing"))
            .when(F.col("merging") | F.col("evaluating"), F.lit("busy"))
            .otherwise(F.lit("accepted")))
    details = F.element_at(F.create_map(*[x for k, v in DETAILS.items()
                                          for x in (F.lit(k), F.lit(v))]),
                           F.concat(F.col("op"), F.lit("_"), kind))
    delta = (F.when(fetch & (kind == "accepted"), F.lit(1))
             .when(upload & (kind == "accepted"), F.lit(-1)).otherwise(F.lit(0)))
    return requests.select("*", kind.alias("status"), details.alias("details"),
                           delta.alias("delta"))


def rejects(decided: DataFrame) -> DataFrame:
    """Requests that were not accepted, with the reason and the server's version."""
    return decided.filter(F.col("status") != "accepted").select(
        "federation_id", "event_id", "op", "status", "details", "claimed_version",
        "server_version")


def running_sum(df: DataFrame, partition: list[str], value: Column, out: str,
                bucket_seconds: int = 60, ts: str = "ts", order: list[str] | None = None
                ) -> DataFrame:
    """Inclusive running sum of ``value`` per ``partition`` in ``order``.

    Two levels: per (partition, time bucket) totals are prefix-summed over
    the small bucket table, joined back, and added to a row window that only
    spans one bucket. The result equals
    ``sum(value) OVER (PARTITION BY partition ORDER BY order ROWS UNBOUNDED PRECEDING)``.
    """
    order = order or ORDER
    bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket_seconds * 1_000_000))
    df = df.withColumn("_v", value).withColumn("_tb", bucket)
    totals = df.groupBy(*partition, "_tb").agg(F.sum("_v").alias("_bt"))
    before = (Window.partitionBy(*partition).orderBy("_tb")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*partition, "_tb",
                            F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_off"))
    inside = (Window.partitionBy(*partition, "_tb").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.join(offsets, [*partition, "_tb"], "inner")
            .withColumn(out, (F.col("_off") + F.sum("_v").over(inside)).cast("bigint"))
            .drop("_v", "_tb", "_off"))


def barrier(decided: DataFrame, bucket_seconds: int = 60, start: DataFrame | None = None
            ) -> DataFrame:
    """T01 + T02: pending balance, close trigger and round number per event.

    ``balance`` is the counter after the event; ``closes`` marks an admitted
    upload that brings it to 0; ``version`` is the number of closes before
    the event (the round it belongs to). ``start`` (federation_id, balance,
    version) holds the counters before the first event, 0 where it has no row.
    """
    part = ["federation_id"]
    with_bal = running_sum(decided, part, F.col("delta"), "balance", bucket_seconds)
    first = F.lit(0)
    if start is not None:
        with_bal = with_bal.join(start.select(
            "federation_id", F.col("balance").alias("_b0"), F.col("version").alias("_v0")),
            "federation_id", "left")
        with_bal = with_bal.withColumn("balance", F.col("balance") + F.coalesce("_b0", F.lit(0)))
        first = F.coalesce("_v0", F.lit(0))
    closes = (F.col("op") == "upload") & (F.col("status") == "accepted") & (F.col("balance") == 0)
    with_bal = with_bal.withColumn("closes", closes)
    counted = running_sum(with_bal, part, F.col("closes").cast("int"), "_n_closes",
                          bucket_seconds)
    return (counted.withColumn("version", (F.col("_n_closes") - F.col("closes").cast("int")
                                           + first).cast("int"))
            .drop("_n_closes", "_b0", "_v0"))


def hold_off(barriered: DataFrame, history: DataFrame, seconds: int) -> DataFrame:
    """Whether each request falls into the ``seconds`` after the previous round closed,
    when its model is merged and evaluated. An equi-join on (federation, version)."""
    before = history.filter(F.col("closed")).select(
        "federation_id", (F.col("version") + 1).alias("version"),
        F.unix_micros(F.col("closed_at").cast("timestamp")).alias("_closed"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return (barriered.join(before, ["federation_id", "version"], "left")
            .withColumn("held", F.coalesce(at <= F.col("_closed") + seconds * 1_000_000,
                                           F.lit(False))).drop("_closed"))


def round_history(barriered: DataFrame) -> DataFrame:
    """T03 + T06: one row per (federation, version) with counts, close state and elapsed time.

    ``n_models`` counts distinct uploaders (content-addressed: a client's
    repeated upload in a round is one object), ``total_samples`` sums the
    last recorded size per uploader.
    """
    acc_up = (F.col("op") == "upload") & (F.col("status") == "accepted")
    acc_fetch = (F.col("op") == "fetch") & (F.col("status") == "accepted")
    per_client = (barriered.filter(acc_up)
                  .groupBy("federation_id", "version", "client_id")
                  .agg(F.max_by("sample_size", F.struct(*ORDER)).alias("sample_size")))
    models = per_client.groupBy("federation_id", "version").agg(
        F.count("*").alias("n_models"), F.sum("sample_size").alias("total_samples"))
    counts = barriered.groupBy("federation_id", "version").agg(
        F.sum(acc_fetch.cast("int")).cast("bigint").alias("n_fetches"),
        F.sum(acc_up.cast("int")).cast("bigint").alias("n_uploads"),
        F.sum((F.col("status") != "accepted").cast("int")).cast("bigint").alias("n_rejected"),
        F.max(F.col("closes")).alias("closed"),
        F.min("ts").alias("opened_at"),
        F.max(F.when(F.col("closes"), F.col("ts"))).alias("closed_at"))
    return (counts.join(models, ["federation_id", "version"], "left")
            .select("federation_id", "version", "n_fetches", "n_uploads", "n_rejected",
                    F.coalesce("n_models", F.lit(0)).cast("bigint").alias("n_models"),
                    F.coalesce("total_samples", F.lit(0)).cast("bigint").alias("total_samples"),
                    "closed", "opened_at", "closed_at",
                    (F.unix_micros(F.col("closed_at").cast("timestamp"))
                     - F.unix_micros(F.col("opened_at").cast("timestamp"))).alias("elapsed_us")))


def requester_reaction(decided: DataFrame) -> DataFrame:
    """For version-refused requests, the server version echoed and the
    requester's move (ahead -> wait, behind -> upgrade to the server's)."""
    refused = decided.filter(F.col("status") == "wrong_version")
    claimed, server = F.col("claimed_version"), F.col("server_version")
    action = (F.when(claimed > server, F.lit("wait"))
              .when(claimed < server, F.lit("upgrade")).otherwise(F.lit("retry")))
    return refused.select("federation_id", "event_id", "op", "claimed_version", "server_version",
                          action.alias("action"), F.greatest(claimed, server).alias("next_version"))


def latest_versions(history: DataFrame) -> DataFrame:
    """Newest published version per federation (closed rounds + 1)."""
    closed = history.filter(F.col("closed"))
    return closed.groupBy("federation_id").agg(
        (F.max("version") + 1).cast("int").alias("published_version"),
        F.max_by("closed_at", "version").alias("published_at"),
        F.count("*").alias("n_closed"))


def current_versions(history: DataFrame) -> DataFrame:
    """Open round per federation: ``(federation_id, version)``."""
    return history.groupBy("federation_id").agg(F.max("version").alias("version"))


def read_status(documents: DataFrame, column: str = "document") -> DataFrame:
    """Status documents (JSON) as columns version, merging, evaluating, sample_sizes."""
    doc = F.from_json(F.col(column), STATUS_SCHEMA)
    return documents.withColumn("_s", doc).select(
        *[c for c in documents.columns if c != column], "_s.*")


def write_status(status: DataFrame, column: str = "document") -> DataFrame:
    """The columns of ``read_status`` as a JSON document."""
    names = STATUS_SCHEMA.fieldNames()
    return status.select(*[c for c in status.columns if c not in names],
                         F.to_json(F.struct(*names)).alias(column))


def after_upload(status: DataFrame, client: Column, size: Column) -> DataFrame:
    """The status after an upload: its client's entry in the map is set."""
    entry = F.create_map(client, size)
    rest = F.map_filter(F.coalesce("sample_sizes", F.create_map().cast("map<string,bigint>")),
                        lambda k, _: k != client)
    return status.withColumn("sample_sizes", F.map_concat(rest, entry))

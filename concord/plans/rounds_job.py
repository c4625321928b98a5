"""Round control in batch: events -> admission -> barrier -> round history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import rounds as RD
from concord.sources import fixtures, tables


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RD.admission(fixtures.request_log(RD.round_events(tables.events(spark, sf_dir))))


def barriered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RD.barrier(decided(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RD.round_history(barriered(spark, sf_dir))


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def q_admission(spark, sf_dir):
    """P10: admission decision per request."""
    return decided(spark, sf_dir).select("federation_id", "event_id", "op", "status",
                                         "details", "delta")


def q_balance(spark, sf_dir):
    """Pending-work counter after every event."""
    return barriered(spark, sf_dir).select("federation_id", "event_id", "balance")


def q_barrier(spark, sf_dir):
    """Events that close a round, with the version they close."""
    return (barriered(spark, sf_dir).filter(F.col("closes"))
            .select("federation_id", "event_id", "version"))


def q_history(spark, sf_dir):
    """Round tracker (one row per federation and version)."""
    h = history(spark, sf_dir)
    return h.select("federation_id", "version", "n_fetches", "n_uploads", "n_rejected",
                    "n_models", "total_samples", "closed",
                    _micros("opened_at").alias("opened_us"),
                    _micros("closed_at").alias("closed_us"), "elapsed_us")


def q_requester(spark, sf_dir):
    """Version-refused requests, server version echoed, requester move."""
    return RD.requester_reaction(decided(spark, sf_dir))


def q_rejects(spark, sf_dir):
    """Every refused or uncounted request with its reason."""
    return RD.rejects(decided(spark, sf_dir))


HOLD_SECONDS = 600


def q_hold_off(spark, sf_dir):
    """Requests within ten minutes after the previous round of their federation closed."""
    b = barriered(spark, sf_dir)
    return RD.hold_off(b, RD.round_history(b), HOLD_SECONDS).select(
        "federation_id", "event_id", "version", "held")


def q_latest(spark, sf_dir):
    """Newest published version per federation."""
    out = RD.latest_versions(history(spark, sf_dir))
    return out.select("federation_id", "published_version",
                      _micros("published_at").alias("published_us"), "n_closed")


def q_status(spark, sf_dir):
    """Status documents read, updated by an upload and written again; the
    map's entries and the document (read back from its text) beside each other."""
    docs = fixtures.status_documents(RD.round_events(tables.events(spark, sf_dir)))
    new = RD.after_upload(RD.read_status(docs), F.col("client_id").cast("string"),
                          F.col("sample_size"))
    again = RD.read_status(RD.write_status(new.drop("sample_size")))
    return again.select("event_id", "client_id", "version", "merging", "evaluating",
                        F.explode("sample_sizes").alias("client", "sample_size"))


def q_pending_updates(spark, sf_dir):
    """Admitted uploads of each federation's current (open) version."""
    b = barriered(spark, sf_dir)
    cur = RD.current_versions(RD.round_history(b))
    ups = b.filter((F.col("op") == "upload") & (F.col("status") == "accepted"))
    return (ups.join(cur, ["federation_id", "version"], "left_semi")
            .select("federation_id", "version", "event_id", "client_id", "sample_size"))


QUERIES = {
    "rounds_admission": q_admission,
    "rounds_balance": q_balance,
    "rounds_barrier": q_barrier,
    "rounds_history": q_history,
    "rounds_requester": q_requester,
    "rounds_rejects": q_rejects,
    "rounds_hold_off": q_hold_off,
    "rounds_latest_version": q_latest,
    "rounds_status": q_status,
    "rounds_pending_updates": q_pending_updates,
}

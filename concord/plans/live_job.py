"""The live round: admission by the server's version, averaging at a close, publishing,
evaluation and history (entry 1 as a whole)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import averaging as A
from concord.operators import blocks as B
from concord.operators import evaluate as E
from concord.operators import live as L
from concord.operators import rounds as RD
from concord.session import cut_lineage, scratch_folder
from concord.sources import files, fixtures, status, tables

R = 6
LAYER = "w"
#: Numbers of a block of a published model; the last of 64 has 16.
BLOCK = 24
ROUND = ["federation_id", "version"]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.live_requests(RD.round_events(tables.events(spark, sf_dir)))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.live(requests(spark, sf_dir))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model_id, values)``: the models that uploads bring."""
    return tables.embeddings(spark, sf_dir).select(F.col("vec_id").alias("model_id"),
                                                   F.col("embedding").alias("values"))


def held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each federation's own test rows: ``(federation_id, row, x, objectionable)``."""
    e = tables.embeddings(spark, sf_dir)
    return e.filter("label IS NOT NULL AND embedding IS NOT NULL").select(
        (F.col("vec_id") % RD.N_FEDERATIONS).cast("int").alias("federation_id"),
        F.col("vec_id").alias("row"), F.col("embedding").alias("x"),
        (F.col("label") >= 5).cast("int").alias("objectionable"))


def uploaded(decided: DataFrame, models: DataFrame) -> DataFrame:
    """Accepted uploads with their models: ``(federation_id, version, event_id, client_id,
    sample_size, content_hash, values)``; an upload without samples counts as one sample."""
    ups = decided.filter((F.col("op") == "upload") & (F.col("status") == "accepted"))
    size = F.greatest(F.coalesce("sample_size", F.lit(1)), F.lit(1)).cast("bigint")
    return ups.join(models, "model_id").select(
        *ROUND, "event_id", "client_id", size.alias("sample_size"),
        F.sha2(fixtures.content_of(F.col("values")), 256).alias("content_hash"), "values")


def stored_objects(uploads: DataFrame) -> DataFrame:
    """One object per content and round, with the sample size of its last upload."""
    return uploads.groupBy(*ROUND, "content_hash").agg(
        F.any_value("values").alias("values"),
        F.max_by("sample_size", "event_id").alias("sample_size"),
        F.count("*").alias("n_uploads"))


def published(objects: DataFrame, closed: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of the weighted mean of each closed round, under its version + 1."""
    of_closed = objects.join(closed.select(*ROUND), ROUND)
    cut = B.to_blocks(of_closed, "values", LAYER, [*ROUND, "sample_size"], size)
    mean = B.mean_blocks(cut, ROUND, "sample_size")
    return mean.withColumn("version", F.col("version") + 1)


def evaluated(params: DataFrame, rows: DataFrame) -> DataFrame:
    """Report of each published model on its federation's test rows.

    The blocks of one model (one row a model) are put side by side; a row is objectionable
    where the inner product is positive.
    """
    blocks = F.array_sort(F.collect_list(F.struct("block_id", "values")))
    models = params.groupBy(*ROUND).agg(F.flatten(F.transform(blocks, lambda b: b["values"]))
                                        .alias("w"))
    z = F.aggregate(F.zip_with("x", "w", lambda a, b: a.cast("double") * b), F.lit(0.0),
                    lambda s, v: s + v)
    scored = models.join(rows, "federation_id").select(
        *ROUND, "objectionable", (z > 0).cast("int").alias("prediction"))
    return E.report(scored, "objectionable", ROUND)


def round_rows(objects: DataFrame, closed: DataFrame, reports: DataFrame) -> DataFrame:
    """One history row per published version: its round's close, models, samples,
    and its scores (the version published is the closed round's + 1)."""
    n = objects.join(closed.select(*ROUND), ROUND).groupBy(*ROUND).agg(
        F.count("*").alias("n_models"), F.sum("n_uploads").alias("n_uploads"),
        F.sum("sample_size").alias("total_samples"))
    scores = reports.filter(F.col("class").isin("accuracy", "macro avg")).groupBy(*ROUND).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "macro avg", F.col("f1"))).alias("macro_f1"))
    new = (closed.join(n, ROUND).withColumn("version", F.col("version") + 1)
           .join(scores, ROUND, "left"))
    return new.select(*ROUND, "close_event", "n_models", "n_uploads", "total_samples",
                      "accuracy", "macro_f1")


# ---- registered queries -------------------------------------------------

def q_admission(spark, sf_dir):
    """Each request judged by the version that the server has at that moment."""
    return judged(spark, sf_dir).select(
        "federation_id", "event_id", "op", "claimed_version", "server_version", "status",
        "details", "delta")


def q_counter(spark, sf_dir):
    """Pending work after each request, and the requests that close a round."""
    return judged(spark, sf_dir).select("federation_id", "event_id", "version", "balance",
                                        "closes")


def q_hold_off(spark, sf_dir):
    """Requests held off while their round's models are merged and evaluated."""
    return L.hold_offs(judged(spark, sf_dir))


def q_requester(spark, sf_dir):
    """Requests of a wrong version, the live version echoed, the requester's move."""
    return RD.requester_reaction(judged(spark, sf_dir))


def q_rounds(spark, sf_dir):
    """The rounds of the live controller."""
    h = RD.round_history(judged(spark, sf_dir))
    return h.select(*ROUND, "n_fetches", "n_uploads", "n_rejected", "n_models", "total_samples",
                    "closed")


def live_round(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(decided requests, stored objects, closed rounds) of the whole log, each written once."""
    decided = cut_lineage(judged(spark, sf_dir))
    closed = decided.filter("closes").select(*ROUND, F.col("event_id").alias("close_event"))
    objects = cut_lineage(stored_objects(uploaded(decided, bodies(spark, sf_dir))))
    return decided, objects, closed


def q_published(spark, sf_dir):
    """Every version that a close publishes, read back from the store."""
    _, objects, closed = live_round(spark, sf_dir)
    folder = scratch_folder(spark, "live")
    files.write_params(published(objects, closed), folder)
    params = B.to_params(spark.read.parquet(folder), ROUND, BLOCK)
    return params.select(*ROUND, "layer", "pos", F.round("value", R).alias("value"))


def q_history(spark, sf_dir):
    """History of published versions with their scores."""
    _, objects, closed = live_round(spark, sf_dir)
    reports = evaluated(published(objects, closed), held_out(spark, sf_dir))
    return round_rows(objects, closed, reports)


def q_status(spark, sf_dir):
    """Status of every federation, written as a snapshot after the requests of the first
    half of the log and again after all, and read back as the newest snapshot."""
    decided, root = cut_lineage(judged(spark, sf_dir)), scratch_folder(spark, "status")
    half = decided.agg(F.max("event_id")).first()[0] or 0
    first = status.append(status.status_of(decided.filter(F.col("event_id") <= half / 2)), root, 0)
    status.append(status.status_of(decided), root, first)
    return status.snapshot(spark, root)


def q_blocks(spark, sf_dir):
    """Uniform and weighted means, and the scaled sum, over blocks of 24 numbers."""
    ups = fixtures.client_updates(tables.embeddings(spark, sf_dir))
    weighed = A.with_model_count(cut_lineage(A.weighed_objects(ups, "embedding")))
    cut = cut_lineage(B.to_blocks(weighed, "embedding", LAYER,
                                  ["version", "sample_size", "n_models"], BLOCK))
    scaled = B.scale(cut, F.lit(1.0), F.col("n_models"))
    kinds = {"uniform": B.mean_blocks(cut, ["version"]),
             "weighted": B.mean_blocks(cut, ["version"], "sample_size"),
             "scaled_sum": B.sum_blocks(scaled, ["version"])}
    out = None
    for kind, blocks in kinds.items():
        rows = B.to_params(blocks, ["version"], BLOCK).withColumn("algo", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out.select("algo", "version", "layer", "pos", F.round("value", R).alias("value"))


QUERIES = {
    "live_admission": q_admission,
    "live_counter": q_counter,
    "live_hold_off": q_hold_off,
    "live_requester": q_requester,
    "live_rounds": q_rounds,
    "live_published": q_published,
    "live_history": q_history,
    "live_status": q_status,
    "avg_blocks": q_blocks,
}

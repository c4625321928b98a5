"""Entry 3 + F09: fine-tune per client -> average -> publish -> evaluate.

Clients train on the train split only: their rows are the train texts of the
unified corpus, each once per owner and label, and no text of the val or test
split under any label. All clients train in one job keyed by ``client``; the
published version is the global model plus the (weighted) mean of the client
deltas, and the constant entries of the base version are carried over (F08).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import averaging as A
from concord.operators import evaluate as E
from concord.operators import ml_model as ML
from concord.operators import model as M
from concord.operators import trainer as LT
from concord.operators.corpus import SPLIT_SEED, split_key
from concord.plans import corpus_job
from concord.session import cut_lineage, scratch_folder
from concord.sources import files, tables

CORPUS_CARRY = ["split_key", "objectionable", "split"]
HELD_OUT = ("val", "test")


def corpus_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split corpus featurised: ``(split_key, objectionable, split, ...)``."""
    return M.hashed_features(corpus_job.corpus_split(spark, sf_dir), CORPUS_CARRY)


def train_features(feats: DataFrame) -> DataFrame:
    """Train rows whose text is in no held-out split under the other label."""
    held = feats.filter(F.col("split").isin(*HELD_OUT)).select("split_key").distinct()
    return feats.filter(F.col("split") == "train").join(held, "split_key", "left_anti")


def written_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus features written once: training reads them twice, scoring once more."""
    return cut_lineage(corpus_features(spark, sf_dir))


def client_features(spark: SparkSession, sf_dir: str, feats: DataFrame | None = None
                    ) -> DataFrame:
    """Each client's distinct train rows: ``(client, split_key, objectionable, features)``.

    ``feats``: the corpus features, where they are already there.
    """
    feats = written_features(spark, sf_dir) if feats is None else feats
    owners = (corpus_job.labelled(spark, sf_dir).filter(F.col("toxic").isNotNull())
              .select("client", split_key(F.col("text"), SPLIT_SEED).alias("split_key"),
                      F.col("toxic").alias("objectionable")).distinct())
    return (train_features(feats)
            .join(owners, ["split_key", "objectionable"])
            .select("client", "split_key", "objectionable", "features"))


def federated_round(feats: DataFrame, params: DataFrame, version: int,
                    algo: str = "wmean") -> DataFrame:
    """One round from ``params`` (version ``version``) to version + 1:
    every client's local step in one job (M03), the mean of the client
    models (F03 / F04), constant entries carried from the base (F08)."""
    deltas = M.local_step(feats, params, "objectionable", ["client"])
    updated = M.merged(params, deltas, version + 1, algo)
    return A.assemble(updated, params, version + 1, list(M.FLOAT_LAYERS))


def run_rounds(spark: SparkSession, sf_dir: str, n_rounds: int, folder: str,
               algo: str = "wmean") -> DataFrame:
    """repeated rounds. Every version is published to ``folder/params``
    before the next round reads it, and appended to ``folder/history`` with its
    number of clients and samples and its scores on the held-out splits.
    Returns the history; a rerun replaces the versions it publishes."""
    corpus = written_features(spark, sf_dir)
    feats = cut_lineage(client_features(spark, sf_dir, corpus))
    held = corpus.filter(F.col("split").isin(*HELD_OUT))
    files.write_params(M.initial_params(spark, 0), f"{folder}/params")
    size = feats.agg(F.countDistinct("client").alias("n_clients"), F.count("*").alias("n_samples"))
    for v in range(n_rounds):
        params = files.read_params(spark, f"{folder}/params", v)
        files.write_params(federated_round(feats, params, v, algo), f"{folder}/params")
        new = files.read_params(spark, f"{folder}/params", v + 1)
        report = E.report(M.score(held, new), "objectionable", ["split"])
        row = report.filter("class = 'macro avg'").groupBy().pivot("split", list(HELD_OUT)).agg(
            F.first("f1"))
        row = row.select(F.lit(v + 1).alias("version"),
                         *(F.col(s).alias(f"{s}_f1") for s in HELD_OUT))
        files.write_params(row.join(size.withColumn("version", F.lit(v + 1)), "version"),
                           f"{folder}/history")
    return spark.read.parquet(f"{folder}/history")


def central_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step of central training on the train split from version 0."""
    feats = corpus_features(spark, sf_dir).filter(F.col("split") == "train")
    params = M.initial_params(spark, 0)
    deltas = M.local_step(feats, params, "objectionable", ["split"])
    return A.assemble(M.merged(params, deltas, 1), params, 1, list(M.FLOAT_LAYERS))


# ---- registered queries -------------------------------------------------

R = 6


def q_features(spark, sf_dir):
    """Hashed token features of every document."""
    f = M.hashed_features(tables.documents(spark, sf_dir), ["doc_id"])
    return (f.select("doc_id", "n_tokens", F.inline("features"))
            .withColumn("x", F.round("x", R)))


def q_central_step(spark, sf_dir):
    """Parameters after one central training step."""
    return central_step(spark, sf_dir).withColumn("value", F.round("value", R))


def q_client_step(spark, sf_dir):
    """Per-client deltas after one local step from the global model."""
    d = M.local_step(client_features(spark, sf_dir), M.initial_params(spark, 0),
                     "objectionable", ["client"])
    return d.select("client", "layer", "pos", F.round("delta", R).alias("delta"),
                    "sample_size")


def version_one(spark, sf_dir, feats: DataFrame | None = None) -> DataFrame:
    """Version 1 from the zero model."""
    return federated_round(client_features(spark, sf_dir, feats), M.initial_params(spark, 0), 0)


def q_round(spark, sf_dir):
    """F08, F09 (one round): published version 1, sample-size weighted."""
    return version_one(spark, sf_dir).withColumn("value", F.round("value", R))


def _v1_scores(spark, sf_dir):
    feats = written_features(spark, sf_dir)
    return M.score(feats, version_one(spark, sf_dir, feats))


def q_scores(spark, sf_dir):
    """Val and test scores of version 1 beside the true label."""
    s = _v1_scores(spark, sf_dir).filter(F.col("split").isin(*HELD_OUT))
    return s.select("split", "split_key", "objectionable", F.round("z", R).alias("z"),
                    "prediction")


def q_confusion(spark, sf_dir):
    """Confusion counts of version 1 per split."""
    return E.confusion(_v1_scores(spark, sf_dir), "objectionable", ["split"])


def q_report(spark, sf_dir):
    """Classification report of version 1 per split."""
    return E.report(_v1_scores(spark, sf_dir), "objectionable", ["split"])


def q_wrong(spark, sf_dir):
    """Wrong predictions of version 1 on the val and test splits."""
    s = _v1_scores(spark, sf_dir).filter(F.col("split").isin(*HELD_OUT))
    return E.wrong_predictions(s, "objectionable").select("split", "split_key", "objectionable",
                                                          "prediction")


COMPARED = ("v0", "v1", "v1_self")


def models_for_comparison(spark, sf_dir, feats: DataFrame | None = None) -> DataFrame:
    """v0, v1 and v1 averaged with itself (two copies, uniform mean)."""
    p0 = M.initial_params(spark, 0)
    p1 = cut_lineage(version_one(spark, sf_dir, feats))
    copies = p1.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("content_hash"))
    return (p0.withColumn("model", F.lit("v0"))
            .unionByName(p1.withColumn("model", F.lit("v1")))
            .unionByName(A.uniform_mean(copies).withColumn("model", F.lit("v1_self"))))


def q_compare(spark, sf_dir):
    """Report deltas v1 - v0 and (v1 averaged with itself) - v1."""
    feats = written_features(spark, sf_dir)
    models = models_for_comparison(spark, sf_dir, feats)
    held = feats.filter(F.col("split").isin(*HELD_OUT))
    rows = held.select("*", F.explode(F.array(*[F.lit(m) for m in COMPARED])).alias("model"))
    rep = E.report(M.score(rows, models, ["model"]), "objectionable", ["model", "split"])
    return E.compare(rep, "model", [("v0", "v1"), ("v1", "v1_self")], ["split", "class"])


def q_conversation_flags(spark, sf_dir):
    """Application of M04: score user turns of conversations with version 1;
    a conversation is flagged when any user turn is predicted objectionable."""
    turns = tables.conversations(spark, sf_dir).filter(F.col("role") == "user")
    s = M.score(M.hashed_features(turns, ["conv_id", "turn"]), version_one(spark, sf_dir))
    return s.groupBy("conv_id").agg(
        F.count("*").alias("n_user_turns"), F.round(F.max("z"), R).alias("max_z"),
        F.max("prediction").alias("flagged"))


def local_training(spark, sf_dir, rounds: int = 4, epochs: int = 3, feats: DataFrame | None = None
                   ) -> DataFrame:
    """Parameters after rounds of minibatch epochs on every client."""
    rows = cut_lineage(client_features(spark, sf_dir, feats))
    params = M.initial_params(spark, 0)
    for v in range(rounds):
        params = cut_lineage(LT.merged(params, LT.local_epochs(rows, params, epochs), v + 1))
    return params


def q_minibatch_report(spark, sf_dir):
    """Report of four rounds of three minibatch epochs per client, per split."""
    feats = written_features(spark, sf_dir)
    scores = M.score(feats, local_training(spark, sf_dir, feats=feats))
    return E.report(scores, "objectionable", ["split"])


def q_pipeline_report(spark, sf_dir):
    """Report of the ML pipeline, trained further once, saved and loaded."""
    split = cut_lineage(corpus_job.corpus_split(spark, sf_dir).select("text", "objectionable",
                                                                      "split"))
    train = split.filter("split = 'train'")
    base, settings = ML.train(train, max_iter=5)
    folder = scratch_folder(spark, "pipeline")
    ML.save(*ML.train_further(base, settings, train, max_iter=10), folder, spark)
    return E.report(ML.score(split, *ML.load(spark, folder)), "objectionable", ["split"])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unify -> split -> one federated round -> report of the published model."""
    return E.report(_v1_scores(spark, sf_dir), "objectionable", ["split"])


QUERIES = {
    "model_features": q_features,
    "model_central_step": q_central_step,
    "model_client_step": q_client_step,
    "model_round": q_round,
    "model_scores": q_scores,
    "eval_confusion": q_confusion,
    "eval_report": q_report,
    "eval_wrong": q_wrong,
    "eval_compare": q_compare,
    "conversation_flags": q_conversation_flags,
    "model_minibatch_report": q_minibatch_report,
    "model_pipeline_report": q_pipeline_report,
}

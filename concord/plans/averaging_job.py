"""Entry 1 (merge side): client updates -> weights -> averaged parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import names as N
from concord.operators import averaging as A
from concord.operators import uploads as U
from concord.session import cut_lineage, scratch_folder
from concord.sources import files, fixtures, tables
from concord.sources import objects as object_store

R = 6


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.client_updates(tables.embeddings(spark, sf_dir))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(version, content_hash, embedding, n_uploads)``: distinct stored models."""
    return A.distinct_objects(updates(spark, sf_dir), "embedding")


KEEP = ["version", "content_hash"]


def object_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(version, content_hash, n_models, layer, pos, value)``."""
    counted = A.with_model_count(objects(spark, sf_dir))
    return A.explode_vector(counted, "embedding", "w", [*KEEP, "n_models"])


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, R))
    return df


def q_scaled(spark, sf_dir):
    """each parameter scaled by 1 / (objects in its version)."""
    scaled = A.scale(object_params(spark, sf_dir), F.lit(1.0), F.col("n_models"))
    return _rounded(scaled.select(*KEEP, "layer", "pos", "scaled"), "scaled")


def q_sum_scaled(spark, sf_dir):
    """element-wise sum of the scaled models."""
    scaled = A.scale(object_params(spark, sf_dir), F.lit(1.0), F.col("n_models"))
    return _rounded(A.sum_models(scaled), "value")


def q_uniform(spark, sf_dir):
    """uniform mean per parameter over distinct objects."""
    params = A.explode_vector(objects(spark, sf_dir), "embedding", "w", KEEP)
    return _rounded(A.uniform_mean(params), "value")


def q_weighted(spark, sf_dir):
    """sample-size-weighted mean per parameter over distinct objects."""
    weighed = A.weighed_objects(updates(spark, sf_dir), "embedding")
    params = A.explode_vector(weighed, "embedding", "w", [*KEEP, "sample_size"])
    return _rounded(A.weighted_mean(params), "value")


def q_order_property(spark, sf_dir):
    """divide-then-add and add-then-divide of every parameter."""
    return _rounded(A.both_orders(object_params(spark, sf_dir)), "divide_then_add",
                    "add_then_divide")


def q_cohorts(spark, sf_dir):
    """averages of cohorts of 4, 3 and 4 objects, in turn over all of each version."""
    dealt = A.cohorts(objects(spark, sf_dir), [4, 3, 4])
    params = A.explode_vector(dealt, "embedding", "w", ["version", "cohort"])
    return _rounded(A.uniform_mean(params, ["version", "cohort", "layer", "pos"]), "value")


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.ingest(fixtures.upload_records(tables.documents(spark, sf_dir)))


def q_ingest(spark, sf_dir):
    """Decode, hash, name and admit each upload."""
    return uploads(spark, sf_dir).select("doc_id", "version", "content_hash", "object_name",
                                         "sample_size", "status")


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.accepted(fixtures.upload_records(tables.documents(spark, sf_dir)))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object store that the accepted uploads make: one object per content."""
    acc = accepted(spark, sf_dir)
    return acc.groupBy("version", "content_hash").agg(
        F.any_value("object_name").alias("object_name"), F.any_value("size").alias("size"),
        F.count("*").alias("n_uploads"))


def q_dedupe_uploads(spark, sf_dir):
    """the distinct stored objects with their number of uploads."""
    return stored(spark, sf_dir)


def q_listing(spark, sf_dir):
    """Local objects by name, their key, and the mean object size."""
    named = stored(spark, sf_dir).select(
        "version", F.concat(F.lit("models/"), "object_name").alias("path"), "size")
    listed = N.listing(named)
    totals = listed.groupBy("version").agg(F.avg("size").alias("mean_size"),
                                           F.count("*").alias("n_objects"))
    return listed.join(totals, "version").select(
        "version", "name", "key", "size", "n_objects", F.round("mean_size", R).alias("mean_size"))


def q_object_files(spark, sf_dir):
    """Every distinct model stored as a file of its own and listed by name and size."""
    body = F.concat(F.lit("["), fixtures.content_of(F.col("embedding")), F.lit("]"))
    folder = scratch_folder(spark, "objects")
    object_store.write_objects(objects(spark, sf_dir).select(
        "version", F.col("content_hash").alias("key"), body.alias("body")), folder)
    listed = cut_lineage(object_store.stored(spark, folder))
    return listed.join(object_store.mean_sizes(listed), "version").select(
        "version", "name", "key", "length", "n_objects", F.round("mean_size", R).alias("mean_size"))


def q_global_names(spark, sf_dir):
    """Name under which the version after each upload version is published."""
    return (stored(spark, sf_dir).groupBy("version").agg(F.sum("size").alias("bytes"))
            .select((F.col("version") + 1).alias("version"), "bytes",
                    N.global_object_name(F.col("version") + 1).alias("object_name")))


def q_published(spark, sf_dir):
    """The uniform mean published by version, read back from the store."""
    folder = scratch_folder(spark, "published")
    files.write_params(A.uniform_mean(A.explode_vector(
        objects(spark, sf_dir), "embedding", "w", KEEP)), folder)
    return _rounded(files.read_params(spark, folder), "value").select(
        "version", "layer", "pos", "value")


def q_last_write(spark, sf_dir):
    """Sample size per (version, object), last upload wins."""
    acc = accepted(spark, sf_dir)
    return A.last_write_wins(acc, ["version", "content_hash"], "doc_id", "sample_size")


def q_shares(spark, sf_dir):
    """Each object's share of its version's samples."""
    acc = accepted(spark, sf_dir)
    latest = cut_lineage(A.last_write_wins(acc, ["version", "content_hash"], "doc_id",
                                           "sample_size"))  # read for the totals and the rows
    return _rounded(A.shares(latest), "share")


def q_join_weights(spark, sf_dir):
    """Stored objects joined to their recorded weights."""
    ups = updates(spark, sf_dir)
    objs = A.distinct_objects(fixtures.objects_with_gaps(ups), "embedding")
    return A.join_weights(objs.drop("embedding"), fixtures.weights_with_gaps(ups))


def q_weight_gaps(spark, sf_dir):
    """Objects without weights and weights without objects."""
    ups = updates(spark, sf_dir)
    return A.weight_gaps(fixtures.objects_with_gaps(ups), fixtures.weights_with_gaps(ups))


def q_scaled_global_mean(spark, sf_dir):
    """Sum of n / s over all events (the mean, as a scaled sum)."""
    ev = tables.events(spark, sf_dir)
    s = ev.select(F.count("*")).scalar()
    return ev.agg(F.round(F.sum(F.col("event_id") / s), R).alias("scaled_sum"),
                  F.round(F.sum(F.col("value") / s), R).alias("scaled_value_sum"),
                  F.count("*").alias("n"))


QUERIES = {
    "avg_scaled": q_scaled,
    "avg_sum_scaled": q_sum_scaled,
    "avg_uniform": q_uniform,
    "avg_weighted": q_weighted,
    "avg_order_property": q_order_property,
    "avg_cohorts": q_cohorts,
    "uploads_ingest": q_ingest,
    "uploads_dedupe": q_dedupe_uploads,
    "uploads_listing": q_listing,
    "object_files": q_object_files,
    "uploads_global_names": q_global_names,
    "params_published": q_published,
    "uploads_last_write": q_last_write,
    "uploads_shares": q_shares,
    "avg_join_weights": q_join_weights,
    "avg_weight_gaps": q_weight_gaps,
    "scaled_global_mean": q_scaled_global_mean,
}

"""Entry 2: raw labelled sources -> unified corpus -> stratified splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import corpus as C
from concord.session import scratch_folder
from concord.sources import fixtures, tables


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.labelled_documents(tables.documents(spark, sf_dir),
                                       tables.labels(spark, sf_dir))


def wide_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.encoded_sources(labelled(spark, sf_dir))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.tag_classes(wide_sources(spark, sf_dir), keep=["doc_id", "file"])


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.dedupe_corpus(tagged(spark, sf_dir))


def corpus_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stratified_split(corpus(spark, sf_dir))


# ---- registered queries -------------------------------------------------

def q_source_tags(spark, sf_dir):
    """Per-row class tags of every source encoding."""
    return tagged(spark, sf_dir).select("doc_id", "source", C.LABEL)


def q_source_counts(spark, sf_dir):
    """Rows and distinct texts per source, file and class."""
    return C.source_counts(tagged(spark, sf_dir)).select(
        "source", "file", C.LABEL, "n_rows", "n_distinct")


def q_running_totals(spark, sf_dir):
    """Class totals after each source file is added."""
    return C.running_totals(C.source_counts(tagged(spark, sf_dir)))


def q_source_distinct(spark, sf_dir):
    """Distinct text within source, file and class."""
    return C.source_distinct(tagged(spark, sf_dir)).select("source", "file", C.LABEL, "text")


def q_bag_union(spark, sf_dir):
    """UNION ALL of the per-source distinct texts."""
    return C.bag_union(C.source_distinct(tagged(spark, sf_dir)))


def q_corpus(spark, sf_dir):
    """Unified corpus: distinct (text, class) across sources."""
    return corpus(spark, sf_dir)


def q_grand_total(spark, sf_dir):
    """Total of per-source distinct texts before the global dedup."""
    return C.source_distinct(tagged(spark, sf_dir)).agg(F.count("*").alias("n_total"))


def q_split(spark, sf_dir):
    """Deterministic stratified 70/15/15 split."""
    return corpus_split(spark, sf_dir).select("text", C.LABEL, "split")


def q_split_summary(spark, sf_dir):
    """Rows and positive share per split."""
    return C.split_summary(corpus_split(spark, sf_dir))


def q_vote_totals(spark, sf_dir):
    """One-hot votes summed per text over offensive rows."""
    return C.vote_totals(wide_sources(spark, sf_dir))


def q_label_conflicts(spark, sf_dir):
    """Texts with both classes, with a second annotator injected."""
    rows = fixtures.conflicting_annotations(labelled(spark, sf_dir))
    return C.label_conflicts(rows)


def q_training_frame(spark, sf_dir):
    """Train split renamed by position to (text, labels)."""
    return C.as_training_frame(corpus_split(spark, sf_dir), "train")


TOLERANCE = 0.05


def q_sketch_counts(spark, sf_dir):
    """A02, A03 (opt-in): distinct texts per source and class from sketches kept per file,
    beside the exact number: whether the estimate is within five per cent."""
    rows = tagged(spark, sf_dir)
    keys = ["source", C.LABEL]
    folder = scratch_folder(spark, "sketches")
    C.distinct_sketches(rows).write.partitionBy("source").parquet(folder)
    estimate = C.sketched_counts(spark.read.parquet(folder), keys)
    exact = rows.select(*keys, "text").distinct().groupBy(*keys).agg(F.count("*").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * TOLERANCE
    return estimate.join(exact, keys).select(*keys, "n_rows", F.col("exact").alias("n_distinct"),
                                             near.alias("within"))


QUERIES = {
    "corpus_sketch_counts": q_sketch_counts,
    "corpus_source_tags": q_source_tags,
    "corpus_source_counts": q_source_counts,
    "corpus_running_totals": q_running_totals,
    "corpus_source_distinct": q_source_distinct,
    "corpus_bag_union": q_bag_union,
    "corpus_dedup": q_corpus,
    "corpus_grand_total": q_grand_total,
    "corpus_split": q_split,
    "corpus_split_summary": q_split_summary,
    "corpus_vote_totals": q_vote_totals,
    "corpus_label_conflicts": q_label_conflicts,
    "corpus_training_frame": q_training_frame,
}

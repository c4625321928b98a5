"""From raw documents to token ids: five stages, each one operator of ``concord.llm``.

Every stage reads all that its predecessor kept and returns the columns of
``documents``; the last returns token ids. Rows are told apart by a hash of id
and text, so null and repeated ids are handled like any others.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import bpe, decontamination, jaccard_join, quality_rules, suffix_dedup
from concord.llm.common import bounded_batches, broadcast_if_small, table, written


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.xxhash64("doc_id", "text", "lang"))


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality rules reject go."""
    rows = _keyed(docs)
    rejected = (quality_rules.judge(rows, id_col="_key").filter(~F.col("kept"))
                .select(F.col("doc_id").alias("_key")).distinct())
    return rows.join(broadcast_if_small(rejected), "_key", "left_anti").drop("_key")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near duplicates the row with the smallest id stays."""
    rows = _keyed(docs)
    grouped = jaccard_join.join(rows, id_col="_key").select(
        F.col("doc_id").alias("_key"), "n_shingles", F.col("component_id").alias("_group"))
    grouped = written(grouped, "groups-of-rows")
    ids = rows.select("_key", "doc_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    stays = (grouped.distinct().join(ids, "_key").groupBy("_group")
             .agg(F.min(order).alias("first")).select(F.col("first._key").alias("_key")))
    goes = grouped.join(stays, "_key", "left_anti").select("_key").distinct()
    left = rows.join(broadcast_if_small(goes), "_key", "left_anti")
    # rows equal in id and text have one key: one of them stays
    again = (grouped.filter("n_shingles > 0").groupBy("_key").count().filter("count > 1")
             .select("_key"))
    if again.limit(1).count():
        again = broadcast_if_small(again)
        left = left.join(again, "_key", "left_anti").unionByName(
            left.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return left.drop("_key")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: repeated strings are cut from the texts, whole characters only."""
    cut = suffix_dedup.cut(docs, whole_characters=True)
    text = F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))
    return cut.withColumn("text", text).withColumn(
        "n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a benchmark window go."""
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids (little-endian unsigned 32-bit) and the round trip's digest."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), bpe.default_ranks())
    return coded.select("doc_id", "lang", "source",
                        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage with bounded batches of texts between executors and Python workers."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", _bounded(reject_by_rules)),
    ("n-gram Jaccard join", _bounded(one_of_each_group)),
    ("suffix-array dedup", _bounded(cut_repeats)),
    ("benchmark decontamination", _bounded(drop_contaminated)),
    ("byte-level BPE", _bounded(to_tokens)),
]

#: Not expressible: divergences, byte strings of 400 and BPE; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs

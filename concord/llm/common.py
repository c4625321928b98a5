"""Session and table helpers of the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return "/".join((checkpoint_dir(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}"))


#: Setting by which an execution's shuffle files go as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors.

    Nothing reads the shuffles behind the table once it is written, so their files go then;
    until its end the write keeps them, as it needs them when an executor is lost.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Setting and value: bytes of the rows that an executor hands to a Python worker at once.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def bounded_batches(spark: SparkSession) -> None:
    """From now on rows of long texts go to Python in small batches, where 10,000 of them (20 MB
    and more, held by the executor and by the worker) would be one."""
    spark.conf.set(*BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def id_column(df: DataFrame, name: str = "doc_id"):
    return F.col(name).cast("long")


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows (counted, not estimated)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Hint a broadcast only below a counted bound; beyond it the join shuffles."""
    return F.broadcast(df) if small_enough(df, max_rows) else df


#: A key of more than one in ``HOT_SHARE`` of all rows is hot; there are fewer than that many.
HOT_SHARE = 1000


def join_keyed(rows: DataFrame, keyed: DataFrame, key: str, size: str) -> DataFrame:
    """The rows joined with ``keyed``: one row a key, ``size`` of the rows having that key.

    Keys that hold more than one in ``HOT_SHARE`` of all rows, fewer than ``HOT_SHARE`` of
    them whatever the input, are broadcast; rows of all other keys are shuffled.
    """
    total = keyed.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * HOT_SHARE > total
    hot = F.broadcast(keyed.filter(is_hot))
    cold_rows = rows.join(F.broadcast(keyed.filter(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold_rows.join(keyed.filter(~is_hot), key))


def components(edges: DataFrame, name: str = "cc", rounds: int = 200) -> DataFrame:
    """(v, label): smallest node reachable from v, for each node of ``edges`` (a, b).

    Minimum over neighbours plus pointer jumping, both joins on keys; each
    round is written to the shared folder. Only a count reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a"))
                   .filter("a <> b").distinct(), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("v"))
                     .agg(F.min("b").alias("m"))
                     .select("v", F.least("v", "m").alias("label")), f"{name}-l0")
    for i in range(rounds):
        near = (both.join(labels, both.b == labels.v)
                .groupBy(F.col("a").alias("v")).agg(F.min("label").alias("m")))
        step = (labels.join(near, "v")
                .select("v", F.col("label").alias("old"), F.least("label", "m").alias("mid")))
        jump = labels.select(F.col("v").alias("mid"), F.col("label").alias("far"))
        new = written(step.join(jump, "mid", "left")
                      .select("v", "old", F.least("mid", "far").alias("label")),
                      f"{name}-l{i + 1}")
        labels = new.select("v", "label")
        if new.filter("label <> old").limit(1).count() == 0:
            return labels
    raise RuntimeError("components did not converge")

"""Round status as a versioned table (S05): append-only snapshots, the newest one is read.

A snapshot is a folder numbered one above the snapshot its writer has read. A writer that
read an older one, or that finds its number taken, is refused, so two writers never
overwrite each other's status; nothing is ever changed in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMN = "seq"


class StaleStatus(RuntimeError):
    """The status was written by another one since it was read."""


def newest(spark: SparkSession, root: str) -> int:
    """The number of the newest snapshot; 0 where there is none."""
    try:
        rows = spark.read.option("basePath", root).parquet(f"{root}/{COLUMN}=*")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
    return rows.agg(F.max(COLUMN)).first()[0] or 0


def append(status: DataFrame, root: str, read: int) -> int:
    """Write the snapshot that follows number ``read``; returns its number."""
    spark = status.sparkSession
    now = newest(spark, root)
    if now != read:
        raise StaleStatus(f"read snapshot {read}, the newest is {now}")
    try:
        status.write.mode("errorifexists").parquet(f"{root}/{COLUMN}={read + 1}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise StaleStatus(f"snapshot {read + 1} was written by another one") from e
    return read + 1


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of one snapshot, the newest by default."""
    number = newest(spark, root) if number is None else number
    return spark.read.parquet(f"{root}/{COLUMN}={number}")


def status_of(decided: DataFrame) -> DataFrame:
    """The status after the last request of each federation: version, flags, and the uploads
    of its open round as number of clients and their last sample sizes' total (D11)."""
    place = F.struct("ts", "event_id")
    last = decided.groupBy("federation_id").agg(
        F.max_by(F.struct("server_version", "merging", "evaluating"), place).alias("s"))
    last = last.select("federation_id", F.col("s.server_version").alias("version"), "s.merging",
                       "s.evaluating")
    ups = decided.filter("op = 'upload' AND status = 'accepted'").groupBy(
        "federation_id", "version", "client_id").agg(
        F.max_by("sample_size", place).alias("sample_size"))
    sizes = ups.groupBy("federation_id", "version").agg(
        F.count("*").alias("n_clients"), F.sum("sample_size").alias("total_samples"))
    none = F.lit(0).cast("bigint")
    return last.join(sizes, ["federation_id", "version"], "left").withColumns({
        "n_clients": F.coalesce("n_clients", none),
        "total_samples": F.coalesce("total_samples", none)})

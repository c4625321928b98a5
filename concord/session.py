"""Session construction and lineage cutting.

The shared folder for checkpoints comes from ``spark.checkpoint.dir``; where it
is unset, it is a folder of the session's warehouse. No machine-local folder
is used for intermediate data.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "concord", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on).

    Python workers import this package for the pandas-based stateful
    operator, so the repository root is put on their PYTHONPATH.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CONCORD_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``; a session without that setting uses a
    folder of its warehouse, which driver and executors share as well.
    """
    sc = spark.sparkContext
    current = (sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
               or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_folder(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder (survives executor loss).

    Unlike a checkpoint of rows, the table is read by column and has a known size, so later
    joins may broadcast it.
    """
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

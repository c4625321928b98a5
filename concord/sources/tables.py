"""Readers for the driver's parquet tables.

Each reader selects only the columns the operators use, so the parquet
scan's ReadSchema stays narrow; filters applied later are pushed into the
scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text", "source", "n_chars"])


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events",
                      ["event_id", "ts", "user_id", "event_type", "value", "props"])


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])

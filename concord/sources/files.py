"""File sources and sinks: CSV corpora, model object store, parameter tables.

Schemas are always explicit (no inference). The model store is a table with one
row per object, partitioned by version only: millions of objects are millions of
rows, not folders, and a filter on the version prunes before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions import names


#: What the reader sees for a quoted empty field, before it becomes the empty string;
#: a text that is exactly this would be read as empty.
EMPTY = "\u0000empty\u0000"
#: Both sides: blanks are kept, NULL is a bare field, the empty string a quoted one.
CSV = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""',
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header row; quoted fields may hold commas and quotes.

    ``multi_line``: fields may hold line breaks; such a file is read by one task,
    so it is off unless a source has them.
    """
    rows = (spark.read.schema(schema).options(**CSV, multiLine=multi_line)
            .option("emptyValue", EMPTY).csv(path))
    return rows.withColumns({f.name: F.when(F.col(f.name) == EMPTY, F.lit(""))
                             .otherwise(F.col(f.name))
                             for f in schema if isinstance(f.dataType, T.StringType)})


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType,
                 file_col: str = "file", multi_line: bool = False) -> DataFrame:
    """Every CSV file of a folder, keeping each row's file name."""
    return read_csv(spark, path, schema, multi_line).withColumn(
        file_col, F.col("_metadata.file_name"))


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CSV with header, no row index; optionally one folder per split.

    Reading the folder back gives the same rows: blanks, quotes, line breaks
    (with ``multi_line``), empty strings and NULLs.
    """
    w = df.write.mode("overwrite").options(**CSV)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_objects(objects: DataFrame, root: str) -> None:
    """Store objects ``(version, content_hash, ...)``: one row each, one folder per version.

    ``objects`` are distinct by (version, content_hash), as ``distinct_objects``
    makes them; the versions written replace what the store had of them.
    """
    named = objects.withColumn("name", names.local_object_name(F.col("version"),
                                                               F.col("content_hash")))
    (named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(root))


def list_objects(spark: SparkSession, root: str, version: int | None = None,
                 size: str | None = None) -> DataFrame:
    """S04 + P07 + P08: ``(version, name, content_hash[, size])`` of the stored objects.

    A version filter prunes folders; only the named columns are read.
    """
    df = spark.read.parquet(root)
    if version is not None:
        df = df.filter(F.col("version") == version)
    listed = names.listing(df.withColumn("path", F.col("name")))
    return listed.select("version", "name", F.col("key").alias("content_hash"),
                         *([size] if size else []))


def write_params(params: DataFrame, root: str) -> None:
    """Publish versions by dynamic partition overwrite on ``version``:
    rewriting a version replaces only that version (idempotent retry)."""
    (params.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(root))


def read_params(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """S09 load + P09: one version's parameters (partition pruning)."""
    df = spark.read.parquet(root)
    return df if version is None else df.filter(F.col("version") == version)

"""Scalar column helpers: content hashes, object names, base64, JSON.

All are built-in Spark expressions (JVM-side, codegen), no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Object name formats of the model store.
LOCAL_PREFIX = "local_v"
GLOBAL_PREFIX = "global_v"
OBJECT_SUFFIX = ".zip"

STATUS_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("merging", T.BooleanType()),
    T.StructField("evaluating", T.BooleanType()),
    T.StructField("sample_sizes", T.MapType(T.StringType(), T.LongType())),
])

UPLOAD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("sample_size", T.StringType()),
])


def content_hash(data: Column) -> Column:
    """SHA-256 hex digest of bytes or text."""
    return F.sha2(data, 256)


def local_object_name(version: Column, digest: Column) -> Column:
    """``local_v{version}_{sha256}.zip``; NULL without a digest."""
    return F.when(digest.isNotNull(), F.format_string(f"{LOCAL_PREFIX}%d_%s{OBJECT_SUFFIX}",
                                                      version, digest))


def global_object_name(version: Column) -> Column:
    """``global_v{version}.zip``."""
    return F.format_string(f"{GLOBAL_PREFIX}%d{OBJECT_SUFFIX}", version)


def base_name(path: Column) -> Column:
    """Last path component: ``split(path, '/')[-1]``."""
    return F.element_at(F.split(path, "/"), -1)


def key_from_name(name: Column) -> Column:
    """Content key of a local object name: third '_' field without extension."""
    return F.split_part(F.split_part(name, F.lit("_"), F.lit(3)), F.lit("."), F.lit(1))


def is_local_object(name: Column, version: Column | int) -> Column:
    """Prefix and suffix predicate of one version's local objects."""
    prefix = F.concat(F.lit(LOCAL_PREFIX), F.lit(version).cast("string")
                      if isinstance(version, int) else version.cast("string"), F.lit("_"))
    return name.startswith(prefix) & name.endswith(OBJECT_SUFFIX)


def listing(objects: DataFrame, path: str = "path") -> DataFrame:
    """S04 + P07 + P08: the local objects of a listing ``(version, path, ...)``, with
    their ``name`` (last path component) and content ``key``."""
    named = objects.withColumn("name", base_name(F.col(path)))
    local = named.filter(is_local_object(F.col("name"), F.col("version")))
    return local.withColumn("key", key_from_name(F.col("name")))


def parse_sample_size(text: Column) -> Column:
    """Integer cast of a text field; NULL when it is not an integer."""
    return text.try_cast("bigint")

"""Model objects as files (S04, A12): one file per object, listed and averaged by Spark.

The name of an object holds its version and its content key; a listing selects a version by
a glob on the names, so files of other versions and unrelated files are not opened, and
reads sizes from the listing alone (no content column, no content read). An object's
content is a JSON array of numbers.
"""

from __future__ import annotations

import os
import re
import uuid
from contextlib import contextmanager

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import names
from concord.operators import blocks as B
from concord.session import scratch_folder

#: Object files that one task writes, about, and that are listed at once.
OBJECTS_A_TASK = 500
OBJECTS_A_GROUP = 20_000
OBJECTS = "path string, modificationTime timestamp, length long, content binary"


def object_files(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The object files of a version (None: of all) below a folder, as ``binaryFile`` rows."""
    number = "*" if version is None else str(int(version))
    glob = f"{names.LOCAL_PREFIX}{number}_*{names.OBJECT_SUFFIX}"
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").schema(OBJECTS).load(folder))


def named(files: DataFrame) -> DataFrame:
    """With version, name and key from each file's own metadata; names that only look alike
    are left out (P07, P08)."""
    name = F.col("_metadata.file_name")
    version = F.regexp_extract(name, rf"^{names.LOCAL_PREFIX}(\d+)_", 1)
    out = files.withColumns({"name": name, "version": version}).filter("version <> ''")
    return out.withColumns({"version": F.col("version").cast("int"),
                            "key": names.key_from_name(F.col("name"))})


def listing(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``(version, name, key, length, modificationTime)``; no file is opened."""
    return named(object_files(spark, folder, version)).select(
        "version", "name", "key", "length", "modificationTime")


def mean_sizes(listed: DataFrame) -> DataFrame:
    """``(version, n_objects, mean_size)``."""
    return listed.groupBy("version").agg(F.count("*").alias("n_objects"),
                                         F.avg("length").alias("mean_size"))


def models(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``(version, key, values)`` of the stored objects that can be read as numbers."""
    values = F.from_json(F.try_validate_utf8(F.col("content").cast("string")), "array<double>")
    rows = named(object_files(spark, folder, version)).select("version", "key",
                                                              values.alias("values"))
    return rows.filter(F.col("values").isNotNull() & ~F.exists("values", lambda x: x.isNull()))


def averaged(spark: SparkSession, folder: str, version: int, size: int = B.BLOCK) -> DataFrame:
    """F03 over files: blocks ``(version, layer, block_id, values)`` of the mean object.

    Equal content stored under two names counts once (F07).
    """
    distinct = models(spark, folder, version).dropDuplicates(["version", "key"])
    return B.mean_blocks(B.to_blocks(distinct, "values", "w", ["version"], size), ["version"])


def store_of(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and the folder's path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(path)


def mounted(spark: SparkSession, folder: str) -> str | None:
    """The folder's path in the file system of the machines; None where only Spark reaches it."""
    uri = store_of(spark, folder)[1].toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def put_files(folder: str):
    """For ``mapInArrow``: rows ``(group, object, body)`` that lie in order of their object go
    to a file for each object. Files appear whole, under a name that a rerun task uses again."""
    def run(batches):
        part = f"part-{TaskContext.get().partitionId():05d}.txt"
        draft = f".{uuid.uuid4().hex}-{part}"
        place, file = None, None
        for batch in batches:
            for group, name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                below = f"{folder}/group={group}/object={escaped(name)}"
                if below != place:
                    if file:
                        file.close()
                        os.replace(f"{place}/{draft}", f"{place}/{part}")
                    os.makedirs(below, exist_ok=True)
                    place, file = below, open(f"{below}/{draft}", "wb")
                file.write((body or b"") + b"\n")
        if file:
            file.close()
            os.replace(f"{place}/{draft}", f"{place}/{part}")
        return iter(())
    return run


def escaped(name: str | None) -> str:
    """The name of a value's folder, as Spark's writers spell it."""
    return re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda x: f"%{ord(x[0]):02X}",
                  name) if name else "__HIVE_DEFAULT_PARTITION__"


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Settings of the session that hold inside a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_objects(objects: DataFrame, folder: str) -> None:
    """Store ``(version, key, body)``: a file below a folder that bears the object's name.

    A file takes a fixed time whatever its size, so objects are dealt to tasks by their number
    and not by their bytes, and each task puts its own files in place (a rerun task writes the
    same names again). Hadoop's local file system starts several processes for each file it
    makes, to set rights; in a mounted folder the tasks write files themselves instead. The
    folders of objects lie in groups that can be listed one by one.
    """
    spark = objects.sparkSession
    n = objects.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // OBJECTS_A_TASK))
    groups = max(1, -(-n // OBJECTS_A_GROUP))
    name = names.local_object_name(F.col("version"), F.col("key"))
    rows = (objects.select(name.alias("object"), F.col("body").alias("value"))
            .withColumn("group", F.pmod(F.xxhash64("object"), F.lit(groups)))
            .repartition(tasks, "object"))
    store, path = store_of(spark, folder)
    store.delete(path, True)
    store.mkdirs(path)
    local = mounted(spark, folder)
    if local is None:
        (rows.write.mode("overwrite")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
         .partitionBy("group", "object").text(folder))
        return
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}):
        (rows.sortWithinPartitions("object")
         .select("group", "object", F.col("value").cast("binary"))
         .mapInArrow(put_files(local), "n long").write.format("noop").mode("overwrite").save())


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The listing of what ``write_objects`` wrote, by the folder that names each object.

    Groups are listed one after another and their rows written, so that the driver holds the
    files of one group; tasks list and look up many files each, as no content is read.
    """
    store, path = store_of(spark, folder)
    found = [x.getPath() for x in store.listStatus(path)]
    groups = sorted(x.toString() for x in found if x.getName().startswith("group="))
    name = F.regexp_extract("path", rf"object=({names.LOCAL_PREFIX}\d+_[^/]*)/", 1)
    version = F.regexp_extract(F.col("name"), rf"^{names.LOCAL_PREFIX}(\d+)_", 1).cast("int")
    rows = scratch_folder(spark, "listing")
    with settings(spark, {
            "spark.sql.sources.parallelPartitionDiscovery.parallelism":
                4 * spark.sparkContext.defaultParallelism,
            "spark.sql.files.openCostInBytes": "64k"}):
        for group in groups:
            files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                     .option("pathGlobFilter", "part-*").schema(OBJECTS).load(group))
            (files.select(name.alias("name"), "length").withColumn("version", version)
             .groupBy("version", "name").agg(F.sum("length").alias("length"))
             .withColumn("key", names.key_from_name(F.col("name")))
             .write.mode("append").parquet(rows))
    schema = "version int, name string, length bigint, key string"
    return spark.read.schema(schema).parquet(rows) if groups else spark.createDataFrame([], schema)

"""Federated averaging over parameter tables.

Parameters are a long table ``(version, layer, pos, value)``; a client update
is the same with ``client_id`` and ``content_hash``. Averaging is a grouped
aggregation on ``(version, layer, pos)``: Spark combines partial sums on the
map side, so the shuffle carries one row per key per map task, never a whole
model, and no model ever reaches the driver.

Per-client weights join on ``(version, content_hash)`` without a broadcast
hint: AQE broadcasts that side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAM_KEYS = ["version", "layer", "pos"]
UPDATE_KEYS = ["version", "content_hash"]


def explode_vector(df: DataFrame, vector: str, layer: str, keep: list[str]) -> DataFrame:
    """Array column -> one row per element: ``(keep..., layer, pos, value)``."""
    return df.select(*keep, F.lit(layer).alias("layer"),
                     F.posexplode(vector).alias("pos", "value")) \
        .withColumn("value", F.col("value").cast("double"))


def distinct_objects(uploads: DataFrame, content: str) -> DataFrame:
    """one stored object per ``(version, content_hash)``, with its number of uploads.

    Averaging reads objects, never uploads: identical content counts once.
    """
    return uploads.groupBy(*UPDATE_KEYS).agg(F.any_value(content).alias(content),
                                             F.count("*").alias("n_uploads"))


def weighed_objects(uploads: DataFrame, content: str, order_col: str = "upload_seq"
                    ) -> DataFrame:
    """F07 + A13 + J01 where content and weight come in the same record: one aggregation
    gives each stored object, its number of uploads and the size of its last upload."""
    return uploads.groupBy(*UPDATE_KEYS).agg(
        F.any_value(content).alias(content), F.count("*").alias("n_uploads"),
        F.max_by("sample_size", order_col).alias("sample_size"))


def with_model_count(objects: DataFrame) -> DataFrame:
    """Objects (not yet exploded) with ``n_models``, the objects of their version."""
    counts = objects.groupBy("version").agg(F.count("*").alias("n_models"))
    return objects.join(counts, "version")


def scale(updates: DataFrame, weight: Column, divisor: Column) -> DataFrame:
    """every parameter times ``weight / divisor`` (column ``scaled``)."""
    return updates.withColumn("scaled", F.col("value") * weight / divisor)


def sum_models(scaled: DataFrame, keys: list[str] | None = None,
               col: str = "scaled", out: str = "value") -> DataFrame:
    """element-wise sum of models, layer by layer."""
    return scaled.groupBy(*(keys or PARAM_KEYS)).agg(F.sum(col).alias(out))


def uniform_mean(params: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``algo='mean'``, every distinct object weighs 1 (``params``: of objects)."""
    return params.groupBy(*(keys or PARAM_KEYS)).agg(F.avg("value").alias("value"))


def weighted_mean(params: DataFrame, keys: list[str] | None = None,
                  weight: str = "sample_size") -> DataFrame:
    """``algo='wmean'``, ``sum(value * n) / sum(n)`` per parameter.

    ``params`` are the parameters of distinct objects and carry the weight, which
    ``join_weights`` put beside each object before it was exploded.
    """
    return params.groupBy(*(keys or PARAM_KEYS)).agg(
        (F.sum(F.col("value") * F.col(weight)) / F.sum(weight)).alias("value"))


def both_orders(params: DataFrame, tol: float = 1e-9) -> DataFrame:
    """divide-then-add and add-then-divide of each parameter, and whether they agree.

    ``params`` carry ``n_models``; both orders come from one aggregation.
    """
    both = params.groupBy(*PARAM_KEYS).agg(
        F.sum(F.col("value") / F.col("n_models")).alias("divide_then_add"),
        (F.sum("value") / F.max("n_models")).alias("add_then_divide"))
    return both.withColumn(
        "agree", F.abs(F.col("divide_then_add") - F.col("add_then_divide")) <= tol)


def ranked(rows: DataFrame, partition: list[str], order: str, digits: int = 4) -> DataFrame:
    """The rows with ``rank`` (from 0) in the order of a hexadecimal column per partition.

    Two levels: the partition's counts by the first digits of the order are prefix-summed
    (at most 16 ** digits rows a partition), and ``row_number`` runs inside one such bucket.
    """
    rows = rows.withColumn("_b", F.substring(order, 1, digits))
    counts = rows.groupBy(*partition, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*partition).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*partition, "_b",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*partition, "_b").orderBy(order)
    return (rows.join(starts, [*partition, "_b"])
            .withColumn("rank", F.col("_first") + F.row_number().over(inside) - 1)
            .drop("_b", "_first"))


def cohorts(objects: DataFrame, sizes: list[int], order: str = "content_hash") -> DataFrame:
    """all objects of each version, dealt in turn into cohorts of the given sizes.

    After the last size the first one follows again; the last cohort of a version may be
    smaller.
    """
    place = F.col("rank") % sum(sizes)
    number, end = F.lit(0), 0
    for n in sizes[:-1]:
        end += n
        number = number + (place >= end).cast("int")
    turn = F.floor(F.col("rank") / sum(sizes)) * len(sizes)
    return (ranked(objects, ["version"], order)
            .withColumn("cohort", (turn + number).cast("int")).drop("rank"))


def last_write_wins(records: DataFrame, keys: list[str], order_col: str,
                    value_col: str) -> DataFrame:
    """Keyed upsert, the value of the latest record per key (``max_by``)."""
    return records.groupBy(*keys).agg(F.max_by(value_col, order_col).alias(value_col))


def shares(weights: DataFrame, group: str = "version", value: str = "sample_size",
           out: str = "share") -> DataFrame:
    """``n / sum(n)`` within a group.

    The group totals are an aggregation joined back, not a window: a window
    would put a hot group into one task.
    """
    totals = weights.groupBy(group).agg(F.sum(value).alias("_total"))
    return (weights.join(totals, group)
            .withColumn(out, F.col(value) / F.col("_total")).drop("_total"))


def join_weights(objects: DataFrame, weights: DataFrame, order_col: str = "upload_seq"
                 ) -> DataFrame:
    """Each stored object with its recorded weight (inner equi-join).

    A key recorded several times has the weight of its last record, so the join
    never multiplies objects.
    """
    last = last_write_wins(weights, UPDATE_KEYS, order_col, "sample_size")
    return objects.join(last, UPDATE_KEYS, "inner")


def weight_gaps(objects: DataFrame, weights: DataFrame) -> DataFrame:
    """Objects without a weight and weights without an object."""
    keys_o = objects.select(*UPDATE_KEYS).distinct()
    keys_w = weights.select(*UPDATE_KEYS).distinct()
    return (keys_o.join(keys_w, UPDATE_KEYS, "left_anti").withColumn("gap", F.lit("no_weight"))
            .unionByName(keys_w.join(keys_o, UPDATE_KEYS, "left_anti")
                         .withColumn("gap", F.lit("no_object"))))


def assemble(averaged: DataFrame, base: DataFrame, new_version: Column | int,
             averaged_layers: list[str]) -> DataFrame:
    """published model = averaged layers + every other layer of the base.

    ``base`` is the starting version's parameter table; layers not averaged
    (integer or constant entries) are carried over unchanged.
    """
    v = F.lit(new_version) if isinstance(new_version, int) else new_version
    avg = averaged.select(v.cast("int").alias("version"), "layer", "pos", "value")
    carried = (base.filter(~F.col("layer").isin(*averaged_layers))
               .select(v.cast("int").alias("version"), "layer", "pos", "value"))
    return avg.unionByName(carried)

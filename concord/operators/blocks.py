"""Models as vector blocks (F01-F04, D7): ``(layer, block_id, values)``.

A model of n numbers is ceil(n / size) rows instead of n; the last block of a layer may
be shorter. Blocks of equal key are averaged by ``Summarizer``, whose partial sums are
combined on the map side, so a shuffle carries one block per key and map task and no
model is collected.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def to_blocks(models: DataFrame, vector: str, layer: str, keep: list[str], size: int = BLOCK
              ) -> DataFrame:
    """``(keep..., layer, block_id, values array<double>)`` of one array column."""
    n = F.size(vector)
    cut = F.transform(F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1),
                      lambda i: F.slice(vector, i * size + 1, F.lit(size)).cast("array<double>"))
    return models.filter(n > 0).select(*keep, F.lit(layer).alias("layer"),
                                       F.posexplode(cut).alias("block_id", "values"))


def blocks_of_params(params: DataFrame, keep: list[str], size: int = BLOCK) -> DataFrame:
    """Blocks of a parameter table ``(keep..., layer, pos, value)`` with all positions."""
    block = F.floor(F.col("pos") / size).cast("int")
    entries = F.array_sort(F.collect_list(F.struct("pos", "value")))  # at most ``size`` of them
    return params.groupBy(*keep, "layer", block.alias("block_id")).agg(
        F.transform(entries, lambda e: e["value"]).alias("values"))


def to_params(blocks: DataFrame, keep: list[str], size: int = BLOCK) -> DataFrame:
    """The parameter table ``(keep..., layer, pos, value)`` of blocks of ``size`` numbers."""
    return blocks.select(*keep, "layer", "block_id", F.posexplode("values").alias("_p", "value")) \
        .select(*keep, "layer", (F.col("block_id") * size + F.col("_p")).alias("pos"), "value")


def scale(blocks: DataFrame, weight, divisor) -> DataFrame:
    """every block times ``weight / divisor`` (column ``scaled``)."""
    factor = (weight / divisor).cast("double")
    return blocks.withColumn("_f", factor).withColumn(
        "scaled", F.transform("values", lambda x: x * F.col("_f"))).drop("_f")


def sum_blocks(blocks: DataFrame, keys: list[str], col: str = "scaled") -> DataFrame:
    """element-wise sum per (keys, layer, block)."""
    return blocks.groupBy(*keys, "layer", "block_id").agg(
        vector_to_array(Summarizer.sum(array_to_vector(col))).alias("values"))


def mean_blocks(blocks: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Element-wise mean per (keys, layer, block), weighted by a column > 0."""
    values = array_to_vector("values")
    mean = Summarizer.mean(values, F.col(weight).cast("double")) if weight else \
        Summarizer.mean(values)
    return blocks.groupBy(*keys, "layer", "block_id").agg(vector_to_array(mean).alias("values"))

"""Custom local training (M03): minibatch epochs of each client from the global parameters.

Rows of a client are dealt by a hash of their text into shards of bounded size, so no
client, however large, is one task; a shard runs its epochs in ``applyInPandas`` and gives
the change of the weights it touched. Client models are the means of their shards weighted
by rows, and the new global model is the mean of the clients weighted by rows, which is
one weighted mean over all shards: ``global + sum(n * delta) / sum(n)``.

The model that a task starts from is one array of ``n_buckets + 1`` numbers, a size fixed
by the model's parameter and not by the data, sent to all tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.operators import model as M

SHARD_ROWS = 2000
BATCH = 16
RATE = 60.0
#: The bias moves by this share of a step: features of a text have length 1 together, a bias
#: of full steps would swing with the classes of the last batches.
BIAS_SHARE = 0.01
DELTAS = "client string, shard int, layer string, pos int, delta double, n_rows long"


def dealt(feats: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows with ``shard``: each client's rows in parts of about ``shard_rows``."""
    counts = feats.groupBy("client").agg(
        F.ceil(F.count("*") / shard_rows).cast("int").alias("_n"))
    shard = F.pmod(F.xxhash64("split_key", "objectionable"), F.col("_n")).cast("int")
    return feats.join(counts, "client").withColumn("shard", shard).drop("_n")


def epochs_of_shard(start: np.ndarray, labels: np.ndarray, buckets: list, xs: list, epochs: int,
                    batch: int, rate: float) -> np.ndarray:
    """The weights (bias last) after minibatch steps over the rows in their order.

    The classes of the shard weigh the same: a row of class k counts n / (2 n_k).
    """
    w = start.copy()
    n, ones = len(labels), labels.sum()
    share = np.where(labels == 1, n / (2 * max(ones, 1)), n / (2 * max(n - ones, 1)))
    for _ in range(epochs):
        for i in range(0, n, batch):
            part = range(i, min(i + batch, n))
            size = np.array([len(buckets[k]) for k in part])
            row = np.repeat(np.arange(len(size)), size)
            at = np.concatenate([np.asarray(buckets[k], np.int64) for k in part])
            x = np.concatenate([np.asarray(xs[k], float) for k in part])
            z = w[-1] + np.bincount(row, x * w[at], len(size))
            off = (1 / (1 + np.exp(-z)) - labels[i:i + batch]) * share[i:i + batch]
            step = rate / len(size)
            np.subtract.at(w, at, step * x * off[row])
            w[-1] -= step * BIAS_SHARE * off.sum()
    return w


def local_epochs(feats: DataFrame, params: DataFrame, epochs: int = 1, batch: int = BATCH,
                 rate: float = RATE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(client, shard, layer, pos, delta, n_rows): what local training changes.

    ``feats``: (client, split_key, objectionable, features). Rows of a shard are taken in the
    order of (split_key, objectionable). Weights that do not change give no row, the bias
    always gives one.
    """
    spark = feats.sparkSession
    start = np.array(M.weight_arrays(params, []).first()["w"], float)
    model = spark.sparkContext.broadcast(start)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["split_key", "objectionable"], ignore_index=True)
        w = epochs_of_shard(model.value, rows["objectionable"].to_numpy(), rows["buckets"].tolist(),
                            rows["xs"].tolist(), epochs, batch, rate)
        delta = w - model.value
        at = np.append(np.flatnonzero(delta[:-1]), len(delta) - 1)
        bias = at == len(delta) - 1
        return pd.DataFrame({"client": key[0], "shard": key[1],
                             "layer": np.where(bias, "bias", "weight"),
                             "pos": np.where(bias, 0, at), "delta": delta[at],
                             "n_rows": len(rows)})

    flat = dealt(feats, shard_rows).select(
        "client", "shard", "split_key", "objectionable",
        F.col("features.bucket").alias("buckets"), F.col("features.x").alias("xs"))
    return flat.groupBy("client", "shard").applyInPandas(run, DELTAS)


def client_models(deltas: DataFrame) -> DataFrame:
    """(client, layer, pos, delta, n_rows): the shards of a client merged by their rows."""
    total = deltas.filter("layer = 'bias'").groupBy("client").agg(F.sum("n_rows").alias("n_rows"))
    sums = deltas.groupBy("client", "layer", "pos").agg(
        F.sum(F.col("delta") * F.col("n_rows")).alias("s"))
    return sums.join(total, "client").select(
        "client", "layer", "pos", (F.col("s") / F.col("n_rows")).alias("delta"), "n_rows")


def merged(params: DataFrame, deltas: DataFrame, new_version: int) -> DataFrame:
    """The parameters of ``new_version``: the base plus the clients' mean change by rows.

    The deltas are read once, as reading them is the training: each shard gives one bias row,
    so the bias has the sum of all rows, and passes it to the other sums (a model of them).
    """
    sums = deltas.groupBy("layer", "pos").agg(
        F.sum(F.col("delta") * F.col("n_rows")).alias("s"), F.sum("n_rows").alias("n"))
    change = sums.withColumn("total", F.max(F.when(F.col("layer") == "bias", F.col("n"))).over(
        Window.partitionBy()))
    value = F.col("value") + F.coalesce(F.col("s") / F.col("total"), F.lit(0.0))
    return params.join(change, ["layer", "pos"], "left").select(
        F.lit(new_version).alias("version"), "layer", "pos", value.alias("value"))

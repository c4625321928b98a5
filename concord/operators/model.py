"""Text classifier on Spark: hashed token features and a logistic model.

The model is a parameter table ``(version, layer, pos, value)`` with layers
``weight`` (pos 0..n_buckets-1), ``bias`` (pos 0) and constant entries
``n_buckets`` and ``lr`` that averaging carries over unchanged.

Features: tokens = ``split(lower(text), '[^\\p{L}]+')`` without empties;
bucket = first 8 hex digits of md5(token) mod n_buckets; ``ln(1 + count)`` of each
bucket of a text, scaled to Euclidean length 1. They are computed inside the row (sorted
buckets cut into runs), so featurising needs no shuffle. Scoring is row-local,
too: the weights are one array of n_buckets + 1 numbers, a scalar subquery whose
size is that of the model. Only a gradient shuffles: one sum per (group, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N_BUCKETS = 4096
LEARNING_RATE = 5.0
TOKEN_SPLIT = r"[^\p{L}]+"
FLOAT_LAYERS = ("weight", "bias")


def token_bucket(token: Column, n_buckets: int) -> Column:
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % n_buckets).cast("int")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a transform of one element)."""
    return F.transform(F.array(value), body)[0]


def run_lengths(ordered: Column) -> Column:
    """``array<struct<bucket, n>>`` of a sorted array."""
    def counted(b: Column) -> Column:
        last = F.filter(F.sequence(F.lit(1), F.size(b)),
                        lambda i: (i == F.size(b)) | (F.get(b, i) != F.get(b, i - 1)))
        return bind(last, lambda e: F.transform(e, lambda end, k: F.struct(
            F.get(b, end - 1).alias("bucket"),
            (end - F.coalesce(F.get(e, k - 1), F.lit(0))).alias("n"))))
    return F.when(F.size(ordered) > 0, bind(ordered, counted))


def hashed_features(df: DataFrame, carry: list[str], text: str = "text",
                    n_buckets: int = N_BUCKETS) -> DataFrame:
    """``(carry..., n_tokens, features array<struct<bucket int, x double>>)``.

    NULL and token-free texts have no features and ``n_tokens`` 0. A text is split, hashed and
    sorted once: each step is bound before it is used, and the row's result is generated.
    """
    def norm(c: Column) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, e: s + F.pow(F.log1p(e["n"]), 2.0)))

    def scaled(c: Column) -> Column:
        return bind(norm(c), lambda z: F.transform(c, lambda e: F.struct(
            e["bucket"].alias("bucket"), (F.log1p(e["n"]) / z).alias("x"))))

    none = F.array().cast("array<struct<bucket:int,x:double>>")

    def featurised(t: Column) -> Column:
        buckets = F.sort_array(F.transform(t, lambda x: token_bucket(x, n_buckets)))
        features = bind(buckets, lambda b: bind(run_lengths(b), scaled))
        return F.struct(F.coalesce(F.size(t), F.lit(0)).cast("bigint").alias("n_tokens"),
                        F.coalesce(features, none).alias("features"))

    tokens = F.array_remove(F.split(F.lower(F.col(text)), TOKEN_SPLIT), "")
    return df.select(*carry, F.inline(F.array(bind(tokens, featurised))))


def initial_params(spark, version: int = 0, n_buckets: int = N_BUCKETS,
                   lr: float = LEARNING_RATE) -> DataFrame:
    """Zero model of ``n_buckets`` weights, a bias and its constant entries.

    Built with ``spark.range`` so the table is distributed like any other;
    its size is the model size.
    """
    w = spark.range(n_buckets).select(
        F.lit(version).alias("version"), F.lit("weight").alias("layer"),
        F.col("id").cast("int").alias("pos"), F.lit(0.0).alias("value"))
    rest = spark.range(1).select(
        F.lit(version).alias("version"),
        F.explode(F.array(
            F.struct(F.lit("bias").alias("layer"), F.lit(0.0).alias("value")),
            F.struct(F.lit("n_buckets").alias("layer"), F.lit(float(n_buckets)).alias("value")),
            F.struct(F.lit("lr").alias("layer"), F.lit(float(lr)).alias("value")))).alias("e"))
    rest = rest.select("version", "e.layer", F.lit(0).alias("pos"), "e.value")
    return w.unionByName(rest)


def weight_arrays(params: DataFrame, model_key: list[str]) -> DataFrame:
    """``(model_key..., w)``: per model its weights by bucket, then the bias (one row)."""
    at = F.when(F.col("layer") == "bias", F.lit(1 << 30)).otherwise(F.col("pos"))
    entries = F.array_sort(F.collect_list(F.struct(at.alias("at"), "value")))
    return (params.filter(F.col("layer").isin(*FLOAT_LAYERS)).groupBy(*model_key)
            .agg(F.transform(entries, lambda e: e["value"]).alias("w")))


def logit(features: Column, w: Column) -> Column:
    """``bias + sum(x * w[bucket])`` inside the row."""
    return F.aggregate(features, F.element_at(w, -1),
                       lambda z, f: z + f["x"] * F.get(w, f["bucket"]))


def argmax(logits: Column) -> Column:
    """Index of the largest logit of an array, the lowest index on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def score(feats: DataFrame, params: DataFrame, model_key: list[str] | None = None) -> DataFrame:
    """M04 + O02: the rows with ``z``, two-class ``logits`` ``[0, z]`` and ``prediction``.

    One model is a scalar subquery. With ``model_key`` the rows name their model
    and join the arrays (one row per model) on it.
    """
    if model_key:
        rows = feats.join(weight_arrays(params, model_key), model_key)
    else:
        rows = feats.withColumn("w", weight_arrays(params, []).scalar())
    scored = rows.withColumn("z", logit(F.col("features"), F.col("w"))).drop("w")
    scored = scored.withColumn("logits", F.array(F.lit(0.0), F.col("z")))
    return scored.withColumn("prediction", argmax(F.col("logits")))


def local_step(feats: DataFrame, params: DataFrame, label: str, group: list[str],
               lr: float = LEARNING_RATE) -> DataFrame:
    """One full-batch gradient step of the logistic loss per group.

    Returns sparse rows ``(group..., layer, pos, delta, sample_size, x0, x1, n0, n1)``.
    The classes of a group weigh the same: ``delta = -lr / 2 * (mean over class 1 +
    mean over class 0)`` of ``(sigmoid(z) - y) * x``; a class without rows adds
    nothing. ``x0`` and ``x1`` are the feature sums of the classes (for the centre
    that places the bias), ``n0`` and ``n1`` the group's rows of each class. Rows
    are scored in place and exploded once; the one shuffle is the sum per
    (group, bucket), combined map-side. The bias is the feature 1 of bucket -1.
    """
    y = F.col(label)
    rows = score(feats, params).select(
        *group, y.alias("_y"), (1.0 / (1.0 + F.exp(-F.col("z"))) - y).alias("_r"),
        F.inline(F.concat("features", F.array(F.struct(F.lit(-1).alias("bucket"),
                                                       F.lit(1.0).alias("x"))))))
    of = lambda k, v: F.coalesce(F.sum(F.when(F.col("_y") == k, v)), F.lit(0.0))
    sums = rows.groupBy(*group, "bucket").agg(*(
        e for k in (0, 1) for e in (of(k, F.col("_r") * F.col("x")).alias(f"g{k}"),
                                    of(k, F.col("x")).alias(f"x{k}"))))
    of_group = Window.partitionBy(*group)  # at most n_buckets + 1 rows of a group
    size = lambda k: F.max(F.when(F.col("bucket") == -1, F.col(f"x{k}"))).over(of_group)
    sums = sums.withColumns({f"n{k}": size(k).cast("bigint") for k in (0, 1)})
    mean = lambda k: F.when(F.col(f"n{k}") > 0, F.col(f"g{k}") / F.col(f"n{k}")) \
        .otherwise(F.lit(0.0))
    bias = F.col("bucket") == -1
    return sums.select(
        *group, F.when(bias, F.lit("bias")).otherwise(F.lit("weight")).alias("layer"),
        F.when(bias, F.lit(0)).otherwise(F.col("bucket")).alias("pos"),
        (-lr / 2 * (mean(1) + mean(0))).alias("delta"),
        (F.col("n0") + F.col("n1")).alias("sample_size"), "x0", "x1", "n0", "n1")


def merged(params: DataFrame, deltas: DataFrame, new_version: int, algo: str = "wmean"
           ) -> DataFrame:
    """Float layers of ``new_version``: the (weighted) mean of the client models.

    Every client model is ``global + delta_c``; their mean is ``global + sum(w_c *
    delta_c) / sum(w_c)`` over all clients, where an untouched weight has a zero
    delta. ``wmean`` weighs by sample size (F04), ``mean`` weighs every client 1
    (F03). The bias puts the boundary half-way between the mean scores of the two
    classes of all clients: ``-w . (mean x of class 1 + mean x of class 0) / 2``.
    All rows of the model meet in one row of arrays, whose size is the model's.
    """
    w = F.col("sample_size").cast("double") if algo == "wmean" else F.lit(1.0)
    none = F.lit(0.0)
    d = deltas.select("layer", "pos", (F.col("delta") * w).alias("s"), w.alias("w"), "x0", "x1",
                      none.alias("value"))
    p = params.filter(F.col("layer").isin(*FLOAT_LAYERS)).select(
        "layer", "pos", none.alias("s"), none.alias("w"), none.alias("x0"), none.alias("x1"),
        "value")
    sums = d.unionByName(p).groupBy("layer", "pos").agg(
        *(F.sum(c).alias(c) for c in ("s", "w", "x0", "x1", "value")))
    # the bias sorts first; with one row per client it holds the total weight and class sizes
    row = sums.groupBy().agg(F.array_sort(F.collect_list(F.struct(
        "layer", "pos", "s", "w", "x0", "x1", "value"))).alias("m"))
    total = F.get("m", F.lit(0))
    part = lambda a, b: F.when(b > 0, a / b).otherwise(none)
    weights = row.select(F.transform(
        F.filter("m", lambda e: e["layer"] == "weight"), lambda e: F.struct(
            F.lit("weight").alias("layer"), e["pos"].alias("pos"),
            (e["value"] + part(e["s"], total["w"])).alias("value"),
            ((part(e["x0"], total["x0"]) + part(e["x1"], total["x1"])) / 2).alias("centre")))
        .alias("m"))
    bias = F.struct(F.lit("bias").alias("layer"), F.lit(0).alias("pos"), F.aggregate(
        "m", none, lambda z, e: z - e["value"] * e["centre"]).alias("value"),
        none.alias("centre"))
    return (weights.select(F.inline(F.concat(F.array(bias), "m")))
            .select(F.lit(new_version).alias("version"), "layer", "pos", "value"))

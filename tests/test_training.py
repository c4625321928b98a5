"""Local minibatch training against plain Python, and the ML pipeline after a reload."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.operators import evaluate as E
from concord.operators import ml_model as ML
from concord.operators import model as M
from concord.operators import trainer as LT
from concord.plans import round_job

SCHEMA = ("client string, split_key string, objectionable int, "
          "features array<struct<bucket:int,x:double>>")
BUCKETS = 12


def rows(n=90, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        y = int(r.random() < 0.3)
        at = sorted(r.sample(range(BUCKETS), r.randrange(0, 5)))
        out.append(("big" if i % 3 else "small", f"{r.random():.9f}", y,
                    [(b, r.random() + (0.5 if b < 3 and y else 0)) for b in at]))
    return out


def plain(part, w, epochs, batch, rate):
    """Minibatch steps row by row on a list of weights, the bias last."""
    w = list(w)
    part = sorted(part, key=lambda x: (x[1], x[2]))
    n, ones = len(part), sum(x[2] for x in part)
    for _ in range(epochs):
        for i in range(0, n, batch):
            now = part[i:i + batch]
            step = [0.0] * len(w)
            for _, _, y, f in now:
                z = w[-1] + sum(w[b] * x for b, x in f)
                off = (1 / (1 + math.exp(-z)) - y) * n / (2 * (ones if y else n - ones))
                for b, x in f:
                    step[b] += off * x
                step[-1] += off * LT.BIAS_SHARE
            w = [a - rate * s / len(now) for a, s in zip(w, step, strict=True)]
    return w


@pytest.mark.parametrize("shard_rows,epochs,batch", [(1000, 1, 8), (20, 2, 7)])
def test_local_epochs_equal_plain_python(spark, shard_rows, epochs, batch):
    data = rows()
    feats = spark.createDataFrame(data, SCHEMA)
    start = [0.1 * math.sin(i) for i in range(BUCKETS + 1)]
    params = M.initial_params(spark, 3, BUCKETS).withColumn("value", F.when(
        F.col("layer") == "weight", F.sin("pos") * 0.1).when(
        F.col("layer") == "bias", F.lit(start[-1])).otherwise(F.col("value")))
    shards = {}
    for r in LT.dealt(feats, shard_rows).collect():
        shards.setdefault((r.client, r.shard), []).append(
            (r.client, r.split_key, r.objectionable, [(f.bucket, f.x) for f in r.features]))
    if shard_rows == 20:
        assert len(shards) >= 4 and max(map(len, shards.values())) < 40
    deltas = LT.local_epochs(feats, params, epochs, batch, 1.5, shard_rows)
    new = {(r.layer, r.pos): r.value for r in LT.merged(params, deltas, 4).collect()}
    want = [0.0] * (BUCKETS + 1)
    for part in shards.values():
        done = plain(part, start, epochs, batch, 1.5)
        want = [a + (d - s) * len(part) / len(data) for a, d, s in zip(want, done, start, strict=True)]
    for i in range(BUCKETS):
        assert abs(new["weight", i] - start[i] - want[i]) < 1e-9
    assert abs(new["bias", 0] - start[-1] - want[-1]) < 1e-9
    assert new["n_buckets", 0] == BUCKETS and len(new) == BUCKETS + 3
    by_client = {(r.client, r.layer, r.pos): (r.delta, r.n_rows)
                 for r in LT.client_models(deltas).collect()}
    assert by_client["big", "bias", 0][1] == 60 and by_client["small", "bias", 0][1] == 30


def test_one_class_and_no_features(spark):
    feats = spark.createDataFrame([("a", "1", 1, []), ("a", "2", 1, [])], SCHEMA)
    deltas = LT.local_epochs(feats, M.initial_params(spark, 0, BUCKETS), batch=2, rate=1.0).collect()
    assert [(d.layer, d.n_rows) for d in deltas] == [("bias", 2)] and abs(deltas[0].delta - 0.0025) < 1e-12


def test_minibatch_rounds_find_the_rare_class(spark):
    """At sf0.1 more of the objectionable texts are found than others are called so."""
    sf = "/root/testdata/sf0.1"
    feats = round_job.written_features(spark, sf)
    scores = M.score(feats, round_job.local_training(spark, sf, feats=feats))
    conf = {(r.split, r.label, r.prediction): r.n
            for r in E.confusion(scores, "objectionable", ["split"]).collect()}
    for split in ("val", "test"):
        n = lambda y, p: conf.get((split, y, p), 0)
        recall, false = n(1, 1) / (n(1, 1) + n(1, 0)), n(0, 1) / (n(0, 1) + n(0, 0))
        assert recall > 2 * false and recall > 0.3


def test_pipeline_scores_the_same_after_a_reload(spark, tmp_dir):
    r = random.Random(2)
    data = [(i, f"{r.choice(['good', 'fine'])} {r.choice('abc')} text" if i % 4 else
             f"awful {r.choice('abc')} words", int(i % 4 == 0)) for i in range(80)]
    data += [(100, None, 0), (101, "", 0)]
    df = spark.createDataFrame(data, "id int, text string, objectionable int")
    base, settings = ML.train(df, n_buckets=64, max_iter=5)
    model, settings = ML.train_further(base, settings, df, max_iter=8)
    before = {x.id: (x.logits, x.prediction) for x in ML.score(df, model, settings).collect()}
    for _ in range(2):  # saved again, it replaces the first
        ML.save(model, settings, tmp_dir, spark)
    loaded, kept = ML.load(spark, tmp_dir)
    after = {x.id: (x.logits, x.prediction) for x in ML.score(df, loaded, kept).collect()}
    assert after == before and kept == settings and kept["generation"] == 1
    assert all(p == y for i, _, y in data[:80] for p in [after[i][1]])
    # the new model starts from the base: its last weight is that of the base's margin
    weights = loaded.stages[-1].coefficients.toArray()
    assert len(weights) == 65 and weights[-1] > 0
    assert np.isfinite([v for logits, _ in after.values() for v in logits]).all()


def test_merging_trains_each_shard_once(spark):
    feats = spark.createDataFrame(rows(), SCHEMA)
    params = M.initial_params(spark, 0, BUCKETS)
    plan = LT.merged(params, LT.local_epochs(feats, params), 1)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("FlatMapGroupsInPandas") == 1


def test_training_rows_are_not_dealt_by_class(spark):
    """Two classes: rows shuffled by class would be two tasks, whatever the size."""
    data = spark.createDataFrame([(f"word{k} text", k % 2) for k in range(40)],
                                 "text string, objectionable int").repartition(7)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as for tables over the threshold
    try:
        got = ML.balanced(data).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(name, before)
    assert len({r.p for r in got}) > 2
    assert {r.weight for r in got} == {1 / 20}

import math
import os
import random
import re
import hashlib
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from concord.operators import evaluate as E
from concord.operators import model as M
from concord.operators import rounds as RD
from concord.plans import round_job, rounds_job
from concord.sources import tables
from table_paths import SF001


def test_two_level_running_sum_equals_plain_window(spark):
    rnd = random.Random(7)
    t0 = datetime(2024, 1, 1)
    rows = [(rnd.randrange(3), i, t0 + timedelta(seconds=rnd.randrange(5000)),
             rnd.choice([-1, 0, 1])) for i in range(400)]
    df = spark.createDataFrame(rows, "federation_id int, event_id long, ts timestamp, delta int")
    got = RD.running_sum(df, ["federation_id"], F.col("delta"), "bal", bucket_seconds=300)
    w = (Window.partitionBy("federation_id").orderBy("ts", "event_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    exp = df.withColumn("bal", F.sum("delta").over(w).cast("bigint"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_upload_without_fetch_goes_below_zero_and_does_not_close(spark):
    t = datetime(2024, 1, 1)
    ev = spark.createDataFrame(
        [(0, t, "upload", "accepted", -1), (1, t + timedelta(seconds=1), "fetch", "accepted", 1),
         (2, t + timedelta(seconds=2), "fetch", "accepted", 1),
         (3, t + timedelta(seconds=3), "upload", "accepted", -1)],
        "event_id long, ts timestamp, op string, status string, delta int"
    ).withColumn("federation_id", F.lit(0))
    b = {r.event_id: (r.balance, r.closes, r.version) for r in RD.barrier(ev).collect()}
    assert b[0] == (-1, False, 0)
    assert b[3] == (0, True, 0)


def test_admission_statuses(spark):
    d = rounds_job.decided(spark, SF001)
    bad = d.filter(((F.col("event_id") % 5 == 0) | (F.col("event_id") % 7 == 0))
                   & (F.col("status") != "wrong_version")).count()
    assert bad == 0
    assert d.filter((F.col("status") != "accepted") & (F.col("delta") != 0)).count() == 0


def _py_features(text, n_buckets=M.N_BUCKETS):
    toks = [t for t in re.split(r"[^\w]+|[\d_]+", text.lower()) if t]
    counts = {}
    for t in toks:
        b = int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % n_buckets
        counts[b] = counts.get(b, 0) + 1
    logs = {b: math.log1p(c) for b, c in counts.items()}
    norm = sum(c * c for c in logs.values()) ** 0.5
    return {b: c / norm for b, c in logs.items()}


def test_features_match_plain_python(spark):
    texts = ["Hello, hello world!", "Ünïcode wörds and   spaces", "123 ... !!", "", "a " * 3000 + "b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: {f.bucket: f.x for f in r.features}
           for r in M.hashed_features(df, ["id"]).collect()}
    for i, t in enumerate(texts):
        exp = _py_features(t)
        assert got[i].keys() == exp.keys()
        assert all(abs(got[i][k] - exp[k]) < 1e-12 for k in exp)


def test_features_split_and_sort_a_text_once(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, None), (2, "7")], "id int, text string")
    feats = M.hashed_features(df, ["id"])
    plan = feats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("md5(") == 1 and plan.count("sort") == 1
    rows = sorted((r.id, r.n_tokens, len(r.features)) for r in feats.collect())
    assert rows == [(0, 3, 2), (1, 0, 0), (2, 0, 0)]


def test_report_zero_denominator_when_class_never_predicted(spark):
    scored = spark.createDataFrame([(0, 0, "t"), (1, 0, "t"), (1, 0, "t")],
                                   "objectionable int, prediction int, split string")
    rep = {r["class"]: r for r in E.report(scored, "objectionable", ["split"]).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1 == 0.0
    assert rep["0"].support == 1 and rep["1"].support == 2
    assert abs(rep["accuracy"].f1 - 1 / 3) < 1e-6


def test_self_average_changes_no_score(spark):
    diff = round_job.q_compare(spark, SF001).filter(F.col("pair") == "v1_self-v1")
    vals = [v for r in diff.collect() for v in (r.d_precision, r.d_recall, r.d_f1)
            if v is not None]
    assert vals and all(v == 0.0 for v in vals)


def test_repeated_rounds_publish_each_version(spark, tmp_dir):
    from concord.sources import files
    history = round_job.run_rounds(spark, SF001, 2, tmp_dir).orderBy("version").collect()
    assert [r.version for r in history] == [1, 2]
    assert all(0 <= r.val_f1 <= 1 and 0 <= r.test_f1 <= 1 and r.n_clients > 1 for r in history)
    out = files.read_params(spark, f"{tmp_dir}/params")
    assert sorted(r.version for r in out.select("version").distinct().collect()) == [0, 1, 2]
    consts = out.filter(F.col("layer") == "n_buckets").select("value").distinct().collect()
    assert [r.value for r in consts] == [float(M.N_BUCKETS)]


def test_no_held_out_text_is_trained_on(spark):
    train = round_job.client_features(spark, SF001)
    assert train.count() > 0
    held = round_job.corpus_features(spark, SF001).filter("split <> 'train'")
    assert train.join(held, "split_key", "left_semi").count() == 0
    assert train.groupBy("client", "split_key", "objectionable").count().filter(
        "count > 1").count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_both_classes_are_predicted(spark, sf):
    conf = {(r.split, r.label, r.prediction): r.n for r in round_job.q_confusion(spark, sf).collect()}
    for split in ("val", "test"):
        assert {p for s, _, p in conf if s == split} == {0, 1}
        if not sf.endswith("0.1"):
            continue  # seven documents of class 1 in a split say nothing about recall
        n = lambda label, p: conf.get((split, label, p), 0)
        assert n(1, 1) / (n(1, 1) + n(1, 0)) > 1.5 * n(0, 1) / (n(0, 1) + n(0, 0))


def test_one_shuffle_of_exploded_features(spark):
    feats = spark.createDataFrame(
        [("c", 1, [(0, 0.6), (5, 0.8)]), ("c", 0, [(5, 1.0)]), ("d", 0, [])],
        "client string, y int, features array<struct<bucket:int,x:double>>")
    d = M.local_step(feats, M.initial_params(spark, 0, 8), "y", ["client"])
    got = {(r.client, r.layer, r.pos): (r.delta, r.sample_size) for r in d.collect()}
    assert got["c", "bias", 0] == (0.0, 2) and got["d", "bias", 0] == (-1.25, 1)
    assert abs(got["c", "weight", 5][0] - 2.5 * (0.8 * 0.5 - 0.5)) < 1e-12
    assert abs(got["c", "weight", 0][0] - 2.5 * 0.6 * 0.5) < 1e-12


def test_streaming_barrier_equals_batch(spark, tmp_dir):
    from concord.streaming import rounds_stream as S
    ev = (tables.events(spark, SF001).withColumn("ts", F.col("ts").cast("timestamp"))
          .toPandas().sort_values(["ts", "event_id"]))
    os.makedirs(f"{tmp_dir}/in")
    chunks = [ev.iloc[i::1][k * len(ev) // 3:(k + 1) * len(ev) // 3] for i, k in
              [(0, 0), (0, 1), (0, 2)]]
    for k, part in enumerate(chunks):
        spark.createDataFrame(part, S.EVENT_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/t{k}")
        src = [f for f in os.listdir(f"{tmp_dir}/t{k}") if f.endswith(".parquet")][0]
        dst = f"{tmp_dir}/in/{k}.parquet"
        os.link(f"{tmp_dir}/t{k}/{src}", dst)
        os.utime(dst, (1000 + k, 1000 + k))
    exp = rounds_job.q_barrier(spark, SF001)
    hist = rounds_job.q_history(spark, SF001).filter("closed").select(
        "federation_id", "version", "n_fetches", "n_uploads")
    rejected = rounds_job.q_rejects(spark, SF001)
    for checkpoint in ("ckpt", "again"):  # a new checkpoint writes the same rows again
        S.run_barrier(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/{checkpoint}")
        got = spark.read.parquet(f"{tmp_dir}/out/closed")
        g = got.select("federation_id", "event_id", "version")
        assert g.exceptAll(exp).count() == 0 and exp.exceptAll(g).count() == 0
        n = got.select("federation_id", "version", "n_fetches", "n_uploads")
        assert n.exceptAll(hist).count() == 0 and hist.exceptAll(n).count() == 0
        r = spark.read.parquet(f"{tmp_dir}/out/rejected")
        assert r.select("batch_id").distinct().count() == 3
        r = r.select(*rejected.columns)
        assert r.exceptAll(rejected).count() == 0 and rejected.exceptAll(r).count() == 0


def test_upload_stream(spark, tmp_dir):
    import json

    from concord.streaming import rounds_stream as S
    bodies = [(1, '{"model": "YWJj", "sample_size": "5"}'), (2, "broken"),
              (3, '{"model": "YWJj", "sample_size": "7"}'), (4, '{"model": "x", "sample_size": 1}')]
    os.makedirs(f"{tmp_dir}/up")
    for k, (i, b) in enumerate(bodies):
        with open(f"{tmp_dir}/up/{k}.json", "w") as f:
            f.write(json.dumps({"doc_id": i, "version": 0, "body": b}) + "\n")
    for checkpoint in ("c1", "c2"):
        S.run_uploads(spark, f"{tmp_dir}/up", f"{tmp_dir}/store", f"{tmp_dir}/{checkpoint}")
        ok = spark.read.parquet(f"{tmp_dir}/store/accepted").collect()
        bad = spark.read.parquet(f"{tmp_dir}/store/rejected").collect()
        assert sorted(r.doc_id for r in ok) == [1, 3] and sorted(r.doc_id for r in bad) == [2, 4]
        assert len({r.content_hash for r in ok}) == 1


def test_admission_compares_versions(spark):
    rows = [("fetch", 2, 2, False, False, True), ("fetch", 1, 2, False, False, True),
            ("fetch", None, 2, False, False, True), ("fetch", 2, 2, False, False, False),
            ("fetch", 2, 2, False, True, True), ("upload", 3, 2, False, False, True),
            ("upload", 2, 2, True, False, True), ("upload", 2, 2, False, False, False)]
    df = spark.createDataFrame(rows, "op string, claimed_version int, server_version int, "
                                     "merging boolean, evaluating boolean, exists boolean")
    got = [(r.status, r.delta) for r in RD.admission(df).collect()]
    assert got == [("accepted", 1), ("wrong_version", 0), ("wrong_version", 0), ("missing", 0),
                   ("busy", 0), ("wrong_version", 0), ("busy", 0), ("accepted", -1)]


def test_status_document_round_trip(spark):
    doc = '{"version":3,"merging":true,"evaluating":false,"sample_sizes":{"a":1,"b":2}}'
    df = spark.createDataFrame([(1, doc)], "id int, document string")
    new = RD.after_upload(RD.read_status(df), F.lit("b"), F.lit(9).cast("bigint"))
    back = RD.read_status(RD.write_status(new)).first()
    assert (back.version, back.merging, back.sample_sizes) == (3, True, {"a": 1, "b": 9})

"""The live round: batch fold, stream and sinks against a plain fold in Python."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from concord.operators import blocks as B
from concord.operators import live as L
from concord.operators.intervals import in_intervals
from concord.plans import live_job as J
from concord.streaming import live_stream as S

T0 = datetime(2024, 1, 1)
SCHEMA = ("federation_id int, event_id long, ts timestamp, client_id long, op string, "
          "sample_size long, claimed_version int, exists boolean, merge_us long, "
          "evaluate_us long, model_id long")


def log(seed, n=700, federations=3, versions=6, uploads=0.5):
    """A request log with equal times, empty and long merges, unknown claims."""
    r = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += r.choice([0, 0, 1, 5, 40])
        claim = None if r.random() < 0.03 else min(int(r.random() * versions * (i + 99) / n),
                                                   r.randrange(versions))
        rows.append((0 if r.random() < 0.5 else r.randrange(federations), i,
                     T0 + timedelta(seconds=t), r.randrange(9),
                     "upload" if r.random() < uploads else "fetch", r.randrange(50), claim,
                     r.random() < 0.9, r.choice([0, 0, 3, 90]) * 1_000_000,
                     r.choice([0, 2, 30]) * 1_000_000, r.randrange(500)))
    return rows


def fold(rows, first=0):
    """A plain fold; what the server would answer to each request in turn."""
    state, out = {}, []
    for fed, eid, ts, _, op, _, claim, exists, merge, evaluate, _ in sorted(
            rows, key=lambda r: (r[2], r[1])):
        s = state.setdefault(fed, {"v": first, "n": 0, "merged": None, "ready": None})
        at = int((ts - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        if s["ready"] is not None and at >= s["ready"]:
            s.update(v=s["v"] + 1, merged=None, ready=None)
        busy, closes, v = s["ready"] is not None, False, s["v"]
        merging = busy and at < s["merged"]
        status = ("wrong_version" if claim != v else "missing" if op == "fetch" and not exists
                  else "busy" if busy else "accepted")
        if status == "accepted":
            s["n"] += 1 if op == "fetch" else -1
            closes = op == "upload" and s["n"] == 0
            if closes and merge + evaluate:
                s.update(merged=at + merge, ready=at + merge + evaluate)
            elif closes:
                s["v"] += 1
        out.append((fed, eid, v, merging, busy and not merging, status, s["n"], closes))
    return sorted(out)


COLUMNS = ["federation_id", "event_id", "server_version", "merging", "evaluating", "status",
           "balance", "closes"]


def answer(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed,first,bucket,uploads", [(1, 0, 7, 0.5), (2, 0, 3600, 0.6), (3, 2, 60, 0.4)])
def test_live_equals_a_plain_fold(spark, seed, first, bucket, uploads):
    rows = log(seed, uploads=uploads)
    got = answer(L.live(spark.createDataFrame(rows, SCHEMA).repartition(3), first, bucket))
    want = fold(rows, first)
    assert got == want
    assert sum(r[-1] for r in want) > 2
    if not first:  # enough rounds for every kind of answer
        assert {r[5] for r in want} == {"accepted", "wrong_version", "missing", "busy"}


def test_many_rounds_are_reached(spark):
    """Every pair of requests closes a round: as many transitions as rounds."""
    rows = [(0, i, T0 + timedelta(seconds=i), 1, "upload" if i % 2 else "fetch", 1, i // 2, True,
             0, 0, 0) for i in range(260)]
    got = answer(L.live(spark.createDataFrame(rows, SCHEMA), bucket_seconds=30))
    assert got == fold(rows) and sum(r[-1] for r in got) == 130


def test_nothing_closes_and_no_requests(spark):
    rows = [(0, i, T0, 1, "fetch", 1, 0, True, 0, 0, 0) for i in range(5)]
    assert answer(L.live(spark.createDataFrame(rows, SCHEMA))) == fold(rows)
    assert answer(L.live(spark.createDataFrame([], SCHEMA))) == []


def test_held_requests_do_not_move_the_counter(spark):
    rows = log(1)
    judged = L.live(spark.createDataFrame(rows, SCHEMA))
    held = L.hold_offs(judged).collect()
    want = [r for r in fold(rows) if r[5] == "busy"]
    assert held and sum(r.n_fetches + r.n_uploads for r in held) == len(want)
    assert all(r.delta == 0 and r.n_merging + r.n_evaluating == r.n_fetches + r.n_uploads
               for r in held)


def test_intervals_overlap_touch_and_vanish(spark):
    spans = [("k", "a", 10, 5, 20), ("k", "a", 15, -1, 40), ("k", "b", 20, -1, 20),
             ("k", "b", 39, -1, 41), ("other", "b", 0, -1, 100), ("k", "a", 100, -1, 10)]
    points = [("k", at, seq) for seq, at in enumerate([9, 10, 10, 10, 10, 10, 10, 19, 20, 39, 40, 41])]
    inside = lambda p, kind: any(
        k == p[0] and n == kind and (lo, s) < (p[1], p[2]) and p[1] < hi for k, n, lo, s, hi in spans)
    want = sorted((*p, inside(p, "a"), inside(p, "b")) for p in points)
    for bucket in (1, 3600):
        scale = 1_000_000
        got = in_intervals(
            spark.createDataFrame([(k, at * scale, s) for k, at, s in points], "k string, at long, seq long"),
            spark.createDataFrame([(k, n, lo * scale, s, hi * scale) for k, n, lo, s, hi in spans],
                                  "k string, kind string, lo_at long, lo_seq long, hi_at long"),
            ["k"], ["a", "b"], bucket)
        assert sorted((r.k, r["at"] // scale, r.seq, r.a, r.b) for r in got.collect()) == want


def test_blocks_equal_the_long_form(spark):
    r = random.Random(3)
    models = [(v, [r.uniform(-1, 1) for _ in range(n)], r.randrange(1, 9))
              for v, n, k in ((1, 64, 5), (2, 10, 3), (3, 24, 2)) for _ in range(k)]
    df = spark.createDataFrame([*models, (4, [], 1)], "version int, x array<float>, n long")
    for size in (1, 7, 24, 4096):
        cut = B.to_blocks(df, "x", "w", ["version", "n"], size)
        assert cut.agg(F.max(F.size("values"))).first()[0] <= size
        for weight in (None, "n"):
            got = {(x.version, x.pos): x.value for x in B.to_params(
                B.mean_blocks(cut, ["version"], weight), ["version"], size).collect()}
            for v in (1, 2, 3):
                mine = [(m[1], m[2] if weight else 1) for m in models if m[0] == v]
                for pos in range(len(mine[0][0])):
                    want = sum(x[pos] * w for x, w in mine) / sum(w for _, w in mine)
                    assert abs(got.pop((v, pos)) - want) < 1e-6
            assert not got
    back = B.blocks_of_params(B.to_params(B.mean_blocks(B.to_blocks(
        df, "x", "w", ["version"], 7), ["version"]), ["version"], 7), ["version"], 7)
    assert sorted((x.version, x.block_id, len(x["values"])) for x in back.collect())[:2] == [(1, 0, 7), (1, 1, 7)]


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def write_events(spark, folder, rows, parts):
    """The events as files in the order of their time."""
    os.makedirs(folder)
    cut = [rows[k * len(rows) // parts:(k + 1) * len(rows) // parts] for k in range(parts)]
    for k, part in enumerate(cut):
        made = f"{folder}-{k}"
        spark.createDataFrame(part, EVENTS).coalesce(1).write.parquet(made)
        source = [f for f in os.listdir(made) if f.endswith(".parquet")][0]
        os.link(f"{made}/{source}", f"{folder}/{k}.parquet")
        os.utime(f"{folder}/{k}.parquet", (1000 + k, 1000 + k))


def events(seed=4, n=420):
    r = random.Random(seed)
    return [(i * 5, T0 + timedelta(minutes=4 * i), r.choice([0, 16, 32, 1, 2]),
             r.choice(["view", "click", "purchase", "signup", "error"]), 1.0,
             '{"k": %d}' % r.randrange(9)) for i in range(n)]


def tables(spark, folder):
    out = {}
    for name in S.SINKS:
        rows = spark.read.parquet(f"{folder}/{name}")
        out[name] = sorted(str(sorted(r.asDict().items())) for r in rows.collect())
    return out


def inputs(spark):
    models = spark.range(500).select(F.col("id").alias("model_id"), F.transform(
        F.sequence(F.lit(1), F.lit(30)), lambda i: F.sin(i * (F.col("id") + 1)).cast("float")).alias("values"))
    rows = spark.range(60).select(
        (F.col("id") % 3).cast("int").alias("federation_id"), F.col("id").alias("row"),
        F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.cos(i * F.col("id"))).alias("x"),
        (F.col("id") % 2).cast("int").alias("objectionable"))
    return models, rows


def test_stream_equals_batch_and_survives_failures_between_sinks(spark, tmp_dir):
    from concord.operators import rounds as RD
    from concord.sources import fixtures
    rows = events()
    batch = L.live(fixtures.live_requests(RD.round_events(spark.createDataFrame(rows, EVENTS))))
    want = answer(batch)
    assert sum(r[-1] for r in want) > 3
    models, tests = inputs(spark)
    write_events(spark, f"{tmp_dir}/three", rows, 3)
    write_events(spark, f"{tmp_dir}/two", rows, 2)
    S.run_live(spark, f"{tmp_dir}/three", models, tests, f"{tmp_dir}/clean", f"{tmp_dir}/c1")
    clean = tables(spark, f"{tmp_dir}/clean")
    assert answer(spark.read.parquet(f"{tmp_dir}/clean/requests")) == want

    # the batch form publishes the same versions with the same history
    closed = batch.filter("closes").select(*J.ROUND, F.col("event_id").alias("close_event"))
    objects = J.stored_objects(J.uploaded(batch, models))
    published = J.published(objects, closed)
    assert len(clean["history"]) == closed.count() > 3
    history = J.round_rows(objects, closed, J.evaluated(published, tests))
    assert sorted(str(sorted(r.asDict().items())) for r in history.collect()) == clean["history"]

    # a failure before each sink of the second batch, and a restart each time
    left = list(S.SINKS)

    def fail(batch_id, sink):
        if batch_id == 1 and left and sink == left[0]:
            left.pop(0)
            raise RuntimeError("lost between two sinks")

    for _ in S.SINKS:
        with pytest.raises(StreamingQueryException):
            S.run_live(spark, f"{tmp_dir}/three", models, tests, f"{tmp_dir}/broken",
                       f"{tmp_dir}/c2", before=fail)
    S.run_live(spark, f"{tmp_dir}/three", models, tests, f"{tmp_dir}/broken", f"{tmp_dir}/c2",
               before=fail)
    assert tables(spark, f"{tmp_dir}/broken") == clean

    # another split into files gives the same published versions
    S.run_live(spark, f"{tmp_dir}/two", models, tests, f"{tmp_dir}/other", f"{tmp_dir}/c3")
    other = tables(spark, f"{tmp_dir}/other")
    assert all(other[name] == clean[name] for name in ("params", "evaluations", "history"))

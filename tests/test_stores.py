"""Object files, status snapshots, sketches, and uploads counted across micro-batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from concord.operators import blocks as B
from concord.operators import corpus as C
from concord.operators import live as L
from concord.sources import objects as O
from concord.sources import status as ST
from concord.streaming import uploads_stream as US


def put(folder, name, body):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(body)


def test_object_files_are_listed_and_averaged(spark, tmp_dir):
    bodies = {"local_v3_aa.zip": b"[1, 2, 3]", "local_v3_bb.zip": b"[3.0, 4, 8]",
              "local_v30_cc.zip": b"[9, 9, 9]", "local_v3_dd.txt": b"[7, 7, 7]",
              "global_v3.zip": b"[5, 5, 5]", "local_v3_ee.zip": b"\xff broken", "notes.zip": b"x",
              "local_vx_ff.zip": b"[2, 2, 2]", "local_v4_gg.zip": b"[1]"}
    for name, body in bodies.items():
        put(tmp_dir, name, body)
    os.makedirs(f"{tmp_dir}/more")
    put(f"{tmp_dir}/more", "local_v3_aa.zip", b"[1, 2, 3]")   # the same object once more
    listed = O.listing(spark, tmp_dir, 3)
    got = sorted((r.version, r.name, r.key, r.length) for r in listed.collect())
    assert got == [(3, "local_v3_aa.zip", "aa", 9), (3, "local_v3_aa.zip", "aa", 9),
                   (3, "local_v3_bb.zip", "bb", 11), (3, "local_v3_ee.zip", "ee", 8)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    everything = O.listing(spark, tmp_dir)
    assert sorted({r.version for r in everything.collect()}) == [3, 4, 30]
    sizes = {r.version: (r.n_objects, r.mean_size) for r in O.mean_sizes(everything).collect()}
    assert sizes[3] == (4, 9.25) and sizes[30] == (1, 9.0)
    mean = B.to_params(O.averaged(spark, tmp_dir, 3, 2), ["version"], 2)
    assert sorted((r.pos, r.value) for r in mean.collect()) == [(0, 2.0), (1, 3.0), (2, 5.5)]


def test_object_files_are_written_by_many_tasks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(O, "OBJECTS_A_TASK", 10, raising=False)
    objects = (spark.range(80).groupBy((F.col("id") % 60).alias("k")).agg(F.count("*").alias("n"))
               .select(F.lit(3).alias("version"), F.col("k").cast("string").alias("key"),
                       F.col("n").cast("string").alias("body")))
    O.write_objects(objects, f"{tmp_dir}/objects")
    parts = [f for _, _, files in os.walk(f"{tmp_dir}/objects") for f in files
             if f.startswith("part-")]
    assert len(parts) == 60 and len({p.split("-")[1] for p in parts}) > 3
    listed = O.stored(spark, f"{tmp_dir}/objects").collect()
    assert sorted((r.version, r.key, r.length) for r in listed) == sorted(
        (3, str(k), 2) for k in range(60))


@pytest.mark.parametrize("mounted", [True, False])
def test_object_files_of_odd_rows(spark, tmp_dir, monkeypatch, mounted):
    """In a mounted folder and by Spark's writer: groups, repeated and odd names, no bytes."""
    monkeypatch.setattr(O, "OBJECTS_A_GROUP", 20)
    if not mounted:
        monkeypatch.setattr(O, "mounted", lambda *_: None)
    rows = [(i % 3, f"k{i}", "ä" * i) for i in range(50)]
    rows += [(0, "a b/c=%d", "x"), (1, "k1", "twice"), (2, "none", None), (2, "'\"[^]{}:?#*\\", "yy")]
    for n in (rows, rows[:5]):     # the second one takes the place of the first
        O.write_objects(spark.createDataFrame(n, "version int, key string, body string"), f"{tmp_dir}/o")
        want = {}
        for v, k, b in n:
            want[v, k] = want.get((v, k), 0) + len((b or "").encode()) + 1
        assert len(os.listdir(f"{tmp_dir}/o")) >= len(n) // 20
        got = O.stored(spark, f"{tmp_dir}/o").collect()
        names = {f"local_v{v}_{k}.zip": (v, n) for (v, k), n in want.items()}
        assert sorted((x.version, x.length) for x in got) == sorted(names.values())
        plain = {x.name: (x.version, x.length) for x in got if "%" not in x.name}
        assert plain.items() <= names.items() and len(plain) >= len(names) - 2
    O.write_objects(spark.createDataFrame([], "version int, key string, body string"), f"{tmp_dir}/e")
    assert O.stored(spark, f"{tmp_dir}/e").count() == 0


def test_a_file_costs_no_task_and_no_process(spark, tmp_dir):
    objects = spark.range(200).select(F.lit(1).alias("version"), F.col("id").cast("string").alias("key"),
                                      F.lit("[1]").alias("body"))
    O.write_objects(objects, f"{tmp_dir}/objects")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/objects") for f in names]
    assert len(files) == 200 and all(f.startswith("part-") for f in files)   # no .crc beside them
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        assert O.stored(spark, f"{tmp_dir}/objects").count() == 200
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and max(tasks) <= 4 * sc.defaultParallelism


def test_status_snapshots_refuse_a_second_writer(spark, tmp_dir):
    root = f"{tmp_dir}/status"
    df = lambda v: spark.createDataFrame([(0, v)], "federation_id int, version int")
    assert ST.newest(spark, root) == 0
    read = ST.append(df(1), root, 0)
    assert read == 1 and ST.append(df(2), root, read) == 2
    with pytest.raises(ST.StaleStatus):      # another one has read snapshot 1 as well
        ST.append(df(7), root, read)
    with pytest.raises(ST.StaleStatus):
        ST.append(df(7), root, 5)
    assert ST.snapshot(spark, root).first().version == 2
    assert ST.snapshot(spark, root, 1).first().version == 1


def test_two_writers_at_once_leave_one_snapshot(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/status"
    df = lambda v: spark.createDataFrame([(0, v)], "federation_id int, version int")
    monkeypatch.setattr(ST, "newest", lambda *_: 0)   # both have looked before either wrote
    ST.append(df(1), root, 0)
    with pytest.raises(ST.StaleStatus):
        ST.append(df(2), root, 0)
    monkeypatch.undo()
    assert ST.snapshot(spark, root).first().version == 1


def test_status_of_the_last_request(spark):
    from test_live import SCHEMA, fold, log
    rows = log(1)
    got = {r.federation_id: (r.version, r.merging, r.evaluating, r.n_clients)
           for r in ST.status_of(L.live(spark.createDataFrame(rows, SCHEMA))).collect()}
    order = {r[1]: (r[2], r[1]) for r in rows}
    client = {r[1]: (r[4], r[3]) for r in rows}
    answers = fold(rows)
    for fed in got:
        mine = sorted((a for a in answers if a[0] == fed), key=lambda a: order[a[1]])
        last = mine[-1]
        clients = {client[a[1]][1] for a in mine
                   if a[5] == "accepted" and a[2] == last[2] and client[a[1]][0] == "upload"}
        assert got[fed] == (last[2], last[3], last[4], len(clients))


def test_sketches_of_parts_add_up(spark, tmp_dir):
    one = spark.range(6000).select(F.lit("s").alias("source"), F.lit("f1").alias("file"),
                                   F.lit(0).alias("objectionable"), F.col("id").cast("string").alias("text"))
    two = spark.range(3000, 9000).select(F.lit("s").alias("source"), F.lit("f2").alias("file"),
                                         F.lit(0).alias("objectionable"), F.col("id").cast("string").alias("text"))
    C.distinct_sketches(one).write.parquet(f"{tmp_dir}/k")
    C.distinct_sketches(two).write.mode("append").parquet(f"{tmp_dir}/k")   # reads the new file only
    got = C.sketched_counts(spark.read.parquet(f"{tmp_dir}/k"), ["source", "objectionable"]).first()
    assert got.n_rows == 12000 and abs(got.n_distinct - 9000) <= 0.03 * 9000
    per = C.sketched_counts(spark.read.parquet(f"{tmp_dir}/k"), ["file"]).collect()
    assert all(abs(r.n_distinct - 6000) <= 0.03 * 6000 for r in per)


def test_equal_bodies_are_one_object_across_batches_and_restarts(spark, tmp_dir):
    body = lambda model, n: json.dumps({"model": model, "sample_size": n})
    files = [[(1, body("YWJj", 5)), (2, "broken")], [(3, body("YWJj", 7)), (4, body("eHl6", 1))],
             [(5, body("YWJj", 9)), (6, body("YWJj", 8))]]
    os.makedirs(f"{tmp_dir}/in")

    def arrive(k):
        with open(f"{tmp_dir}/in/{k}.json", "w") as f:
            for i, b in files[k]:
                f.write(json.dumps({"doc_id": i, "version": 0, "body": b}) + "\n")

    run = lambda: US.run_deduplicated(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/c")
    arrive(0)
    arrive(1)
    run()
    arrive(2)
    run()   # started again from the checkpoint
    changes = spark.read.parquet(f"{tmp_dir}/out")
    assert changes.filter("is_new").count() == 2
    got = sorted((r.n_uploads, r.sample_size, r.size) for r in US.objects(changes).collect())
    assert got == [(1, 1, 3), (4, 8, 3)]
    assert all(r.object_name == f"local_v0_{r.content_hash}.zip" for r in changes.collect())


def test_silent_keys_are_forgotten(spark):
    import pandas as pd

    class State:
        hasTimedOut, exists, removed = True, True, False

        def remove(self):
            self.removed = True

    state = State()
    assert list(US.counted(1)((0, "h"), iter([pd.DataFrame()]), state)) == [] and state.removed

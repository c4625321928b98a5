import collections
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from concord.llm import sharding as S


def test_flow_finds_the_cheapest():
    flow = S.Flow(4)
    flow.add(0, 1, 5, 0)
    flow.add(0, 2, 5, 0)
    dear, cheap = flow.add(1, 3, 10, 7), flow.add(2, 3, 4, 2)
    assert flow.solve(0, 3) == 4 * 2 + 5 * 7
    assert (flow.used(dear), flow.used(cheap)) == (5, 4)


def fewest_bytes(old, shards):
    """Every choice of shards that hold one row more; the smallest rows leave."""
    n = sum(map(len, old.values()))
    base, extra = divmod(n, shards)
    best = None
    for more in itertools.combinations(range(shards), extra):
        moved = 0
        for k, sizes in old.items():
            room = base + (k in more) if k < shards else 0
            moved += sum(sorted(sizes)[:max(0, len(sizes) - room)])
        best = moved if best is None else min(best, moved)
    return best


@pytest.mark.parametrize("seed,olds,shards", [(1, 3, 5), (2, 7, 4), (3, 4, 4), (4, 1, 6)])
def test_counts_slots_and_bytes(spark, seed, olds, shards):
    r = random.Random(seed)
    rows = [(r.choice([None, *range(40_000)]), "é" * r.randrange(0, 30) if r.random() < .9 else None,
             min(r.randrange(olds), r.randrange(olds)), 5) for _ in range(r.randrange(20, 90))]
    rows += rows[:7]
    df = spark.createDataFrame(rows, "doc_id long, text string, at int, size int")
    got = S.reshard(S.measured(df, F.col("at")), shards).collect()
    assert sorted((x.doc_id, x.size, x.text_crc32, x.old) for x in got if x.doc_id is not None) == \
        sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), a)
               for d, t, a, _ in rows if d is not None)
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    old = {}
    for _, t, a, _ in rows:
        old.setdefault(a, []).append(len((t or "").encode()) + 1)
    assert sum(x.size for x in got if x.moved) == fewest_bytes(old, shards)
    assert all(x.moved == (x.shard != x.old) for x in got)


def test_rewrite_touches_changed_shards_only(spark, tmp_path):
    path = str(tmp_path / "layout")
    rows = [(i, "t" * i, 0 if i < 9 else 1 if i < 14 else 2) for i in range(21)]
    df = spark.createDataFrame(rows, "doc_id long, text string, at int")
    df.withColumnRenamed("at", "shard").write.partitionBy("shard").parquet(path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "layout").rglob("*.parquet")}
    assert S.rewrite(df, path, F.col("at"), 3) == [0, 1]
    back = spark.read.parquet(path)
    assert sorted(back.groupBy("shard").count().toPandas()["count"]) == [7, 7, 7]
    assert sorted(tuple(x) for x in back.select("doc_id", "text").collect()) == [
        (i, "t" * i) for i in range(21)]
    kept = [p for p in before if p.exists()]
    assert kept and all(p.stat().st_mtime_ns == before[p] for p in kept)


def test_balanced_and_empty(spark):
    df = spark.createDataFrame([(i, "x", i % 4) for i in range(8)], "doc_id long, text string, at int")
    assert not any(x.moved for x in S.reshard(S.measured(df, F.col("at")), 4).collect())
    assert S.reshard(S.measured(df.limit(0), F.col("at")), 4).count() == 0


def test_query_moves_the_texts_into_shards(spark, tmp_path, monkeypatch):
    """Rows with equal and null ids, copies and null texts; places are those in the files."""
    r = random.Random(5)
    rows = [(r.choice([None, *range(9)]), r.choice([None, "", "é", "x" * r.randrange(40)]),
             r.choice(["a", "b", "c", None]), i) for i in range(150)]
    rows += rows[:20]
    (spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
     .write.parquet(str(tmp_path / "documents.parquet")))
    monkeypatch.setattr("concord.llm.common.checkpoint_dir", lambda _: str(tmp_path / "shared"))
    got = S.op4_min_cost_flow_sharding(spark, str(tmp_path)).collect()
    folders = list((tmp_path / "shared").glob("shards-*"))
    assert len(folders) == 1
    folder = folders[0]
    moved = spark.read.parquet(str(folder)).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((x.doc_id, x.text, x.source, x.n_chars) for x in moved), key=key) == \
        sorted(rows, key=key)
    assert {int(p.name.split("=")[1]) for p in folder.glob("shard=*")} == set(range(S.SHARDS))
    assert collections.Counter((x.doc_id, x.size, x.text_crc32, x.shard, x.slot) for x in got) == \
        collections.Counter((x.doc_id, len((x.text or "").encode()) + 1,
                             zlib.crc32((x.text or "").encode()), x.shard, x.slot) for x in moved)
    by = collections.defaultdict(list)
    for x in got:
        by[x.shard].append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    old = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % S.OLD_SHARDS
    plan = S.reshard(S.measured(docs, old)).collect()
    assert collections.Counter((x.doc_id, x.size, x.text_crc32, x.shard, x.slot) for x in got) == \
        collections.Counter((x.doc_id, x.size, x.text_crc32, x.shard, x.slot) for x in plan)

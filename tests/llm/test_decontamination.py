import hashlib
import random
import re

import pytest

from concord.llm import decontamination as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            p = words(text)
            m = min(10, len(p))
            for k in range(len(p) - m + 1) if p else ():
                for i in range(len(w) - m + 1):
                    if w[i:i + m] == p[k:k + m]:
                        hit |= set(range(i, i + m))
                        ids |= {str(item)} if item is not None else set()
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [D.BLOCK, 7])
def test_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(D, "LANE", 16)
    r = random.Random(2)
    word = lambda: r.choice(["A", "b", "é", "Ü9", "c3", "dd"])
    text = lambda n: "".join(word() + r.choice([" ", "-", "\n", "__"]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 9, 10, 11, 25]) if i % 3 else 14)) for i in range(14)]
    items += [(3, items[5][1]), (None, text(12)), (99, None), (100, "!!"), (5, items[5][1])]
    items = [(i, t) for i, t in items if len(words(t)) != 1 or i == 4]
    docs = [(i, text(r.randrange(0, 200))) for i in range(12)]
    docs += [(50 + i, text(9) + " " + (t or "") + " " + text(5)) for i, (_, t) in enumerate(items)]
    docs += [(90, None), (90, ""), (None, items[0][1]), (91, items[0][1] * 30)]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs],
                               "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find(df, bench, block=block).select("doc_id", *D.RESULTS).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = D.find(docs, none).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)
    assert D.find(docs.limit(0), none).count() == 0


def test_one_python_worker_a_task(spark):
    """What counts the hits runs beside the search; a Python function more is a worker more."""
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "b c")], "item_id long, text string")
    found = D.find(docs, bench).filter("NOT contaminated")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_covered(spark):
    spans = [(None,), ([],), ([3, 5],), ([4, 9, 0, 2, 1, 3, 5, 6],), ([0, 10, 2, 3, 10, 12],)]
    rows = spark.createDataFrame(spans, "s array<int>")
    assert [r.n for r in rows.select(D.covered("s").alias("n")).collect()] == [0, 0, 2, 8, 12]

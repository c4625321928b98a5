"""Repeated byte strings against a table of all windows."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from concord.llm import suffix_dedup as S


def brute(rows, length):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p:p + length], []).append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for at in seen.values():
        if len(at) > 1:
            for i, p in at:
                gone[i][p:p + length] = True
    out = []
    for (d, _), t, g in zip(rows, texts, gone, strict=True):
        edges = np.diff(np.concatenate(([0], g.astype(int))))
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        out.append((d, len(t), int(g.sum()), int((edges == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, length):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aábcdé ") for _ in range(r.randrange(1, 7))) + " "
    make = lambda n: "".join(word() for _ in range(n))
    passages = [make(r.randrange(10, 60)) for _ in range(6)]
    texts = []
    for _ in range(60):
        t = make(r.randrange(0, 60))
        for _ in range(r.randrange(0, 3)):
            k = r.randrange(len(t) + 1)
            p = r.choice(passages)
            a = r.randrange(len(p))
            t = t[:k] + p[a:a + r.randrange(length // 2, 3 * length)] + t[k:]
        texts.append(t)
    texts += [texts[0]] * 4 + [texts[1] + "x", "", None, "é" * (2 * length), "ab" * (2 * length),
                               "z" * length, "z" * (length + 1), make(2) * 40]
    return list(enumerate(texts)) + [(None, texts[2]), (5, texts[3])]


@pytest.mark.parametrize("seed,length,group_bytes", [(1, 40, 1 << 20), (2, 50, 300), (3, 100, 0)])
def test_equals_all_windows(spark, seed, length, group_bytes):
    rows = corpus(seed, length)
    df = spark.createDataFrame([(d, t, b"clash") for d, t in rows],
                               "doc_id long, text string, kept binary").repartition(4)
    got = S.cut(df, length=length, group_bytes=group_bytes).collect()
    got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(x.kept).hexdigest())
           for x in got]
    assert sorted(got, key=str) == brute(rows, length)


def test_full_length(spark):
    r = random.Random(9)
    make = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    p = make(700)
    rows = [(0, make(500) + p[:399]), (1, p[:399] + make(300)), (2, p[100:] + make(50)),
            (3, make(10) + p[:560]), (4, make(5000)), (5, p[300:700]), (6, p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.cut(df).collect()
    got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(x.kept).hexdigest())
           for x in got]
    assert sorted(got, key=str) == brute(rows, 400)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.cut(df).count() == 0


def test_run_index_uses_few_samples():
    r = random.Random(1)
    base = bytes(r.randrange(256) for _ in range(3000))
    index = S.RunIndex([base, base[500:2500], b"q" + base[1000:]], 64)
    a, _ = index.run_ends()
    assert len(a) < 20  # one match per run of the transform, not per position
    assert index.repeats()[0] == [(500, 3000 - 64 + 1)]


class Rows:
    """Takes the function of a task instead of running it in a worker."""

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self


def test_parsing_holds_a_bounded_multiple_of_few_texts():
    r = random.Random(5)
    texts = ["".join(r.choices("abcdefgh ", k=2000)) for _ in range(1000)]
    batch = pa.record_batch([pa.array(range(1000), pa.int64()), pa.array([1] * 1000, pa.int32()),
                             pa.array(texts)], names=["doc", "key", "text"])
    run = S.phrase_rows(Rows(), 400).run
    list(run(iter([batch.slice(0, 10)])))  # tables that stay
    tracemalloc.start()
    rows = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 5000 and peak < 60e6, peak

"""Hard negatives against a scan of all rows, with shards and pages small enough for many boxes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, score double, rank string"


def usable(row):
    return (row[0] is not None and row[1] is not None and row[2] is not None
            and all(x is not None and math.isfinite(x) for x in row[2]))


def brute(rows, low=80, high=100, k=5, every=100):
    whole = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v])
             for i, lab, v, *_ in filter(usable, rows)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))  # noqa: E731  shorter: zeros
    anchors = {}
    for i, lab, v in sorted(whole):
        if i % every == 0:
            anchors.setdefault(i, (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        scored = [(-dot(v, w), i, other) for i, other, w in whole]
        for s, p, _ in sorted((s, i, o) for s, i, o in scored if o == lab and i != a)[:k]:
            near = sorted((t, i) for t, i, o in scored
                          if o != lab and low * -s <= 100 * -t <= high * -s)
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(near[:k], 1)]
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score",
        "negative_score").collect())


def vectors(seed, n=400, dims=6):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        label = 0 if r.random() < 0.35 else r.randrange(1, 6)   # one label holds a third
        v = [r.choice([-0.5, -0.25, 0.0, 0.25, 0.5, r.random()]) for _ in range(dims)]
        if r.random() < 0.3:
            v = [0.5, 0.25] + [0.25] * (dims - 2)               # one vector holds a third
        rows.append((i, label, v, 1.0, "x"))
    rows += [(700, None, [0.1] * dims, 1.0, "x"), (800, 1, None, 1.0, "x"),
             (801, 1, [None] + [0.9] * (dims - 1), 1.0, "x"), (900, 2, [float("nan")] * dims, 1.0, ""),
             (901, 2, [float("inf")] * dims, 1.0, "x"), (None, 1, [0.9] * dims, 1.0, "x"),
             (1000, 3, [0.5], 1.0, "x"), (1001, 1, [], 1.0, None), (1100, -7, [1.0] * dims, None, None),
             rows[3], rows[3], (0, 1, [-0.5] * dims, 1.0, "x")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard_rows,page,block", [(1, 30, 4, 2), (2, 75, 9, 100), (3, 5000, 128, 1)])
def test_equals_a_scan_of_all_rows(spark, seed, shard_rows, page, block):
    rows = vectors(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = H.mine(H.quantised(df), F.col("vec_id") % 20 == 0, shard_rows=shard_rows, page=page,
                 block=block)
    assert answer(got) == brute(rows, every=20)


def test_wide_windows_and_negative_scores(spark):
    rows = vectors(4, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(H.quantised(df), F.col("vec_id") % 10 == 0, positives=3, negatives=3, low=-300,
                 high=150, shard_rows=16, page=4)
    assert answer(got) == brute(rows, -300, 150, 3, 10)


def test_large_components_are_exact(spark):
    r = random.Random(5)
    rows = [(i, i % 3, [r.uniform(-60000, 60000) for _ in range(64)], 0.0, "") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(H.quantised(df), F.col("vec_id") % 10 == 0, shard_rows=20, page=4)
    assert answer(got) == brute(rows, every=10)


def test_no_rows_and_nothing_usable(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mine(H.quantised(empty), F.col("vec_id") % 100 == 0).count() == 0
    lost = spark.createDataFrame([(0, None, [1.0], 0.0, ""), (100, 1, None, 0.0, "")], SCHEMA)
    assert H.mine(H.quantised(lost), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0], 0.0, "")], SCHEMA)
    assert H.mine(H.quantised(one), F.col("vec_id") % 100 == 0).count() == 0


def test_boxes_bound_their_rows(spark):
    """Pruning is sound: every product of a row lies in the interval of each box above it."""
    rows = [(i, lab, v) for i, lab, v, *_ in vectors(6, 300) if i is not None]
    df = spark.createDataFrame([r for r in rows if usable(r)], "vec_id long, label int, embedding array<float>")
    pages, dims = H.build(H.quantised(df), 1000, 8)
    tree = H.Tree(pages.filter("shard = 0").toArrow(), dims, np.float64)
    queries = np.array([[3, -2, 0, 5, -7, 1], [-1, -1, -1, -1, -1, -1]], np.float64)
    low, high = tree.bounds(queries)
    assert len(tree.below[-1]) > 1 and pages.agg(F.max(F.size("ids"))).first()[0] <= 16
    for node, children in enumerate(tree.below):
        inside = queries @ (tree.values[node].T if not children else np.vstack(
            [tree.high[c] for c in children] + [tree.low[c] for c in children]).T)
        if not children:
            assert (inside >= low[:, [node]]).all() and (inside <= high[:, [node]]).all()
        for c in children:
            assert (low[:, node] <= low[:, c]).all() and (high[:, node] >= high[:, c]).all()

"""Near-duplicate vectors against all pairs, with buckets small enough for many blocks."""

import math

import numpy as np
import pytest

from concord.llm import embedding_dedup as E

SCHEMA = "vec_id long, label int, embedding array<float>, m string, key double"


def near(rng, v, cosine):
    """A vector at the given cosine to ``v``."""
    u = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ u) * u
    return cosine * u + math.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def usable(row):
    return (row[0] is not None and row[1] is not None and row[2] is not None
            and all(x is not None and math.isfinite(x) for x in row[2]) and any(row[2]))


def links(rows):
    """All linked pairs of row numbers."""
    good = [k for k, r in enumerate(rows) if usable(r)]
    dims = max(len(rows[k][2]) for k in good)
    x = np.zeros((len(good), dims))
    for i, k in enumerate(good):
        x[i, :len(rows[k][2])] = np.asarray(rows[k][2], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([rows[k][1] for k in good])
    a, b = np.nonzero(np.triu((x @ x.T >= E.COSINE) & (label[:, None] == label), 1))
    return [(good[i], good[j]) for i, j in zip(a, b, strict=True)]


def brute(rows):
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in links(rows):
        n[i] += 1
        n[j] += 1
        root[find(i)] = find(j)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(r[0], least.get(find(k), r[0])) if r[0] is not None else None
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((r[0], n[k], least[find(k)], r[0] is not None and r[0] == least[find(k)])
                   for k, r in enumerate(rows)), key=key)


def answer(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()),
                  key=key)


def families(seed, dims, family=300):
    """Random vectors, a family of near copies that holds a third, exact copies, odd rows."""
    rng = np.random.default_rng(seed)
    rows, centre = [], rng.standard_normal(dims)
    add = lambda label, v: rows.append((len(rows) * 3 % 1009, label, v, "x", 1.0))
    for _ in range(family):
        add(1, near(rng, centre, 0.998).tolist())
    for _ in range(250):
        v = rng.standard_normal(dims)
        add(int(rng.integers(4)), v.tolist())
        for _ in range(int(rng.integers(3))):
            add(rows[-1][1], (near(rng, v, 0.995) * rng.uniform(0.1, 9)).tolist())
    for _ in range(60):
        add(2, rows[400][2])
    add(3, rows[400][2])
    add(None, rows[400][2])
    add(1, None)
    add(1, [0.0] * dims)
    add(1, [None] + [1.0] * (dims - 1))
    add(1, [float("nan")] * dims)
    add(2, [1.0])
    add(2, [1.0, 0.0])
    add(2, [])
    rows += [(None, 1, rows[0][2], "x", 1.0), (rows[5][0], 1, rows[5][2], "x", 1.0),
             (rows[5][0], 0, rows[9][2], "x", 1.0)]
    return rows


@pytest.mark.parametrize("seed,dims,bucket", [(1, 64, 2048), (2, 64, 16), (3, 24, 64), (4, 100, 2048)])
def test_equals_all_pairs(spark, seed, dims, bucket):
    rows = families(seed, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert answer(E.near_duplicates(df, bucket=bucket)) == brute(rows)


def test_few_dimensions(spark):
    rng = np.random.default_rng(7)
    rows = [(i, 0, rng.standard_normal(2).tolist(), "", 0.0) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = E.near_duplicates(df).toPandas()
    want = 2 * len(links(rows))
    assert want >= got.n_links.sum() >= 0.95 * want


def test_recall_just_above_the_limit(spark):
    """Pairs of a cosine between 0.980 and 0.983, the hardest ones: at least 0.95 are found."""
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(600):
        v = rng.standard_normal(64)
        c = rng.uniform(0.9802, 0.983)
        rows += [(len(rows), 1, v.tolist(), "", 0.0), (len(rows) + 1, 1, near(rng, v, c).tolist(), "", 0.0)]
    got = E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).toPandas()
    want = 2 * len(links(rows))
    assert want >= 1100 and want >= got.n_links.sum() >= 0.95 * want


def test_codes_are_balanced():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64)) * np.linspace(0.2, 3, 64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = E.encode(E.fit(x), x)
    ones = [np.count_nonzero((code >> np.uint64(b)) & np.uint64(1)) / len(x) for b in range(64)]
    assert all(0.49 <= s <= 0.51 for s in ones)


def test_no_rows(spark):
    assert answer(E.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
    odd = [(1, None, [1.0], "", 0.0), (2, 1, None, "", 0.0), (3, 1, [0.0], "", 0.0)]
    assert answer(E.near_duplicates(spark.createDataFrame(odd, SCHEMA))) == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]

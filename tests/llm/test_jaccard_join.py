"""The Jaccard join against all pairs, with group limits small enough for every path."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import jaccard_join as J
from concord.llm import kernels as K

SCHEMA = "doc_id long, text string, n_shingles string"


def brute(rows, words_of):
    sets = []
    for _, t in rows:
        w = words_of(t)
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(12):       # families of near copies, some right at the border
        base = [word() for _ in range(r.choice([6, 9, 30, 80, 300]))]
        for _ in range(r.randrange(1, 9)):
            t = list(base)
            for _ in range(r.randrange(0, max(1, len(t) // 25) + 1)):
                t[r.randrange(len(t))] = word()
            rows.append(" ".join(t))
    for _ in range(40):       # unrelated texts around one very frequent passage
        own = [word() for _ in range(r.choice([5, 10, 14, 18, 25, 60]))]
        at = r.randrange(len(own))
        rows.append(" ".join(own[:at] + passage + own[at:]))
    rows += [rows[3]] * 6 + ["", None, "  \n", "A b", "a B", "a b c d", "x", "x " * 5000]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,group", [(1, 2), (2, 3), (3, 32)])
def test_equals_all_pairs(spark, words_of, seed, group):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(5)
    got = J.join(df, group=group).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, words_of)


def test_second_pass_alone_finds_all_links(spark, words_of):
    """Every class probes: the allotment of segments and neighbourhoods loses no link."""
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members = (J.grouped(J.signature_rows(df)).filter("kind = 0")
               .select(F.col("a").alias("doc_id"), F.col("b").alias("cls"),
                       F.col("na").alias("n"))).persist()
    classes = members.filter("n > 0").select("cls").distinct()
    sets = J.sets_of(df, members, classes).withColumn("extent", F.lit(1).cast("long"))
    sets = sets.withColumn("label", F.col("cls"))
    pairs = J.second_pass(sets, classes)
    found = J.linked(pairs, sets)
    cells = J._linked_in_cells(pairs, sets, 3)
    assert found.exceptAll(cells).count() == 0 and cells.exceptAll(found).count() == 0
    got = J._result(df, members, J.components(found))
    got = got.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, words_of)


def test_sketches_differ_in_no_more_bits_than_the_sets():
    r = np.random.default_rng(5)
    sets = [r.integers(0, 1 << 62, n, dtype=np.uint64) for n in (0, 1, 3, 70, 500, 0)]
    sets += [np.concatenate((s[len(s) // 6:], r.integers(0, 1 << 62, 9, dtype=np.uint64)))
             for s in sets]
    sizes = np.array([len(s) for s in sets])
    got = J.sketches(np.concatenate(sets), sizes).view(np.uint64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            bits = sum(int(x ^ y).bit_count() for x, y in zip(got[:, i], got[:, j], strict=True))
            assert bits <= len(set(a.tolist()) ^ set(b.tolist()))
            assert (bits == 0) or i != j
    assert (J.sketches(np.zeros(0, np.uint64), np.zeros(2, np.int64)) == 0).all()


def test_a_family_just_below_the_similarity_gives_few_pairs(spark):
    """Texts that share most segments, all pairs differing in too many shingles."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for d in range(60):
        t = list(base)
        for k in range(4):
            t[r.randrange(20) + 22 * k] = f"x{d}-{k}"
        rows.append((d, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members = (J.grouped(J.signature_rows(df)).filter("kind = 0")
               .select(F.col("a").alias("doc_id"), F.col("b").alias("cls"), F.col("na").alias("n")))
    classes = members.select("cls").distinct()
    sets = J.sets_of(df, members, classes).withColumns(
        {"extent": F.lit(1).cast("long"), "label": F.col("cls")})
    assert J.second_pass(sets, classes).count() < 60 * 59 // 2 // 10


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, None), (7, "a b c"), (7, "a b c")],
                               "doc_id long, text string")
    got = {tuple(r) for r in J.join(df).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {(None, 1, None), (None, 0, None), (7, 1, 7)}
    empty = spark.createDataFrame([], T.StructType.fromDDL("doc_id long, text string"))
    assert J.join(empty).count() == 0


def test_bounds(spark):
    n = np.arange(1, 5000)
    assert (J.needed(n, False) > J.differences(n, 4 * n // 3)).all()
    pairs = spark.range(1, 1400).selectExpr("id AS l", "explode(sequence(id, 4 * id div 3)) AS s")
    pairs = pairs.filter("(l + s) % 7 = 0 OR s = l").withColumn("x", J.least_shared_sql("l", "s"))
    p = pairs.toPandas()
    assert (J.least_shared(p.l.to_numpy(), p.s.to_numpy()) == p.x).all()
    assert (J.least_shared(n, n) >= 1).all() and (J.least_shared(n, 4 * n // 3) >= 1).all()


def test_words_that_collide_under_powers_of_a_base(spark):
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    df = spark.createDataFrame([(1, one, ""), (2, two, ""), (3, one, "")], SCHEMA)
    assert {r.doc_id: r.component_id for r in J.join(df).collect()} == {1: 1, 2: 2, 3: 1}


def test_sets_that_are_in_no_pair_stay_where_they_are(spark):
    rows = [(k, 4, [10 * k + j for j in range(4)]) for k in range(50)] + [(77, 4, [70, 71, 72, 73])]
    sets = spark.createDataFrame(rows, "cls long, n int, grams array<long>")
    pairs = spark.createDataFrame([(7, 77), (7, 8), (7, 77)], "a long, b long")
    found = J.linked(pairs, sets)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2
    assert [tuple(r) for r in found.collect()] == [(7, 77)]


def test_pairs_that_cannot_be_linked_move_no_set(spark):
    """Parity sketches of any width drop them, and no pair that reaches the similarity."""
    r = random.Random(3)
    word = lambda: f"w{r.randrange(10 ** 6)}"
    rows, wanted = [], {}
    for k, size in enumerate((7, 40, 200, 900)):
        base = [word() for _ in range(size)]
        near = base[:-1] + [word()]  # one shingle of each differs
        far = list(base)             # every seventh word: hardly a shingle is the same
        far[::7] = [word() for _ in far[::7]]
        longer = base + [word() for _ in range(size // 5)]
        for j, t in enumerate((base, near, far, longer)):
            rows.append((4 * k + j, " ".join(t)))
        sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (base, near, far, longer)]
        for j in (1, 2, 3):
            both = len(sets[0] & sets[j])
            wanted[4 * k, 4 * k + j] = 100 * both >= 75 * len(sets[0] | sets[j])
    assert {len(t.split()) for _, t in rows} >= {7, 8, 900, 1080}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members = (J.grouped(J.signature_rows(df)).filter("kind = 0")
               .select(F.col("a").alias("doc_id"), F.col("b").alias("cls"), F.col("na").alias("n")))
    cls = {x.doc_id: x.cls for x in members.collect()}
    pairs = spark.createDataFrame([(cls[a], cls[b], 100 * a + b) for a, b in wanted],
                                  "a long, b long, shared long")
    left = {x.shared for x in J.plausible(pairs, df, members).collect()}
    assert left >= {100 * a + b for (a, b), links in wanted.items() if links}
    assert not left & {100 * 4 * k + 4 * k + 2 for k in (1, 2, 3)}


def test_parity_sketches_of_two_widths(spark):
    r = np.random.default_rng(8)
    for n in (1, 31, 33, 600, 5000):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[n // 9:], r.integers(0, 1 << 63, n // 4 + 1, dtype=np.uint64))))
        (na, nb), numbers = J.parities(np.concatenate((a, b)), np.array([len(a), len(b)]))
        row = [(K.signed(numbers[:na]).tolist(), K.signed(numbers[na:]).tolist())]
        df = spark.createDataFrame(row, "sa array<long>, sb array<long>")
        (got,) = df.select(F.expr(J.bits_apart("sa", "sb"))).first()
        bits = 64 * min(na, nb)
        place = [np.bincount((K.mix(x, 61) & K.U64(bits - 1)).astype(np.int64), minlength=bits) & 1
                 for x in (a, b)]
        assert got == (place[0] ^ place[1]).sum() <= len(np.setxor1d(a, b))
    count, numbers = J.parities(np.zeros(0, np.uint64), np.zeros(2, np.int64))
    assert count.tolist() == [0, 0] and len(numbers) == 0


def test_segments_that_meet_no_other_are_not_moved_on(spark):
    """Of unrelated sets the second pass moves the signatures and nothing after them."""
    rows = [(d, " ".join(f"w{d}x{i}" for i in range(80 + d))) for d in range(30)]
    rows += [(100, rows[0][1] + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members = (J.grouped(J.signature_rows(df)).filter("kind = 0")
               .select(F.col("a").alias("doc_id"), F.col("b").alias("cls"), F.col("na").alias("n")))
    cls = {x.doc_id: x.cls for x in members.collect()}
    sets = J.sets_of(df, members, members.select("cls")).withColumns(
        {"extent": F.lit(1).cast("long"), "label": F.col("cls")})
    lists = J.meeting(sets)
    assert lists.count() <= J.second_pass_rows(sets.filter(f"cls = {cls[0]}")).count()
    got = {tuple(x) for x in J.second_pass(sets, members.select("cls").distinct()).collect()}
    assert got == {tuple(sorted((cls[0], cls[100])))}

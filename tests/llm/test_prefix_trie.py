"""The prefix trie against tries of Python dictionaries, with shards of a few turns."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from concord.llm import prefix_trie as P

SCHEMA = "conv_id long, turn int, role string, text string, depth string, ids double"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    nodes = {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), {"in": [], "end": []})
            node["in"].append(c)
            if d == len(turns):
                node["end"].append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids.get(p, [])) or 1
        saved = (len(nodes[p]["in"]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = leaves, saved + sum(total[k][1] for k in kids.get(p, []))
    return sorted((min(n["in"]), len(p), min(nodes[p[:-1]]["in"]) if p else None, len(n["in"]),
                   len(kids.get(p, [])), *total[p],
                   hashlib.sha256(",".join(map(str, sorted(n["end"]))).encode()).hexdigest())
                  for p, n in nodes.items())


def answer(df):
    return sorted(tuple(r) for r in df.select(*P.RESULT).collect())


def conversations(seed, n=60):
    r = random.Random(seed)
    rows = []
    turn = lambda c, t, role, text: rows.append((c, t, role, text, "x", 1.0))
    for c in range(n):
        if c % 3 == 0:                     # a third of all are the same conversation
            for t in range(4):
                turn(c * 5, t, "user", f"the same {t}")
        else:
            for t in range(r.randrange(1, 12)):
                turn(c, t, r.choice(["user", "system", None]), r.choice(["a", "b", "ü", "", None, "long " * 9]))
    for t in range(300):                   # one long conversation, and one that leaves it late
        turn(1001, t, "user", f"t{t}")
        turn(1002, t, "user", f"t{t}" if t < 250 else "other")
    turn(-3, 0, "user", "below zero")
    turn(-5, 0, "user", "its base")
    for _ in range(2):
        turn(2001, 1, "user", "twice")     # equal rows, equal numbers, missing numbers
        turn(2001, None, "user", "first")
        turn(2001, 1, "assistant", "tie")
    turn(None, 1, "user", "nobody")
    for c in range(3000, 3040):            # short ones: those with h > 0 lose all their turns
        turn(c * 5 + 1, 0, "user", "only")
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard_turns", [(1, 5), (2, 40), (3, 50_000)])
def test_equals_dictionaries(spark, seed, shard_turns):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert answer(P.conversation_trie(df, shard_turns)) == brute(rows)


def test_equal_conversations_over_many_shards(spark):
    rows = [(c * 5, t, "user", f"the same {t}", "", 0.0) for c in range(200) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    shards = P.sharded(P.rebuilt(P.encoded(df)), 40)
    assert shards.select("shard").distinct().count() > 10
    assert answer(P.conversation_trie(df, 40)) == brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert answer(P.conversation_trie(empty)) == []
    nobody = spark.createDataFrame([(None, 1, "user", "x", "", 0.0)], SCHEMA)
    assert answer(P.conversation_trie(nobody)) == []


def test_very_long_text(spark):
    rows = [(5, 0, "user", "x" * 2_000_000, "", 0.0), (10, 0, "user", "x" * 2_000_000, "", 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert answer(P.conversation_trie(df)) == brute(rows)


def test_median_insertion_is_level():
    tree = P.TernaryTree()
    for k in P.medians(1023):
        tree.insert([k], [1])
    depth = {tree.first[0]: 1}
    for node in range(tree.first[0], len(tree.turn)):
        for side in (tree.less[node], tree.more[node]):
            if side:
                depth[side] = depth[node] + 1
    assert max(depth.values()) == 10


def test_common_prefix(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2, 3]), ([1, 2], [1, 2, 3]), ([4], [1]), ([], [1]),
                                ([], []), (None, [1])], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(P.common_prefix(F.col("a"), F.col("b"))).collect()]
    assert got == [3, 2, 0, 0, 0, -1]

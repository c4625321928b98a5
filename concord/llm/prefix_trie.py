"""Prefix trie of conversations (operator 12).

Turns are dictionary-encoded: the distinct (role, text), told apart by their SHA-256, are
sorted and numbered, and a conversation becomes an array of turn numbers. The arrays are
sorted over the cluster and cut into range shards of about ``SHARD_TURNS`` turns; equal
conversations are sorted by id, so a sequence that a third of all conversations share is
spread over many shards. A task builds a ternary search tree of its shard: the distinct
sequences are inserted median first, which keeps the comparison trees level, and since a
node is always made after its parent, one pass over the nodes from the last to the first
accumulates members, leaves and savings without recursion.

A node can lie in several shards only if it is a prefix of the first or last sequence of a
shard shared with its neighbour. Those boundary nodes, at most two paths a shard, leave
their shard as partial rows, are merged by the digest of their prefix, and pass their sums
on to the boundary nodes above. What ends in a boundary node is hashed in the order of the
shards, a piece a shard, without holding all ids.

Edge cases: a null role or text is empty; turns are ordered by number (null first), turns
of equal number by the SHA-256 of role and text, repeated rows stay repeated turns; rows
without conversation id take no part; a conversation that is rebuilt without turns is a
member of the root only; an empty table gives no rows; other columns are ignored. The turn
numbers of one conversation, 16 bytes a turn, are one row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import broadcast_if_small, join_keyed, table, written

SHARD_TURNS = 50_000
#: Conversations per family of shared beginnings, and most turns taken over, plus one.
FAMILY, HEADS = 5, 9

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, key binary, parent binary, "
         "path array<binary>, size long, shard int, ends string")


def encoded(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, id, size>>): the turns of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.octet_length(text).cast("long").alias("size"),
        F.unhex(F.sha2(body, 256)).alias("digest"))
    rows = written(rows, "trie-turns")
    dictionary = rows.groupBy("digest").agg(F.count("*").alias("n")).orderBy("digest")
    dictionary = written(dictionary.withColumn("id", F.monotonically_increasing_id()), "trie-ids")
    numbered = join_keyed(rows, dictionary, "digest", "n")
    return numbered.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "id", "size"))).alias("turns"))


def rebuilt(own: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv_id, ids, sizes): each conversation with the beginning of the first of its family."""
    first = own.select(F.col("conv_id").alias("base"),
                       F.slice("turns", 1, heads).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    rows = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % family, "h": h})
    none = F.array().cast("array<struct<turn:bigint,id:bigint,size:bigint>>")
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.size("turns")))
    joined = rows.join(first, "base", "left").select("conv_id", turns.alias("turns"))
    return joined.select("conv_id", F.col("turns.id").alias("ids"),
                         F.col("turns.size").alias("sizes"))


def sharded(sequences: DataFrame, shard_turns: int) -> DataFrame:
    """The sequences with ``shard``: contiguous ranges in lexicographic order."""
    total = sequences.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, math.ceil(total / shard_turns))
    return written(sequences.repartitionByRange(shards, "ids", "conv_id")
                   .withColumn("shard", F.spark_partition_id()), "trie-shards")


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays; -1 where one is null."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    length = F.when(at == 0, F.size(a)).otherwise(at - 1)
    return F.when(a.isNull() | b.isNull(), F.lit(-1)).otherwise(length).cast("int")


def shared_with_neighbours(shards: DataFrame) -> DataFrame:
    """(shard, left, right): turns that its first and last sequence share with the
    sequences next to them, -1 at the ends. One row a shard is sorted."""
    ends = shards.groupBy("shard").agg(F.min("ids").alias("low"), F.max("ids").alias("high"))
    order = Window.orderBy("shard")
    return ends.select("shard",
                       common_prefix(F.lag("high").over(order), F.col("low")).alias("left"),
                       common_prefix(F.col("high"), F.lead("low").over(order)).alias("right"))


def medians(n: int) -> Iterator[int]:
    """0..n-1, the middle of every part before its halves."""
    parts = [(0, n)]
    while parts:
        a, z = parts.pop()
        if a < z:
            mid = (a + z) // 2
            yield mid
            parts += [(a, mid), (mid + 1, z)]


class TernaryTree:
    """Trie nodes as a ternary search tree; node 0 is the root of the trie."""

    def __init__(self):
        self.turn: list[int] = [0]
        self.size: list[int] = [0]
        self.less: list[int] = [0]
        self.more: list[int] = [0]
        self.first: list[int] = [0]   # tree of the children of a node
        self.up: list[int] = [-1]     # the node of the prefix one turn shorter
        self.depth: list[int] = [0]

    def _new(self, turn: int, size: int, up: int) -> int:
        self.turn.append(turn)
        self.size.append(size)
        self.less.append(0)
        self.more.append(0)
        self.first.append(0)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        return len(self.turn) - 1

    def insert(self, ids, sizes) -> list[int]:
        """The nodes of the prefixes of a sequence, made where they are missing."""
        turn, less, more, first = self.turn, self.less, self.more, self.first
        node, path = 0, [0]
        for t, size in zip(ids, sizes, strict=True):
            at = first[node]
            if not at:
                at = first[node] = self._new(t, size, node)
            while turn[at] != t:
                side = less if t < turn[at] else more
                if not side[at]:
                    side[at] = self._new(t, size, node)
                at = side[at]
            node = at
            path.append(node)
        return path


def ids_digest(ids: list[int]) -> tuple[str, str]:
    """(the ids joined by commas, its SHA-256)."""
    joined = ",".join(map(str, ids))
    return joined, hashlib.sha256(joined.encode()).hexdigest()


def shard_nodes(part: pa.Table) -> pa.Table:
    """The trie nodes of one shard: whole ones, and partial ones on its boundaries."""
    shard, left, right = (part.column(c)[0].as_py() for c in ("shard", "left", "right"))
    rows = sorted(zip(part.column("ids").to_pylist(), part.column("conv_id").to_pylist(),
                      part.column("sizes").to_pylist(), strict=True), key=lambda r: (r[0], r[1]))
    distinct: list[tuple] = []   # (ids, sizes, conversations)
    for ids, conv, sizes in rows:
        if distinct and distinct[-1][0] == ids:
            distinct[-1][2].append(conv)
        else:
            distinct.append((ids, sizes, [conv]))
    tree, ends = TernaryTree(), {}
    paths = {}
    for k in medians(len(distinct)):
        path = tree.insert(*distinct[k][:2])
        ends[path[-1]] = distinct[k][2]
        if k in (0, len(distinct) - 1):
            paths[k] = path
    n = len(tree.turn)
    boundary = [False] * n
    for path, shared in ((paths[0], left), (paths[len(distinct) - 1], right)):
        for node in path[:shared + 1]:
            boundary[node] = True
    least, members = [1 << 62] * n, [0] * n
    children, leaves, saved, whole = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if i in ends:
            members[i] += len(ends[i])
            least[i] = min(least[i], ends[i][0])
        if not boundary[i]:
            leaves[i] = leaves[i] if children[i] else 1
            saved[i] += (members[i] - 1) * tree.size[i]
        up = tree.up[i]
        if up >= 0:
            members[up] += members[i]
            least[up] = min(least[up], least[i])
            if not boundary[i]:
                children[up] += 1
                leaves[up] += leaves[i]
                saved[up] += saved[i]
    keys: dict[int, list[bytes]] = {}  # digests of the prefixes of a boundary node, its own last
    for i in range(n):
        if boundary[i]:
            above = keys[tree.up[i]] if i else []
            key = hashlib.blake2b((above[-1] if i else b"") + tree.turn[i].to_bytes(8, "little"),
                                  digest_size=16).digest()
            keys[i] = [*above, key]
    out: list[tuple] = []
    for i in range(n):
        up, joined = tree.up[i], ids_digest(ends.get(i, []))
        above = keys[up][-1] if up >= 0 and boundary[up] else None
        out.append((least[i], tree.depth[i],
                    least[up] if up >= 0 and not boundary[up] else None,
                    members[i], children[i], leaves[i], saved[i],
                    None if boundary[i] else joined[1], keys[i][-1] if boundary[i] else None,
                    above, keys.get(i), tree.size[i], shard, joined[0] if boundary[i] else None))
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.binary()),
                                pa.int64(), pa.int32(), pa.string()]
    names = [f.strip().split(" ")[0] for f in NODES.split(",")]
    return pa.table({c: pa.array(list(v), k) for c, v, k in zip(
        names, zip(*out, strict=True), kinds, strict=True)})


def joined_digests(partial: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the boundary nodes in which conversations end: their pieces
    are hashed in the order of the shards as they are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
        if key is not None:
            done.append((key, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()),
                                          pa.array([d[1] for d in done], pa.string())],
                                         names=["key", "ends_sha256"])

    pieces = partial.filter("ends <> ''").select("key", "shard", "ends")
    return (pieces.repartition("key").sortWithinPartitions("key", "shard")
            .mapInArrow(run, "key binary, ends_sha256 string"))


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "ends_sha256"]


def merged(partial: DataFrame) -> DataFrame:
    """The boundary nodes over all shards, with ``key``."""
    whole = lambda c: F.sum(c).alias(c)
    nodes = written(partial.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), whole("n_convs"),
        whole("n_children"), whole("n_leaves"), whole("saved_tokens"), F.max("size").alias("size"),
        F.any_value("parent").alias("parent"), F.any_value("path").alias("path")), "trie-merged")
    below = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("more"))
    nodes = nodes.join(below, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = nodes.select(
        F.explode("path").alias("key"),
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    sums = own.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, "key").join(above, "parent", "left")
            .join(joined_digests(partial), "key", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
                    .alias("ends_sha256")))


def trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the prefix trie of sequences (conv_id, ids, sizes)."""
    shards = sharded(written(sequences, "trie-sequences"), shard_turns)
    limits = shared_with_neighbours(shards)
    found = written(shards.join(limits, "shard").groupBy("shard").applyInArrow(
        shard_nodes, NODES), "trie-nodes")
    top = broadcast_if_small(written(merged(found.filter("key IS NOT NULL")), "trie-top"))
    inner = found.filter("key IS NULL")
    above = top.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    inner = inner.join(above, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return inner.select(*RESULT).unionByName(top.select(*RESULT))


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of the rebuilt conversations of rows (conv_id, turn, role, text)."""
    return trie(rebuilt(written(encoded(conversations), "trie-conversations")), shard_turns)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rows of ``conversations``."""
    return conversation_trie(table(spark, sf_dir, "conversations"))

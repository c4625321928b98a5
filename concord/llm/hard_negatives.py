"""Hard negatives from an STR-packed R-tree (operator 11).

The vectors (whole numbers) are tiled Sort-Tile-Recursive: Spark sorts them by label,
by the slabs of the two coordinates of greatest variance and by a hash of the id into
shards of about ``SHARD_ROWS`` rows (a label or a vector that holds a third of all rows
is spread over many shards), and a task tiles its shard further into pages of at most
``PAGE`` rows. A page is a leaf: its minimum bounding box, its labels and its vectors.

A search sends blocks of queries to the shards. In a task the pages of one shard become
an R-tree of fan-out ``FANOUT``. A box gives an interval for each product of coordinates
and so for the inner product: the sum of the products of the query's positive parts with
the upper corner and its negative parts with the lower one bounds it from above, the
opposite corners from below. A best-first queue opens boxes by their upper bound; boxes
whose interval lies outside the score window, whose labels cannot match, or whose upper
bound is strictly below the k-th score found are pruned. Each shard gives its k best of
each window; ranks are taken over all shards. About the square root of the shards is
searched first, and the k-th scores found there prune the others.

Positives of an anchor are the best vectors of its label, negatives the best of other
labels in the score window of each positive. All rows are searched; nothing is sampled.

Edge cases: rows without id take no part, nor do those that ``usable`` rules out; vectors
of fewer components count as filled with zeros; components are held to +-2 ** 24; a
repeated id is one anchor (the first row by label and vector) and otherwise separate
rows; an anchor without positives, or a window without rows, gives nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import table, written
from concord.llm.vectors import finite, matrix

SHARD_ROWS = 4096
PAGE = 128
FANOUT = 8
#: Anchors of one block of queries.
BLOCK = 1024
#: Largest component of a vector; 100 inner products of 64 such fit 63 bits.
LIMIT = 1 << 24
#: Coordinates by which a task tiles its shard, and slabs of a coordinate over all shards.
TILED = 4
MOST_SLABS = 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1

PAGES = ("shard int, page int, low array<int>, high array<int>, ids array<long>, "
         "labels array<long>, body binary")
HITS = "anchor_id long, tag int, vec_id long, score long"


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v array<int>) of the rows that take part; ``v`` = floor(scale * x)."""
    edge = float(LIMIT)
    whole = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * scale, F.lit(-edge)), F.lit(edge))).cast("int"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")
    return rows.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"),
                                      F.col("label").cast("long").alias("label"),
                                      whole.alias("v"))


def str_tiles(index: np.ndarray, values: np.ndarray, dims, most: int) -> Iterator[np.ndarray]:
    """Sort-Tile-Recursive: parts of at most ``most`` rows, sorted and cut by one dimension
    after the other."""
    if len(index) <= most:
        yield index
        return
    pages = -(-len(index) // most)
    slabs = math.ceil(pages ** (1 / len(dims))) if len(dims) > 1 else pages
    order = index[np.argsort(values[index, dims[0]], kind="stable")]
    for part in np.array_split(order, slabs):
        yield from str_tiles(part, values, dims[1:] or dims, most)


def label_groups(labels: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """Rows by label; labels of few rows go together."""
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    waiting: list[np.ndarray] = []
    for part in np.split(order, cuts):
        if len(part) >= least:
            yield part
        else:
            waiting.append(part)
            if sum(map(len, waiting)) >= least:
                yield np.concatenate(waiting)
                waiting = []
    if waiting:
        yield np.concatenate(waiting)


def spread(rows: DataFrame) -> list[int]:
    """The two coordinates of greatest variance (one row a coordinate is aggregated)."""
    by = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(
        F.var_pop(F.col("x").cast("double")).alias("var"))
    return [r["at"] for r in by.orderBy(F.desc("var"), "at").limit(2).collect()]


def slab(coordinate: int, bounds: list[int]) -> Column:
    """Number of bounds below a coordinate."""
    value = F.coalesce(F.get("v", F.lit(coordinate)), F.lit(0))
    return F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b < value))


def build(rows: DataFrame, shard_rows: int = SHARD_ROWS, page: int = PAGE
          ) -> tuple[DataFrame, int]:
    """(leaf pages of the packed tree, components) of rows (vec_id, label, v)."""
    n, dims, labels = rows.agg(F.count("*"), F.max(F.size("v")),
                               F.approx_count_distinct("label")).first()
    dims = dims or 0
    shards = max(1, math.ceil(n / shard_rows))
    slabs = min(MOST_SLABS, math.ceil(math.sqrt(shards / max(1, labels))))
    keys = ["label"]
    if slabs > 1:
        at = [i / slabs for i in range(1, slabs)]
        axes = spread(rows)
        cuts = rows.agg(*(F.percentile_approx(F.get("v", F.lit(c)), at, 1000) for c in axes)).first()
        for k, c in enumerate(axes):
            rows = rows.withColumn(f"_t{k}", slab(c, cuts[k]))
            keys.append(f"_t{k}")
    dealt = rows.repartitionByRange(shards, *keys, F.xxhash64("vec_id")).select(
        "vec_id", "label", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        part = pa.Table.from_batches(batches)
        ids, label = (part.column(c).to_numpy() for c in ("vec_id", "label"))
        values = matrix(part.column("v"), dims, np.int32)
        first = np.lexsort((ids, label))  # the order of rows does not depend on the shuffle
        ids, label, values = ids[first], label[first], values[first]
        widest = np.argsort(-values.astype(float).var(axis=0), kind="stable")[:TILED].tolist()
        number = 0
        for group in label_groups(label, page):
            for leaf in str_tiles(group, values, widest, page) if dims else [group]:
                box = values[leaf]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "page": pa.array([number], pa.int32()),
                    "low": pa.array([box.min(axis=0)], pa.list_(pa.int32())),
                    "high": pa.array([box.max(axis=0)], pa.list_(pa.int32())),
                    "ids": pa.array([ids[leaf]], pa.list_(pa.int64())),
                    "labels": pa.array([label[leaf]], pa.list_(pa.int64())),
                    "body": pa.array([box.tobytes()], pa.binary())})
                number += 1

    return written(dealt.mapInArrow(run, PAGES), "rtree"), dims


class Tree:
    """The R-tree of one shard: its pages as leaves, boxes of ``FANOUT`` nodes above."""

    def __init__(self, pages: pa.Table, dims: int, kind):
        pages = pages.sort_by("page")
        self.ids = [np.asarray(x, np.int64) for x in pages.column("ids").to_pylist()]
        self.labels = [np.asarray(x, np.int64) for x in pages.column("labels").to_pylist()]
        self.values = [np.frombuffer(b, np.int32).reshape(-1, dims).astype(kind)
                       for b in pages.column("body").to_pylist()]
        boxes = [(lo, hi, lab.min(), lab.max()) for lo, hi, lab in zip(
            matrix(pages.column("low"), dims, kind), matrix(pages.column("high"), dims, kind),
            self.labels, strict=True)]
        self.below: list[range] = [range(0)] * len(boxes)
        level = range(len(boxes))
        while len(level) > 1:
            first = len(boxes)
            for i in range(level.start, level.stop, FANOUT):
                part = range(i, min(i + FANOUT, level.stop))
                low, high, least, most = zip(*(boxes[j] for j in part), strict=True)
                boxes.append((np.min(low, axis=0), np.max(high, axis=0), min(least), max(most)))
                self.below.append(part)
            level = range(first, len(boxes))
        self.low, self.high = (np.stack([b[k] for b in boxes]) for k in (0, 1))
        self.least, self.most = ([int(b[k]) for b in boxes] for k in (2, 3))

    def bounds(self, queries: np.ndarray):
        """(lower, upper) bound of the inner product of each query with each box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def can_match(self, node: int, label: int, same: bool) -> bool:
        least, most = self.least[node], self.most[node]
        return least <= label <= most if same else least < most or least != label

    def best(self, query, anchor: int, label: int, lower, upper, windows, k: int, same: bool
             ) -> Iterator[tuple[int, int, int]]:
        """(tag, vec_id, score) of the k best rows of each window (tag, lo, hi, kth)."""
        scored: dict[int, tuple] = {}
        root = len(self.below) - 1
        for window in windows:
            lo, hi = window["lo"], window["hi"]
            floor, found = max(lo, window["kth"]), []
            queue = [(-min(upper[root], hi), root)] if (
                self.can_match(root, label, same) and lower[root] <= hi) else []
            while queue:
                bound, node = heapq.heappop(queue)
                if -bound < floor:
                    break
                if self.below[node]:
                    for child in self.below[node]:
                        if (upper[child] >= floor and lower[child] <= hi
                                and self.can_match(child, label, same)):
                            heapq.heappush(queue, (-min(upper[child], hi), child))
                    continue
                if node not in scored:
                    score = self.values[node] @ query
                    fits = ((self.labels[node] == label) & (self.ids[node] != anchor) if same
                            else self.labels[node] != label)
                    scored[node] = score[fits].astype(np.int64), self.ids[node][fits]
                score, ids = scored[node]
                at = np.flatnonzero((score >= floor) & (score <= hi))
                if len(at):
                    at = at[np.lexsort((ids[at], -score[at]))[:k]]
                    found = sorted(found + list(zip((-score[at]).tolist(), ids[at].tolist(),
                                                    strict=True)))[:k]
                    if len(found) == k:
                        floor = max(floor, -found[-1][0])
            for score, vec_id in found:
                yield window["tag"], vec_id, -score


def search(pages: DataFrame, queries: DataFrame, dims: int, k: int, same: bool, blocks: int
           ) -> DataFrame:
    """The k best rows of each shard for each window of the queries routed to it.

    ``queries``: (shard, anchor_id, label, v, windows); a task holds one shard's pages and
    one block of queries.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            asked = matrix(right.column("v"), dims, np.int64)
            largest = float(np.abs(asked).max(initial=0)) * LIMIT * dims
            kind = np.float64 if largest < 1 << 53 else np.int64
            if kind is np.int64:  # the boxes of this shard may allow the faster form
                peak = max(np.abs(matrix(left.column(c), dims, np.int64)).max(initial=0)
                           for c in ("low", "high"))
                if float(np.abs(asked).max(initial=0)) * float(peak) * dims < 1 << 53:
                    kind = np.float64
            tree = Tree(left, dims, kind)
            asked = asked.astype(kind)
            lower, upper = tree.bounds(asked)
            for i, (anchor, label, windows) in enumerate(zip(
                    right.column("anchor_id").to_pylist(), right.column("label").to_pylist(),
                    right.column("windows").to_pylist(), strict=True)):
                low, high = lower[i].astype(np.int64).tolist(), upper[i].astype(np.int64).tolist()
                rows += [(anchor, *hit) for hit in tree.best(
                    asked[i], anchor, label, low, high, windows, k, same)]
        cols = zip(*rows, strict=True) if rows else ([], [], [], [])
        return pa.table({name: pa.array(list(c), kind) for name, c, kind in zip(
            ("anchor_id", "tag", "vec_id", "score"), cols,
            (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)})

    block = F.sequence(F.lit(0), F.lit(blocks - 1))
    left = pages.withColumn("g", F.explode(block))
    right = queries.withColumn("g", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
    return (left.groupBy("shard", "g").cogroup(right.groupBy("shard", "g"))
            .applyInArrow(run, HITS))


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each window with their rank; ties go to the smaller id."""
    order = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best(pages: DataFrame, dims: int, shards: int, anchors: DataFrame, windows: DataFrame,
         routes: DataFrame | None, k: int, same: bool, blocks: int) -> DataFrame:
    """The k best rows of each window (anchor_id, tag, lo, hi) over all shards.

    ``routes``: (label, shard) with rows of a label; None: every shard. Every
    ``sqrt(shards)``-th shard is searched first; its k-th scores bound the rest.
    """
    step = math.ceil(math.sqrt(shards))
    early = F.col("shard") % step == 0

    def queries(asked: DataFrame) -> DataFrame:
        many = asked.groupBy("anchor_id").agg(F.collect_list(F.struct(
            "tag", "lo", "hi", "kth")).alias("windows"))  # at most one a positive
        rows = anchors.join(many, "anchor_id")
        if routes is None:
            return rows.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        return rows.join(routes, "label")

    def found(asked: DataFrame, part: Column) -> DataFrame:
        return search(pages.filter(part), queries(asked).filter(part), dims, k, same, blocks)

    first = written(ranked(found(windows.withColumn("kth", F.lit(LEAST)), early), k), "rtree-first")
    kth = first.filter(F.col("rank") == k).select("anchor_id", "tag", F.col("score").alias("kth"))
    bounded = windows.join(kth, ["anchor_id", "tag"], "left").withColumn(
        "kth", F.coalesce("kth", F.lit(LEAST)))
    return ranked(first.drop("rank").unionByName(found(bounded, ~early)), k)


def percent(score: Column, share: int, up: bool) -> Column:
    """Least (or greatest) whole number n with 100 n >= (<=) share * score."""
    scaled = score * share
    rest = F.pmod(scaled, F.lit(100))
    floor = F.call_function("div", scaled - rest, F.lit(100))
    return floor + (rest > 0).cast("long") if up else floor


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, shard_rows: int = SHARD_ROWS, page: int = PAGE,
         block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (vec_id, label, v array<int>). A negative's score lies between ``low``
    and ``high`` per cent of that of the positive.
    """
    vectors = written(vectors.select("vec_id", "label", "v"), "vectors")
    pages, dims = build(vectors, shard_rows, page)
    anchors = written(vectors.filter(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "v")).alias("a")).select(
            F.col("vec_id").alias("anchor_id"), "a.label", "a.v"), "anchors")
    shards = (pages.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = max(1, math.ceil(anchors.count() / block))
    routes = written(pages.select("shard", F.explode(F.array_distinct("labels")).alias("label"))
                     .distinct(), "rtree-labels")
    all_scores = anchors.select("anchor_id", F.lit(0).alias("tag"), F.lit(LEAST).alias("lo"),
                                F.lit(MOST).alias("hi"))
    near = written(best(pages, dims, shards, anchors, all_scores, routes, positives, True, blocks)
                   .select("anchor_id", F.col("rank").alias("tag"),
                           F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "positives")
    score = F.col("positive_score")
    windows = near.select("anchor_id", "tag", percent(score, low, True).alias("lo"),
                          percent(score, high, False).alias("hi")).filter("lo <= hi")
    hits = best(pages, dims, shards, anchors, windows, None, negatives, False, blocks)
    return (hits.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .join(near, ["anchor_id", "tag"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings`` among all its rows."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("long").alias("label"), "embedding")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(quantised(rows.withColumn("label", other)), F.col("vec_id") % 100 == 0)

"""Near-duplicate vectors by iterative quantisation (operator 13).

A rotation is learned on a bounded sample (``SAMPLE_VALUES`` numbers, the vectors of the
smallest id hashes, of near duplicates among them the first): principal axes of the centred unit vectors, turned by iterative
quantisation so that signs lose least, with the sample's medians as thresholds, which
balances each bit. Every vector gets a 64-bit code; with fewer than 64 dimensions several
rotations from different starts stand side by side.

Codes are retrieved through multi-index Hamming tables: the code is cut into ``TABLES``
parts, a vector is indexed under each part and asks under each part with one zero bit set,
so a pair whose parts differ in at most one bit meets exactly once in a table. A pair is
counted in the first table in which it meets. Codes alone (8 bytes) are shuffled to the
tables; only rows with a partner within ``RADIUS`` bits are then sent their vectors, and
the original vectors decide by cosine. No pair leaves a task: a task gives each vector its
number of links and one edge to the first vector of its group, so a group of copies
makes rows in proportion to its members. A bucket of more than ``BUCKET`` rows is dealt
into blocks whose pairs are separate groups.

Equal vectors of a label are one class throughout and link with each other. Retrieval is
approximate (recall is measured by the tests), verification exact: no link is false.

Edge cases: rows without id, label or vector, with null or non-finite components, or with
a vector of zeros link with nothing (``component_id`` is their own id); vectors of fewer
components count as filled with zeros; repeated ids are separate vectors, equal ones link;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import components, join_keyed, small_enough, table, written
from concord.llm.vectors import finite, matrix, width

COSINE = 0.98
BITS = 64
TABLES = 4
PART = BITS // TABLES
#: Numbers (vectors x dimensions) on which the rotation is fitted, and its iterations.
SAMPLE_VALUES = 512_000
ITERATIONS = 40
#: Bits in which codes of a pair may differ to be compared by their vectors.
RADIUS = 20
#: Rows of one bucket that are compared at once.
BUCKET = 2048
#: Pairs held at once, by code and by vector.
CODE_PAIRS, VECTOR_PAIRS = 1 << 20, 1 << 15
#: From this size on the rows of a bucket are compared by matrix products.
DENSE = 48

KEYS = "cid long, m long, label long, code long, key int, probe boolean"


class Codes(NamedTuple):
    """The fitted quantiser: code = (unit - mean) @ turn > threshold."""

    mean: np.ndarray
    turn: np.ndarray
    threshold: np.ndarray


def unit(column, dims: int) -> np.ndarray:
    """Rows scaled to length 1 (all of them have one), in double precision."""
    x = matrix(column, dims)
    if len(x) and dims:
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x


def fit(sample: np.ndarray, seed: int = 13, iterations: int = ITERATIONS) -> Codes:
    """Iterative quantisation: rotate the principal axes until codes and values agree."""
    dims = sample.shape[1]
    mean = sample.mean(axis=0)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :min(BITS, dims)]
    v, turns, rng = x @ axes, [], np.random.default_rng(seed)
    while sum(t.shape[1] for t in turns) < BITS:
        r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
        for _ in range(iterations):
            left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (left @ right).T
        turns.append(axes @ r)
    turn = np.hstack(turns)[:, :BITS]
    return Codes(mean, turn, np.median(x @ turn, axis=0))


def encode(codes: Codes, units: np.ndarray) -> np.ndarray:
    """64-bit code of each unit vector."""
    bits = (units - codes.mean) @ codes.turn > codes.threshold
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def first_of_groups(units: np.ndarray, cosine: float, block: int = 1024) -> np.ndarray:
    """The vectors without a near duplicate before them: a group that holds a third of all
    rows would draw thresholds, and so the differences of codes, into its midst."""
    keep = np.ones(len(units), bool)
    for i in range(0, len(units), block):
        near = np.tril(units[i:i + block] @ units[:i + block].T >= cosine, i - 1)
        keep[i:i + block] = ~near.any(axis=1)
    return units[keep]


def learn(classes: DataFrame, dims: int, cosine: float) -> Codes | None:
    """The quantiser of a bounded sample of the classes (None: no vectors)."""
    rows = max(256, SAMPLE_VALUES // max(1, dims))
    sample = classes.orderBy(F.xxhash64("rep"), "rep", "key").limit(rows).select("embedding").toArrow()
    if not sample.num_rows or not dims:
        return None
    return fit(first_of_groups(unit(sample.column(0), dims), cosine))


def part_of(code: np.ndarray, number: int) -> np.ndarray:
    return (code >> np.uint64(PART * number)) & np.uint64((1 << PART) - 1)


def table_rows(classes: DataFrame, codes: Codes, dims: int) -> DataFrame:
    """(cid, m, label, code, key, probe): where each class is indexed and where it asks.

    ``key`` holds the table in its highest bits and the part of the code below.
    """
    model = classes.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate(([0], 1 << np.arange(PART))).astype(np.uint64)
        for batch in batches:
            code = encode(model.value, unit(batch.column("embedding"), dims))
            for number in range(TABLES):
                part = part_of(code, number)
                wanted = (part[:, None] & flips) == 0
                row, flip = np.nonzero(wanted)
                key = (part[row] | flips[flip]).astype(np.int32) + (number << PART)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(row)) for c in ("cid", "m", "label")),
                     pa.array(code[row].view(np.int64)), pa.array(key), pa.array(flip > 0)],
                    names=["cid", "m", "label", "code", "key", "probe"])

    return classes.select("cid", "m", "label", "embedding").mapInArrow(run, KEYS)


def bucket_blocks(rows: DataFrame, bucket: int) -> DataFrame:
    """(label, key, blocks) of the buckets that may hold more than ``bucket`` rows.

    Parts of the code found often are counted; what they ask for is added up by key, and
    the parts found seldom add at most half a bucket to any key.
    """
    least = max(1, bucket // (2 * (PART + 1)))
    often = rows.filter(~F.col("probe")).groupBy("label", "key").agg(
        F.count("*").alias("n")).filter(F.col("n") > least)
    part = F.col("key").bitwiseAND((1 << PART) - 1)
    asked = [F.when(part.bitwiseAND(1 << b) == 0, F.col("key").bitwiseOR(1 << b))
             for b in range(PART)]
    sums = often.select("label", "n", F.explode(F.array_compact(F.array("key", *asked))).alias("key"))
    size = F.sum("n") + bucket // 2
    return sums.groupBy("label", "key").agg(F.ceil(size / bucket).cast("int").alias("blocks")) \
        .filter("blocks > 1")


def in_cells(rows: DataFrame, bucket: int) -> DataFrame:
    """The rows with ``block``, ``cell`` and ``mixed``: a cell is a pair of blocks of a bucket,
    mixed if they are different ones."""
    blocks = written(bucket_blocks(rows, bucket), "itq-blocks")
    if small_enough(blocks, 1_000_000):
        blocks = F.broadcast(blocks)
    n = F.coalesce("blocks", F.lit(1))
    rows = rows.join(blocks, ["label", "key"], "left").withColumns(
        {"n": n.cast("long"), "block": F.pmod(F.xxhash64("cid"), n.cast("long"))})
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda x: F.struct(
        (F.least("block", x) * F.col("n") + F.greatest("block", x)).alias("cell"),
        (F.col("block") != x).alias("mixed")))
    return rows.select(*(c for c in rows.columns if c not in ("blocks", "n")),
                       F.inline(pairs))


def runs(batches: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of whole cells from rows sorted by (label, key, cell)."""
    held: list[pa.RecordBatch] = []

    def last_start(t: pa.Table) -> int:
        cols = [t.column(c).to_numpy() for c in ("label", "key", "cell")]
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        return int(np.flatnonzero(new)[-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            t = pa.Table.from_batches(held)
            at = last_start(t)
            if at:
                yield t.slice(0, at)
            held = t.slice(at).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


class Cells:
    """The rows of whole cells, sorted by cell, indexed rows first."""

    def __init__(self, rows: pa.Table):
        label, key, cell = (rows.column(c).to_numpy() for c in ("label", "key", "cell"))
        probe = rows.column("probe").to_numpy(zero_copy_only=False).astype(bool)
        cid = rows.column("cid").to_numpy()
        order = np.lexsort((cid, probe, cell, key, label))
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in (label, key, cell):
            new[1:] |= c[order][1:] != c[order][:-1]
        self.order = order
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(order))
        self.cid, self.probe = cid[order], probe[order]
        self.code = rows.column("code").to_numpy()[order].view(np.uint64)
        self.m = rows.column("m").to_numpy()[order]
        self.block = rows.column("block").to_numpy()[order]
        self.table = key[order] >> PART
        self.mixed = rows.column("mixed").to_numpy(zero_copy_only=False).astype(bool)[order]

    def counts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pairs are to be judged here: no earlier table has them, blocks fit."""
        fits = ~self.mixed[a] | (self.block[a] != self.block[b])
        other = self.code[a] ^ self.code[b]
        for number in range(TABLES - 1):
            near = np.bitwise_count(part_of(other, number)) <= 1
            fits &= ~(near & (self.table[a] > number))
        return fits

    def sparse_pairs(self, most: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (indexed row, later row) of the cells of at most ``longest`` rows."""
        size = self.end - self.start
        short = np.repeat((size > 1) & (size <= longest), size)
        row = np.flatnonzero(short & ~self.probe)
        after = np.repeat(self.end, size)[row] - row - 1
        row, after = row[after > 0], after[after > 0]
        upto = np.cumsum(after)
        i = 0
        while i < len(row):
            before = upto[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(upto, before + most, side="right")))
            n = after[i:j]
            a = np.repeat(row[i:j], n)
            yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            i = j

    def dense(self, longest: int) -> Iterator[tuple[int, int]]:
        for a, z in zip(self.start, self.end, strict=True):
            if z - a > longest:
                yield int(a), int(z)


def streamed(rows: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` over whole cells; a task reads its cells one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches):
            yield from work(part).to_batches()

    return (rows.repartition("label", "key", "cell").sortWithinPartitions("label", "key", "cell")
            .mapInArrow(run, schema))


def near_codes(rows: DataFrame, radius: int) -> DataFrame:
    """The rows that have a partner within ``radius`` bits in their cell."""
    def work(part: pa.Table) -> pa.Table:
        cells = Cells(part)
        keep = np.zeros(part.num_rows, bool)
        for a, b in cells.sparse_pairs(CODE_PAIRS, 1 << 62):
            close = np.bitwise_count(cells.code[a] ^ cells.code[b]) <= radius
            a, b = a[close], b[close]
            fits = cells.counts(a, b)
            keep[a[fits]] = keep[b[fits]] = True
        return part.take(pa.array(cells.order[keep]))

    return streamed(rows, work, ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))


def linked(rows: DataFrame, dims: int, cosine: float) -> DataFrame:
    """(cid, n, root): links of each class in each cell, and the first of its linked group."""
    def pairs(cells: Cells, units: np.ndarray):
        for a, b in cells.sparse_pairs(VECTOR_PAIRS, DENSE):
            fits = cells.counts(a, b)
            a, b = a[fits], b[fits]
            fits = (units[a] * units[b]).sum(axis=1) >= cosine
            yield a[fits], b[fits]
        for first, last in cells.dense(DENSE):
            index = first + np.flatnonzero(~cells.probe[first:last])
            for k in range(0, len(index), 256):
                part = index[k:k + 256]
                a, b = np.nonzero(units[part] @ units[first:last].T >= cosine)
                a, b = part[a], b + first
                later = b > a
                a, b = a[later], b[later]
                fits = cells.counts(a, b)
                yield a[fits], b[fits]

    def work(part: pa.Table) -> pa.Table:
        cells = Cells(part)
        units = unit(part.column("embedding"), dims)[cells.order]
        found = list(pairs(cells, units))
        a, b = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        n = np.zeros(part.num_rows, np.int64)
        np.add.at(n, a, cells.m[b])
        np.add.at(n, b, cells.m[a])
        root = np.arange(part.num_rows)
        while len(a):  # least row reachable in the cell: neighbours, then jumps
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = np.minimum(new, new[new])
            if (new == root).all():
                break
            root = new
        has = n > 0
        return pa.table({"cid": pa.array(cells.cid[has]), "n": pa.array(n[has]),
                         "root": pa.array(cells.cid[root[has]])})

    return streamed(rows, work, "cid long, n long, root long")


def content_keys(rows: DataFrame) -> DataFrame:
    """The rows with ``key``: the digest of label and vector (without trailing zeros)."""
    schema = rows.schema
    at = schema.names.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(schema.names.index("label")).to_pylist()
            vectors = batch.column(at)
            off = vectors.offsets.to_numpy()
            body = vectors.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # -0.0 is 0.0
            keys = [hashlib.sha256(b"%d:" % name + np.trim_zeros(body[a:z], "b").tobytes()).digest()
                    for name, a, z in zip(label, off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                             names=[*schema.names, "key"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.mapInArrow(run, fields + ", key binary")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, radius: int = RADIUS,
                    bucket: int = BUCKET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of rows (vec_id, label, embedding)."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("label").cast("long").alias("label"), "embedding")
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")
              & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
    keyed = written(content_keys(vectors.filter(usable)), "itq-rows")
    dims = width(keyed, "embedding")
    classes = written(keyed.groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.any_value("label").alias("label"),
        F.any_value("embedding").alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id()), "itq-classes")
    codes = learn(classes, dims, cosine)
    found = classes.limit(0).select("cid", F.col("m").alias("n"), F.col("cid").alias("root"))
    if codes is not None:
        rows = written(table_rows(classes, codes, dims), "itq-tables")
        close = written(near_codes(in_cells(rows, bucket), radius), "itq-close")
        with_vectors = close.join(classes.select("cid", "embedding"), "cid")
        found = written(linked(with_vectors, dims, cosine), "itq-links")
    groups = components(found.filter("cid <> root").select(
        F.col("cid").alias("a"), F.col("root").alias("b")).distinct(), "itq-cc")
    groups = groups.select(F.col("v").alias("cid"), F.col("label").alias("root"))
    least = (groups.join(classes.select("cid", "rep"), "cid").groupBy("root")
             .agg(F.min("rep").alias("least")))
    per = (found.groupBy("cid").agg(F.sum("n").alias("n")).join(groups, "cid", "left")
           .join(least, "root", "left").select("cid", "n", "least"))
    known = (classes.select("key", "cid", "rep", "m").join(per, "cid", "left")
             .select("key", "m", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("least", "rep").alias("component_id")))
    answers = join_keyed(keyed.select("vec_id", "key"), written(known, "itq-known"), "key", "m")
    alone = vectors.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return (answers.select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every row of ``embeddings``."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))

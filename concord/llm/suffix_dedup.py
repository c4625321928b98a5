"""Removal of repeated long byte strings by a run-length index (operator 3).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the collection. Texts are parsed first: every window of
``LENGTH`` bytes belongs to its minimiser (the least hash of its ``ANCHOR``
byte strings, leftmost of equals), and consecutive windows with one minimiser
and one offset bucket make a *phrase*. Equal windows have equal minimisers,
offsets and cores (the bytes that all windows of a bucket have in common), so
all occurrences of a window lie in phrases of one group, keyed by those.

The dictionary keeps each distinct phrase of a group once with its count. A
phrase that occurs twice is repeated as a whole; map tasks settle such repeats
among their own rows and forward one row, so copies shrink before the shuffle.
Groups with several distinct phrases are indexed: suffixes sorted by their
first ``LENGTH`` bytes, the Burrows-Wheeler transform over that order cut into
runs, and match lengths computed only at run ends, where the sampled text
position and its neighbour are compared. Inside a run the neighbour of p is one
past the neighbour of p - 1, so streaming ``M[p] = max(sample[p], M[p-1] - 1)``
through the text gives the length of the longest match elsewhere at every
position; positions with ``M >= LENGTH`` start a repeat.

Groups over ``GROUP_BYTES`` are never held whole: their windows are counted by
two independent 64-bit hashes with map-side aggregation instead.

Edge cases: a null text is empty; texts under ``LENGTH`` bytes keep all; equal
rows are copies of each other; ids may be null or repeated (rows are told apart
by id and text hash); other columns are ignored; an empty table gives an empty
result. Cutting bytes may leave invalid UTF-8, so kept bytes are returned raw.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm.common import table, written

LENGTH = 400
#: Offsets of a window from its minimiser run from 0 to LENGTH - ANCHOR.
ANCHOR = 17
#: Distinct phrases of one group that the grouping holds at once.
HELD = 1 << 20
CHUNK_BYTES = 2 << 20
#: Text bytes parsed at once (some 20 numbers of 8 bytes for each).
PARSED_BYTES = 1 << 18
GROUP_BYTES = 8 << 20
#: Numbers (8 bytes each) that a broadcast of spans or phrases may hold.
BROADCAST_NUMBERS = 4_000_000

ROWS = "g long, ph long, doc long, key int, s int, e int, occ int"
_NAMES = ["g", "ph", "doc", "key", "s", "e", "occ"]
_TYPES = [np.int64, np.int64, np.int64, np.int32, np.int32, np.int32, np.int32]


def bucket_width(length: int) -> int:
    """Offsets that share a bucket (128 of 400)."""
    return max(1, length * 8 // 25)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (block prefix and suffix minima)."""
    n = len(x)
    if n < width:
        return x[:0]
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = x
    grid = blocks.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


#: A second set of byte values, for hashes independent of those by ``K.BYTE_VALUE``.
OTHER_VALUE = K.mix(K.BYTE_VALUE, 29) | K.U64(1)


def prefix_hashes(raw: np.ndarray, values: np.ndarray = K.BYTE_VALUE) -> np.ndarray:
    """acc with hash of raw[a:b] = (acc[b] - acc[a]) * base**-a."""
    with np.errstate(over="ignore"):
        return np.concatenate((np.zeros(1, K.U64), np.cumsum(
            values[raw] * K.powers(int(K._BASE), len(raw)))))


def piece_hash(acc, a, b, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        inv = K.powers(K._INV, len(acc))
        return K.mix((acc[b] - acc[a]) * inv[a] ^ K.mix((b - a).astype(K.U64), 3), salt)


def phrases(data: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """(text, s, e, group, hash) of the phrases: window starts s..e of each text."""
    raw, base = data[off[0]:off[-1]], off - off[0]
    width = length - ANCHOR + 1
    starts = [np.arange(a, b - length + 1) for a, b in zip(base[:-1], base[1:], strict=True)
              if b - a >= length]
    if not starts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, K.U64),) * 2
    p = np.concatenate(starts)
    acc = prefix_hashes(raw)
    at = np.arange(len(raw) - ANCHOR + 1)
    grams = piece_hash(acc, at, at + ANCHOR, 61)
    low = K.U64(0xFFFFFFFF)
    q = (sliding_min((grams & ~low) | at.astype(K.U64), width) & low).astype(np.int64)[p]
    step = bucket_width(length)
    bucket = (q - p) // step
    new = np.ones(len(p), bool)
    new[1:] = (q[1:] != q[:-1]) | (bucket[1:] != bucket[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    s, e, q, bucket = p[first], p[last], q[first], bucket[first]
    core = q - bucket * step
    group = K.mix(piece_hash(acc, core, core + length - step + 1, 62)
                  ^ K.mix(grams[q] + bucket.astype(K.U64), 63), 64)
    text = np.searchsorted(base, s, side="right") - 1
    return text, s - base[text], e - base[text], group, piece_hash(acc, s, e + length, 65)


def settle(rows: list[np.ndarray]):
    """Settle repeats among the rows: (rows to forward, repeated whole phrases).

    Of the rows with one (g, ph) the first goes on with occ 2; all rows that
    were not settled before (occ 1) are repeated.
    """
    g, ph, occ = rows[0], rows[1], rows[6]
    order = np.lexsort((ph, g))
    rows = [x[order] for x in rows]
    g, ph, occ = rows[0], rows[1], rows[6]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (ph[1:] != ph[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(g)))
    many = np.repeat(count > 1, count)
    repeated = [x[many & (occ == 1)] for x in rows]
    kept = [x[at] for x in rows]
    kept[6] = np.where(count > 1, 2, kept[6]).astype(np.int32)
    return kept, repeated


def _batch(rows, span: bool) -> pa.RecordBatch:
    cols = [x.astype(t) for x, t in zip(rows, _TYPES, strict=True)]
    if span:
        cols[0], cols[6] = cols[2], np.zeros(len(cols[6]), np.int32)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=_NAMES)


def phrase_rows(docs: DataFrame, length: int) -> DataFrame:
    """Phrases (occ 1 or 2) and repeated whole phrases (occ 0) of (doc, key, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        for batch in batches:
            data, off = K.byte_column(batch.column(2))
            doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for i, j in K.pieces(off, PARSED_BYTES):
                text, s, e, g, ph = phrases(data, off[i:j + 1], length)
                parts.append([K.signed(g), K.signed(ph), doc[i + text], key[i + text], s, e,
                              np.ones(len(s), np.int32)])
            if not parts:
                continue
            kept, repeated = settle([np.concatenate(x) for x in zip(*parts, strict=True)])
            yield _batch(kept, False)
            yield _batch(repeated, True)

    return docs.mapInArrow(run, ROWS)


def grouped(rows: DataFrame) -> DataFrame:
    """Repeated phrases (occ 0), and the distinct phrases of groups with several of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        held = [np.zeros(0, t) for t in _TYPES]
        begun = None  # a group of which a part went out

        def close(rows_):
            kept, repeated = settle(rows_)
            g = kept[0]
            same = g == begun if begun is not None else np.zeros(len(g), bool)
            next_ = g[1:] == g[:-1]
            same[1:] |= next_
            same[:-1] |= next_
            yield _batch([x[same] for x in kept], False)
            yield _batch(repeated, True)

        for batch in batches:
            cols = [batch.column(k).to_numpy() for k in range(7)]
            done = cols[6] == 0
            if done.any():
                yield _batch([c[done] for c in cols], True)
            held = [np.concatenate(x) for x in zip(held, [c[~done] for c in cols], strict=True)]
            others = np.flatnonzero(held[0] != held[0][-1]) if len(held[0]) else held[0]
            if len(others):
                cut = int(others[-1]) + 1
                yield from close([x[:cut] for x in held])
                held = [x[cut:] for x in held]
            elif len(held[0]) > 1 << 16:  # one group so far: settle what is there
                held, repeated = settle(held)
                yield _batch(repeated, True)
                if len(held[0]) > HELD:  # equal phrases of two parts meet in the index
                    yield _batch(held, False)
                    begun, held = held[0][0], [x[:0] for x in held]
        if len(held[0]):
            yield from close(held)

    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(run, ROWS)


class RunIndex:
    """Run-length index over byte strings; see the module's description."""

    LEVELS = (8, 16, 32, 64, 128, 256)

    def __init__(self, strings: list[bytes], length: int):
        self.length = length
        self.text = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.left = np.repeat(self.ends, sizes) - np.arange(len(self.text))
        self.ranks: dict[int, np.ndarray] = {}
        self._rank()

    def _dense(self, keys, at) -> np.ndarray:
        rank = np.full(len(self.text), -1, np.int32)
        rank[at] = np.unique(keys, return_inverse=True)[1]
        return rank

    def _rank(self):
        n, length = len(self.text), self.length
        at = np.flatnonzero(self.left >= 8)
        word = np.zeros(n, np.uint64)
        for j in range(8):
            word[:n - j] = (word[:n - j] << np.uint64(8)) | self.text[j:]
        self.ranks[8] = self._dense(word[at], at)
        depth = 8
        for d in (*self.LEVELS[1:], length):
            if d <= depth or d > length:
                continue
            at = at[self.left[at] >= d]
            r = self.ranks[depth]
            key = (r[at].astype(np.int64) << 32) | r[at + d - depth]
            self.ranks[d], depth = self._dense(key, at), d
        while depth < length:  # lengths over twice the last level
            d = min(2 * depth, length)
            at = at[self.left[at] >= d]
            r = self.ranks[depth]
            key = (r[at].astype(np.int64) << 32) | r[at + d - depth]
            self.ranks[d], depth = self._dense(key, at), d
        self.suffixes = at[np.argsort(self.ranks[length][at], kind="stable")]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and b."""
        total = np.zeros(len(a), np.int64)
        most = np.minimum(self.left[a], self.left[b])
        for d in (*sorted(self.ranks, reverse=True), 1):
            r = self.ranks.get(d, self.text)
            live = most - total >= d
            while live.any():  # several steps only at the top, and up to seven single bytes
                live[live] = r[(a + total)[live]] == r[(b + total)[live]]
                total += d * live
                live &= most - total >= d
        return total

    def run_ends(self):
        """Neighbours (a, b) in suffix order that match and end a run of the transform."""
        order = self.suffixes
        rank = np.full(len(self.text), -2, np.int64)
        rank[order] = np.arange(len(order))
        r = self.ranks[self.length]
        pair = np.flatnonzero(r[order[1:]] == r[order[:-1]])
        a, b = order[pair], order[pair + 1]
        head = np.isin(a, self.starts) | np.isin(b, self.starts)
        before_a, before_b = np.maximum(a - 1, 0), np.maximum(b - 1, 0)
        inside = ~head & (self.text[before_a] == self.text[before_b]) & (
            rank[before_b] - rank[before_a] == 1)
        return a[~inside], b[~inside]

    def matches(self) -> np.ndarray:
        """At each position the longest match elsewhere, exact from ``length`` on."""
        a, b = self.run_ends()
        size = self.common(a, b)
        sample = np.zeros(len(self.text), np.int64)
        np.maximum.at(sample, a, size)
        np.maximum.at(sample, b, size)
        at = np.arange(len(self.text))
        return np.maximum.accumulate(sample + at) - at

    def repeats(self) -> list[list[tuple[int, int]]]:
        """For each string the ranges [a, b) of starts of repeated windows."""
        hit = (self.matches() >= self.length) & (self.left >= self.length)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        out: list[list[tuple[int, int]]] = [[] for _ in self.starts]
        for x, y in edge.reshape(-1, 2):
            while x < y:  # a run of hits may go on into the next string
                k = int(np.searchsorted(self.ends, x, side="right"))
                z = min(y, int(self.ends[k]))
                out[k].append((int(x - self.starts[k]), int(z - self.starts[k])))
                x = z
        return out


SPANS = "doc long, key int, a int, b int"
TEXTS = "g long, doc long, key int, s int, e int, occ int, body binary"


def _bounded(by_text: DataFrame, numbers: str) -> DataFrame:
    """Hint a broadcast if the counted size is under the bound; else the join shuffles."""
    total = by_text.agg(F.sum(F.expr(numbers)) + F.count("*")).first()[0] or 0
    return F.broadcast(by_text) if total <= BROADCAST_NUMBERS else by_text


def phrase_texts(docs: DataFrame, dictionary: DataFrame, length: int) -> DataFrame:
    """The dictionary with the bytes of each phrase, cut from the texts."""
    by_text = dictionary.groupBy("doc", "key").agg(
        F.collect_list(F.struct("g", "s", "e", "occ")).alias("list"))
    joined = docs.join(_bounded(by_text, "4 * size(list)"), ["doc", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        for batch in batches:
            data, off = K.byte_column(batch.column(2))
            doc, key = batch.column(0), batch.column(1)
            rows: list[list] = [[] for _ in range(7)]
            size = 0
            for k, items in enumerate(batch.column(3).to_pylist()):
                body = data[off[k]:off[k + 1]].tobytes()
                for x in items:
                    cut = body[x["s"]:x["e"] + length]
                    size += len(cut)
                    for col, v in zip(rows, (x["g"], doc[k].as_py(), key[k].as_py(), x["s"],
                                             x["e"], x["occ"], cut), strict=True):
                        col.append(v)
                if size > CHUNK_BYTES:
                    yield _texts(rows)
                    rows, size = [[] for _ in range(7)], 0
            yield _texts(rows)

    return joined.select("doc", "key", "text", "list").mapInArrow(run, TEXTS)


def _texts(rows) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(rows, types, strict=True)],
        names=["g", "doc", "key", "s", "e", "occ", "body"])


def _spans(doc, key, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(key, pa.int32()), pa.array(a, pa.int32()),
         pa.array(b, pa.int32())], names=["doc", "key", "a", "b"])


def indexed(texts: DataFrame, length: int) -> DataFrame:
    """Repeated spans found by the index, over whole groups in chunks of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        held: list[tuple] = []

        def close(rows):
            found = RunIndex([r[6] for r in rows], length).repeats()
            out = [(r[1], r[2], r[3] + x, r[3] + y - 1 + length)
                   for r, ranges in zip(rows, found, strict=True) if r[5] == 1
                   for x, y in ranges]
            cols = zip(*out, strict=True) if out else ([], [], [], [])
            return _spans(*(list(c) for c in cols))

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    if size >= CHUNK_BYTES:
                        yield close(held)
                        held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield close(held)

    return (texts.repartition("g").sortWithinPartitions("g").mapInArrow(run, SPANS))


def counted(texts: DataFrame, length: int) -> DataFrame:
    """Repeated spans of groups too large for one index: windows counted by two
    64-bit hashes of independent byte values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, at = np.frombuffer(row[6], np.uint8), np.arange(row[4] - row[3] + 1)
                h1, h2 = (piece_hash(prefix_hashes(raw, v), at, at + length, salt)
                          for v, salt in ((K.BYTE_VALUE, 71), (OTHER_VALUE, 72)))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(h1)), pa.array(K.signed(h2)),
                     pa.array(np.full(n, row[1])), pa.array(np.full(n, row[2], np.int32)),
                     pa.array((row[3] + at).astype(np.int32)),
                     pa.array(np.full(n, row[5], np.int32))],
                    names=["h1", "h2", "doc", "key", "p", "occ"])

    rows = written(texts.mapInArrow(
        run, "h1 long, h2 long, doc long, key int, p int, occ int"), "windows")
    many = rows.groupBy("h1", "h2").agg(F.sum("occ").alias("n")).filter("n > 1").select("h1", "h2")
    return (rows.filter("occ = 1").join(many, ["h1", "h2"], "left_semi")
            .select("doc", "key", F.col("p").alias("a"),
                    (F.col("p") + length).cast("int").alias("b")))


def repeated_spans(docs: DataFrame, length: int = LENGTH,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc, key, spans): for each text with repeats, the byte ranges to remove, merged."""
    found = written(grouped(phrase_rows(docs, length)), "phrases")
    whole = found.filter("occ = 0").select(
        "doc", "key", F.col("s").alias("a"), (F.col("e") + length).cast("int").alias("b"))
    dictionary = found.filter("occ > 0")
    heavy = dictionary.groupBy("g").agg(F.sum(F.col("e") - F.col("s") + length).alias("size"))
    heavy = written(heavy.filter(F.col("size") > group_bytes).select("g"), "heavy")
    light = dictionary.join(heavy, "g", "left_anti")
    spans = whole.union(indexed(phrase_texts(docs, light, length), length))
    if heavy.limit(1).count():
        rest = dictionary.join(heavy, "g", "left_semi")
        spans = spans.union(counted(phrase_texts(docs, rest, length), length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        for batch in batches:
            merged = []
            for pairs in batch.column(2).to_pylist():
                out: list[int] = []
                for a, b in sorted((x["a"], x["b"]) for x in pairs):
                    if out and a <= out[-1]:
                        out[-1] = max(out[-1], b)
                    else:
                        out += [a, b]
                merged.append(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(merged, pa.list_(pa.int32()))],
                names=["doc", "key", "spans"])

    by_text = spans.groupBy("doc", "key").agg(F.collect_set(F.struct("a", "b")).alias("list"))
    return written(by_text.mapInArrow(run, "doc long, key int, spans array<int>"), "spans")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"_text": text, "_key": F.hash(text),
                             "_doc": F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text))})


def inner(body: np.ndarray, spans: list[int]) -> list[int]:
    """The spans without the bytes of characters that they only hold in part."""
    out = []
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        while a < b and body[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(body) and body[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out += [a, b]
    return out


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        length: int = LENGTH, group_bytes: int = GROUP_BYTES,
        whole_characters: bool = False) -> DataFrame:
    """All columns of the documents with n_bytes, n_removed, n_spans and kept (binary).

    ``whole_characters``: spans shrink to whole UTF-8 characters, so kept is valid text.
    """
    rows = keyed(docs.drop("n_bytes", "n_removed", "n_spans", "kept"), id_col, text_col)
    spans = repeated_spans(rows.select(F.col("_doc").alias("doc"), F.col("_key").alias("key"),
                                       F.col("_text").alias("text")), length, group_bytes)
    spans = spans.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"),
                         F.col("spans").alias("_spans"))
    joined = rows.join(_bounded(spans, "size(_spans)"), ["_doc", "_key"], "left").drop(
        "_doc", "_key")
    schema = joined.schema
    text_at, spans_at = schema.names.index("_text"), schema.names.index("_spans")
    keep = [k for k in range(len(schema)) if k not in (text_at, spans_at)]
    names = [schema.names[k] for k in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("strings")
        for batch in batches:
            data, off = K.byte_column(batch.column(text_at))
            n, kept = [], []
            for k, spans_ in enumerate(batch.column(spans_at).to_pylist()):
                body = data[off[k]:off[k + 1]]
                at = inner(body, spans_ or []) if whole_characters else spans_ or []
                if at:
                    edges = [0, *at, len(body)]
                    kept.append(b"".join(body[a:b].tobytes() for a, b in
                                         zip(edges[::2], edges[1::2], strict=True)))
                else:
                    kept.append(body.tobytes())
                n.append((len(body), len(body) - len(kept[-1]), len(at) // 2))
            cols = [batch.column(k) for k in keep]
            cols += [pa.array([x[i] for x in n], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(kept, pa.binary())],
                names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    out = ", ".join([*(f"`{schema.names[k]}` {schema[k].dataType.simpleString()}" for k in keep),
                     "n_bytes long", "n_removed long", "n_spans long", "kept binary"])
    return joined.mapInArrow(run, out)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every row of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                            F.sha2("kept", 256).alias("kept_sha256"))

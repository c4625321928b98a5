"""Benchmark decontamination by Wu-Manber search (operator 10).

Symbols are normalised words. A pattern is a window of ten consecutive words
of a benchmark item (or the whole item if it has one to nine words). For each
pattern length there is one Wu-Manber searcher: a table of block shifts (two
words to a block), buckets of patterns by the hash of their last block, and a
direct comparison of the words of a candidate. Texts are cut into lanes of
window ends, and all lanes of a piece advance together, each by its own shift.

The patterns are the query set: they are taken in blocks of a bounded number
of windows (``BLOCK``); every block is searched in all rows. Blocks are chained
over the same partitions, so no text is ever shuffled.

Edge cases: null and empty texts have no words and are never contaminated; an
item without words has no window; items with a null id mark words but are not
listed; equal item ids count once; repeated documents are separate rows; all
columns of the documents are carried along and the results are appended under
``RESULTS`` (a column of the documents by such a name is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import kernels as K
from concord.llm.common import table

WINDOW = 10
#: Distinct windows that are broadcast and searched at once (about 100 bytes each).
BLOCK = 200_000
#: Window ends that one lane covers.
LANE = 256
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_INSIDE = K.alnum_or_high()


def windows_of(words: list[bytes], width: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    if len(words) < width:
        return [tuple(words)]
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def normalised(text: bytes) -> list[bytes]:
    raw = np.frombuffer(text, np.uint8)
    folded = K.LOWER[raw].tobytes()
    starts, ends, _ = K.spans(raw, np.array([0, len(raw)]), _INSIDE)
    return [folded[s:e] for s, e in zip(starts, ends, strict=True)]


def pattern_rows(benchmark: DataFrame, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(words, items): each distinct window with the ids of the items that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                for w in {b" ".join(x) for x in windows_of(normalised((text or "").encode()))}:
                    ids.append(item)
                    keys.append(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(keys, pa.binary())],
                names=["item_id", "words"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"),
                            F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "item_id string, words binary")
            .groupBy("words").agg(F.collect_set("item_id").alias("items")))


class Searcher:
    """Wu-Manber tables of patterns with the same number of words."""

    BITS = 16

    def __init__(self, patterns: list[tuple[bytes, ...]], numbers: list[int]):
        self.m = m = len(patterns[0])
        self.b = min(2, m)
        words, numbers = patterns, np.array(numbers)
        data, off = K.byte_column(pa.array([w for p in words for w in p], pa.binary()))
        values = K.BYTE_VALUE[data]
        self.hashes = K.run_hashes(values, off[:-1], off[1:]).reshape(len(words), m)
        self.shift = np.full(1 << self.BITS, m - self.b + 1, np.int64)
        for j in range(self.b - 1, m):
            slot = self.slots(self.block(self.hashes, j))
            np.minimum.at(self.shift, slot, m - 1 - j)
        last = self.block(self.hashes, m - 1)
        order = np.argsort(last)
        self.hashes, self.numbers = self.hashes[order], numbers[order]
        self.words = [words[i] for i in order]
        self.bucket = last[order]

    def block(self, table: np.ndarray, j: int) -> np.ndarray:
        return self.pair(table[:, j - 1] if self.b == 2 else None, table[:, j])

    @staticmethod
    def pair(before, at):
        with np.errstate(over="ignore"):
            return K.mix(at if before is None else before * K._MUL + at, 21)

    def slots(self, block):
        return (block >> K.U64(64 - self.BITS)).astype(np.int64)

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Ends of windows whose last block may be that of a pattern."""
        lo, hi = first[:-1] + self.m - 1, first[1:]
        lo, hi = lo[lo < hi], hi[lo < hi]
        count = (hi - lo + LANE - 1) // LANE
        lane = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(lo, count) + lane * LANE
        end = np.minimum(at + LANE, np.repeat(hi, count))
        found = []
        while len(at):
            block = self.pair(words[at - 1] if self.b == 2 else None, words[at])
            step = self.shift[self.slots(block)]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
                step[zero] = 1
            at = at + step
            live = at < end
            if not live.all():
                at, end = at[live], end[live]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, words, first, word_bytes) -> tuple[np.ndarray, np.ndarray]:
        """(end word, pattern number) of each occurrence."""
        at = self.candidates(words, first)
        if not len(at):
            return at, at
        block = self.pair(words[at - 1] if self.b == 2 else None, words[at])
        lo = np.searchsorted(self.bucket, block, "left")
        n = np.searchsorted(self.bucket, block, "right") - lo
        at, which = np.repeat(at, n), np.repeat(lo, n)
        which = which + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        same = np.ones(len(at), bool)
        for j in range(self.m):
            same &= self.hashes[which, j] == words[at - self.m + 1 + j]
        at, which = at[same], which[same]
        exact = [all(word_bytes(a - self.m + 1 + j) == w for j, w in enumerate(self.words[k]))
                 for a, k in zip(at, which, strict=True)]
        exact = np.array(exact, bool)
        return at[exact], self.numbers[which[exact]]


def searchers(block: list[tuple[bytes, list[str]]]) -> list[Searcher]:
    by_length: dict[int, list[int]] = {}
    split = [tuple(w.split(b" ")) for w, _ in block]
    for k, p in enumerate(split):
        by_length.setdefault(len(p), []).append(k)
    return [Searcher([split[k] for k in ks], ks) for ks in by_length.values()]


def hits(data, off, found: list[Searcher]):
    """(number of words of each text, texts, first words, ends, patterns of occurrences)."""
    starts, ends, first = K.spans(data, off, _INSIDE)
    raw = K.LOWER[data[off[0]:off[-1]]]
    words = K.run_hashes(K.BYTE_VALUE[raw], starts, ends)
    at, who, size = [], [], []
    for s in found:
        a, w = s.search(words, first, lambda i: raw[starts[i]:ends[i]].tobytes())
        at.append(a)
        who.append(w)
        size.append(np.full(len(a), s.m))
    at = np.concatenate(at) if at else np.zeros(0, np.int64)
    who = np.concatenate(who) if who else at
    size = np.concatenate(size) if size else at
    text = np.searchsorted(first, at, side="right") - 1
    start = at - size + 1 - first[text]
    return np.diff(first), text, start, start + size, who


def covered(spans: str):
    """Words inside any of the spans of a column ``[start, end, start, end, ...]`` (null: none)."""
    pairs = (f"array_sort(transform(sequence(0, size({spans}) div 2 - 1), "
             f"k -> struct({spans}[2 * k] AS a, {spans}[2 * k + 1] AS b)))")
    return F.expr(f"""CASE WHEN size({spans}) > 0 THEN aggregate(
      {pairs}, struct(0L AS total, 0 AS right),
      (s, x) -> struct(s.total + greatest(0, x.b - greatest(x.a, s.right)) AS total,
                       greatest(s.right, x.b) AS right), s -> s.total) ELSE 0L END""")


def _search_block(rows: DataFrame, block: list[tuple[bytes, list[str]]]) -> DataFrame:
    """Append the occurrences of one block of patterns to ``_spans`` and ``_items``."""
    schema = rows.schema
    names = schema.names
    text_at, n_at, spans_at, items_at = (names.index(c) for c in (
        "_text", "_n", "_spans", "_items"))
    kept = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = searchers(kept.value)
        items_of = [i for _, i in kept.value]
        for batch in batches:
            data, off = K.byte_column(batch.column(text_at))
            for i, j in K.pieces(off):
                part = batch.slice(i, j - i)
                n, text, a, b, who = hits(data, off[i:j + 1], found)
                spans, items = part.column(spans_at).to_pylist(), part.column(items_at).to_pylist()
                for t, x, y, k in zip(text, a, b, who, strict=True):
                    spans[t] = (spans[t] or []) + [int(x), int(y)]
                    items[t] = sorted({*(items[t] or []), *items_of[k]})
                cols = part.columns
                cols[n_at] = pa.array(n, pa.int64())
                cols[spans_at] = pa.array(spans, pa.list_(pa.int32()))
                cols[items_at] = pa.array(items, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return rows.mapInArrow(run, schema)


def _digest(rows: DataFrame) -> DataFrame:
    """The results of the occurrences; no second Python worker beside that of the search."""
    items = F.array_sort(F.coalesce("_items", F.array().cast("array<string>")))
    return rows.withColumns({
        "n_words": F.coalesce("_n", F.lit(0).cast("long")),
        "n_hit": covered("_spans"), "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", items).cast("binary"), 256),
    }).withColumn("contaminated", F.col("n_hit") > 0).drop("_text", "_n", "_spans", "_items")


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
         block: int = BLOCK) -> DataFrame:
    """The documents with ``RESULTS`` appended."""
    patterns = pattern_rows(benchmark).persist()
    total = patterns.count()
    rows = docs.drop(*RESULTS).withColumns({
        "_text": F.col(text_col).cast("string"), "_n": F.lit(None).cast("long"),
        "_spans": F.lit(None).cast("array<int>"), "_items": F.lit(None).cast("array<string>")})
    rows = rows.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema]))
    parts = max(1, -(-total // block))
    for k in range(parts):
        one = patterns if parts == 1 else patterns.filter(
            F.pmod(F.xxhash64("words"), F.lit(parts)) == k)
        rows = _search_block(rows, [(bytes(r.words), list(r["items"])) for r in one.collect()])
    patterns.unpersist()
    return _digest(rows)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all ``benchmark`` windows in every row of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, table(spark, sf_dir, "benchmark")).select("doc_id", *RESULTS)

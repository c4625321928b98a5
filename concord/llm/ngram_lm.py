"""Interpolated modified Kneser-Ney n-gram models as tables (for operators 1 and 6).

Tokens are the words of a text (``Words``: maximal runs without blanks, lower-cased
A-Z; the registered queries use them) or its UTF-8 bytes (``Bytes``); ``order - 1``
start symbols precede every text. A gram is two numbers whose digits are its
symbols: the last ``63 // bits`` symbols in ``gram``, the ones before in ``hi``.
Counting is a map-side aggregation followed by one shuffle; discounts, context sums
and the interpolation are grouped aggregations and joins on (model, hi, gram), which
shard every level of the model by its key. The result holds the loss of each distinct
gram of the corpus, so the size of a model follows the corpus, not a cap.

Scoring joins the gram counts of each document with the losses; no model passes
through the driver. Sums are taken over whole numbers (counts, and losses in steps
of 2 ** -30), so results do not depend on the order or number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm.common import broadcast_if_small, small_enough, written

ORDER = 5
START = 0
#: Steps of a loss in one nat; sums are exact up to 2 ** 33 nats a text.
STEPS = 1 << 30
#: Words found less often in all documents are one unknown symbol.
LEAST_WORDS = 5
#: Words that a task counts together.
HELD_WORDS = 1 << 19

KEY = ["model", "hi", "gram"]
COUNTS = "model string, hi long, gram long, every long, chosen long"


def identity() -> np.ndarray:
    return np.arange(256, dtype=np.uint8)


class Bytes:
    """The bytes of a text, mapped to at most 256 symbols."""

    bits = 8

    def __init__(self, symbols: np.ndarray | None = None):
        self.symbols = identity() if symbols is None else symbols
        self.size = len(np.unique(self.symbols))

    def tokens(self, data: np.ndarray, off: np.ndarray):
        """(symbol of each token, number of the first token of each text)."""
        return self.symbols[data[off[0]:off[-1]]].astype(np.int64), off - off[0]


class Words:
    """The words of a text; words outside the vocabulary are one unknown symbol.

    A word is in the vocabulary when all texts hold it at least ``least`` times and it
    is among the ``MOST`` most frequent ones (ties by hash).
    """

    bits = 21
    MOST = (1 << 21) - 2
    UNKNOWN = 1

    def __init__(self, texts: DataFrame, least: int):
        counts = written(word_counts(texts), "words")
        words = counts.filter(F.col("n") >= least)
        if not small_enough(words, self.MOST):
            words = words.orderBy(F.desc("n"), "word").limit(self.MOST)
        found = words.toArrow()  # at most MOST rows reach the driver
        word, n = (found.column(k).to_numpy().astype(np.int64) for k in ("word", "n"))
        by = np.argsort(word)
        word, n = word[by], n[by]
        symbol = np.empty(len(word), np.int32)
        symbol[np.lexsort((word, -n))] = np.arange(len(word)) + 2  # frequent words: low numbers
        self.size = len(word) + 1
        broadcast = texts.sparkSession.sparkContext.broadcast
        self.kept, self.symbol, self.begin = broadcast(word), broadcast(symbol), None

    def tokens(self, data: np.ndarray, off: np.ndarray):
        """(symbol of each token, number of the first token of each text)."""
        hashes, first = K.word_hashes(data, off, K.not_space())
        hashes, kept = K.signed(hashes), self.kept.value
        if not len(kept):
            return np.full(len(hashes), self.UNKNOWN, np.int64), first
        shift = 64 - len(kept).bit_length()
        if self.begin is None:  # first place of the hashes of each range
            half = 1 << (63 - shift)
            self.begin = np.searchsorted(kept >> shift, np.arange(-half, half + 1)).astype(np.int32)
        cell = (hashes >> shift) + (len(self.begin) >> 1)
        at, end = self.begin[cell], self.begin[cell + 1]
        out, rest = np.full(len(hashes), self.UNKNOWN, np.int64), np.flatnonzero(at < end)
        while len(rest):  # as often as a range has hashes at most
            place = at[rest]
            same = kept[place] == hashes[rest]
            out[rest[same]] = self.symbol.value[place[same]]
            rest = rest[~same]
            at[rest] += 1
            rest = rest[at[rest] < end[rest]]
        return out, first


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): hash and number of each distinct word of the texts."""
    def merged(held):
        words, n = (np.concatenate(c) for c in zip(*held, strict=True))
        words, back = np.unique(words, return_inverse=True)
        return words, np.bincount(back, n, len(words)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, off = K.byte_column(batch.column(0))
            for i, j in K.pieces(off):
                hashes, _ = K.word_hashes(data, off[i:j + 1], K.not_space())
                held.append(np.unique(K.signed(hashes), return_counts=True))
                size += len(held[-1][0])
                if size > HELD_WORDS:
                    held = [merged(held)]
                    size = len(held[0][0])
                if size > HELD_WORDS // 2 and len(held) == 1:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])),
                                                     names=["word", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, merged(held))),
                                             names=["word", "n"])

    return (texts.select("text").mapInArrow(run, "word long, n long").groupBy("word")
            .agg(F.sum("n").alias("n")))


def gram_codes(data: np.ndarray, off: np.ndarray, order: int, unit):
    """(hi, gram) that ends at each token, text of each token, tokens of each text."""
    ids, first = unit.tokens(data, off)
    size, per = np.diff(first), 63 // unit.bits
    assert order <= 2 * per
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(ids)) - np.repeat(first[:-1], size)
    code = [ids.copy(), np.zeros(len(ids), np.int64)]
    for j in range(1, order):
        before = np.zeros(len(ids), np.int64)
        before[j:] = ids[:max(0, len(ids) - j)]
        before[place < j] = START
        code[j // per] |= before << (unit.bits * (j % per))
    return code[1], code[0], text, size


def distinct(*columns: np.ndarray):
    """(place of the first row of each group of equal rows, group of each row)."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def gram_counts(rows: DataFrame, order: int = ORDER, unit=None) -> DataFrame:
    """(model, hi, gram, every, chosen) from rows (model, chosen, text): counts over all
    rows and over those marked as chosen."""
    unit = unit or Bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            models = {m: k for k, m in enumerate(dict.fromkeys(names))}
            which = np.array([models[m] for m in names], np.int64)
            chosen = np.array(batch.column(1).to_pylist(), bool)
            data, off = K.byte_column(batch.column(2))
            names = np.array([*models, None], object)
            for i, j in K.pieces(off):
                hi, gram, text, _ = gram_codes(data, off[i:j + 1], order, unit)
                model = which[i:j][text]
                at, group = distinct(model, hi, gram)
                every = np.bincount(group, minlength=len(at))
                some = np.bincount(group, chosen[i:j][text], len(at)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[model[at]], pa.string()), pa.array(hi[at]),
                     pa.array(gram[at]), pa.array(every), pa.array(some)],
                    names=["model", "hi", "gram", "every", "chosen"])

    rows = rows.select(F.coalesce(F.col("model").cast("string"), F.lit("")).alias("model"),
                       F.coalesce("chosen", F.lit(False)).alias("chosen"), "text")
    return (rows.mapInArrow(run, COUNTS).groupBy(*KEY)
            .agg(F.sum("every").alias("every"), F.sum("chosen").alias("chosen")))


def suffix(symbols: int, bits: int) -> list[Column]:
    """(hi, gram) of the last symbols of a gram."""
    def low(name: str, n: int):
        return F.col(name).bitwiseAND(F.lit((1 << (bits * n)) - 1)).alias(name)

    per = 63 // bits
    if symbols <= per:
        return [F.lit(0).cast("long").alias("hi"), low("gram", symbols)]
    return [low("hi", symbols - per), F.col("gram")]


def context(bits: int) -> list[Column]:
    """(c_hi, c_gram): the gram without its last symbol."""
    carry = F.shiftleft(F.col("hi").bitwiseAND(F.lit((1 << bits) - 1)), bits * (63 // bits - 1))
    return [F.shiftright("hi", bits).alias("c_hi"),
            F.shiftright("gram", bits).bitwiseOR(carry).alias("c_gram")]


def levels(counts: DataFrame, order: int, bits: int) -> list[DataFrame]:
    """(model, hi, gram, a) for gram lengths 1..order: counts at the top, below it the
    number of different symbols that precede a gram in the training text (0: only scored)."""
    out = [counts.select(*KEY, F.col("n").alias("a"))]
    for k in range(order - 1, 0, -1):
        shorter = out[0].select("model", *suffix(k, bits), (F.col("a") > 0).cast("long").alias("a"))
        shorter = shorter.groupBy(*KEY).agg(F.sum("a").alias("a"))
        out.insert(0, written(shorter, f"lm-{k}"))  # read three times, and by the next level
    return out


def discounts(level: DataFrame) -> DataFrame:
    """(model, d1, d2, d3): the modified Kneser-Ney discounts from counts of counts.

    Where a count of counts is zero the discount falls back to half of its count
    number's step; discounts lie between 0.1 and their count, so no mass is zero.
    """
    n = [F.sum((F.col("a") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    raw = [F.when((F.col(f"n{k}") > 0) & (F.col("n1") > 0) & (F.col(f"n{k + 1}") > 0),
                  k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(0.5 * k)
           for k in (1, 2, 3)]
    return level.groupBy("model").agg(*n).select("model", *(
        F.greatest(F.lit(0.1), F.least(F.lit(k * 1.0), r)).alias(f"d{k}")
        for k, r in zip((1, 2, 3), raw, strict=True)))


def losses(counts: DataFrame, order: int, unit) -> DataFrame:
    """(model, hi, gram, loss): natural-log loss of the last symbol of each gram.

    ``counts``: (model, hi, gram, n) with the count of each gram in the training text,
    0 for grams that are only scored. Below the shortest gram lies the uniform
    distribution over the vocabulary; an unseen context passes its whole mass down. A
    model without counts is uniform.
    """
    below = None
    for k, level in enumerate(levels(counts, order, unit.bits), 1):
        d = broadcast_if_small(written(discounts(level), f"lm-d-{k}"), 100_000)  # one a model
        cut = (F.when(F.col("a") == 0, 0.0).when(F.col("a") == 1, F.col("d1"))
               .when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3")))
        grams = level.join(d, "model").select(
            *KEY, *context(unit.bits), "a", cut.alias("cut"))
        of = ["model", "c_hi", "c_gram"]
        once, twice = (F.sum((F.col("a") == n).cast("long")) for n in (1, 2))
        sums = grams.filter("a > 0").groupBy(*of).agg(
            F.sum("a").alias("total"), once.alias("once"), twice.alias("twice"),
            (F.count("*") - once - twice).alias("more"))
        sums = sums.join(d, "model").select(*of, "total", F.expr(
            "(once * d1 + twice * d2 + more * d3) / total").alias("pass"))
        if k == 1:  # one context a model
            sums = broadcast_if_small(written(sums, "lm-c-1"), 100_000)
        p = grams.join(sums, of, "left")
        if below is None:
            p = p.withColumn("low", F.lit(1.0 / unit.size))
        else:
            s_hi, s_gram = suffix(k - 1, unit.bits)
            p = p.withColumns({"s_hi": s_hi, "s_gram": s_gram}).join(
                below.withColumnsRenamed({"hi": "s_hi", "gram": "s_gram", "p": "low"}),
                ["model", "s_hi", "s_gram"], "left")
        here = (F.coalesce((F.col("a") - F.col("cut")) / F.col("total"), F.lit(0.0))
                + F.coalesce("pass", F.lit(1.0)) * F.col("low")).alias("p")
        below = p.select(*KEY, here)
        if k < order:
            below = written(below, f"lm-low-{k}")
    return below.select(*KEY, (-F.log("p")).alias("loss"))


def score(rows: DataFrame, table_: DataFrame, values: int, order: int = ORDER,
          unit=None) -> DataFrame:
    """The rows (with columns model and text) without text, with n_tokens and sums.

    ``table_``: (model, hi, gram, values array<double>) with ``values`` numbers a gram;
    sums are over the tokens of a text. A row is known by two 64-bit hashes; the counts
    of each of its grams, and one row more for itself, meet the table in a join.
    """
    unit = unit or Bytes()
    carried = [c for c in rows.columns if c != "text"]
    rows = rows.withColumn("model", F.coalesce(F.col("model").cast("string"), F.lit("")))
    cells = [*carried, "text", F.col("text").isNull()]
    rows = rows.withColumns({"_a": F.xxhash64(*cells), "_b": F.xxhash64(F.lit(1), *cells)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = K.byte_column(batch.column(3))
            for i, j in K.pieces(off):
                hi, gram, text, _ = gram_codes(data, off[i:j + 1], order, unit)
                at, group = distinct(text, hi, gram)
                part = batch.slice(i, j - i)
                row = pa.array(np.concatenate((np.arange(j - i), text[at])))
                own = np.full(j - i, -1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(row) for c in range(3)),
                     pa.array(np.concatenate((own, hi[at]))),
                     pa.array(np.concatenate((part.column(0).to_numpy(), gram[at]))),
                     pa.array(np.concatenate((0 * own, np.bincount(group, minlength=len(at)))))],
                    names=["_a", "_b", "model", "hi", "gram", "n"])

    schema = "_a long, _b long, model string, hi long, gram long, n long"
    grams = rows.select("_a", "_b", "model", "text").mapInArrow(run, schema)
    steps = [F.round(F.coalesce(F.col("values")[v], F.lit(0.0)) * STEPS).cast("long")
             for v in range(values)]
    sums = [F.sum(F.col("n") * s) for s in steps]
    copies = F.sum((F.col("hi") == -1).cast("long"))  # rows equal in all columns
    by_text = (grams.join(table_, KEY, "left").groupBy("_a", "_b")
               .agg((F.sum("n") / copies).cast("long").alias("n_tokens"),
                    F.array(*(s / copies / STEPS for s in sums)).alias("sums")))
    return (rows.select(*carried, "_a", "_b").join(by_text, ["_a", "_b"])
            .select(*carried, "n_tokens", "sums"))

"""Kneser-Ney losses of texts over words, a bucket of contexts at a time (operators 1 and 6).

The model is that of ``ngram_lm``: interpolated modified Kneser-Ney, its grams those of the
training texts. Words make nearly as many different grams as there are tokens, so neither the
grams nor their counts become rows. A gram goes to the bucket of its context; one that shares
the last words of its context meets it there, so counts, sums of contexts and the
interpolation of all levels from there on are array operations inside the bucket.

Buckets. The last word of the context decides; where that word precedes more than ``HOT``
tokens, the last two, or the last three. Counts of the levels below, whose contexts are then
spread over buckets, are summed up in tables. The table of the empty context, one row a word
and model, is broadcast; that of a hot context goes to the buckets of its grams, of which
there are as many as it has ``HOT`` tokens.

Two rounds. The first, over the training texts, gives the discounts and those tables, the
second the losses, summed up by text inside the bucket. Each round goes through its buckets in
parts; grams travel as compressed columns, and the shuffle files of a part go before the next
begins, so the disk holds the coded texts and one part. Sums are taken over whole numbers
(losses in steps of 2 ** -30), so results do not depend on the order or number of tasks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm import ngram_lm as L
from concord.llm.common import written

BITS = L.Words.bits
MASK = (1 << BITS) - 1
#: Tokens of a bucket, on average, and tokens of a context from which it is spread.
BUCKET, HOT = 1 << 19, 1 << 20
#: Tokens of a chunk of texts, whose grams are put together for each bucket.
CHUNK = 1 << 21
#: Words of the longest hot context.
HOT_WORDS = 2
#: Parts of the second round; the first has a third of them.
PARTS = 6

#: Models whose buckets of words a worker holds.
MODELS = 32

_ODD = K.U64(0x9E3779B97F4A7C15)
_EACH = 3  # bytes of a symbol
_DOC = 4   # bytes of a text's number in its chunk and its mark


def _codec():
    return pa.Codec("zstd", compression_level=1)


def planes(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of whole numbers, one row a byte."""
    return np.stack([(values >> (8 * b)).astype(np.uint8) for b in range(width)])


def joined(rows: np.ndarray, kind=np.int32) -> np.ndarray:
    """The whole numbers of ``planes``."""
    out = rows[0].astype(kind)
    for b in range(1, len(rows)):
        out |= rows[b].astype(kind) << (8 * b)
    return out


def coded(rows: DataFrame, unit) -> DataFrame:
    """The rows with the symbols of their text (``ids``, byte by byte) in its place, ``n_tokens``,
    a number (``_at``) and the hash of the model."""
    rows = rows.withColumns({"_at": F.monotonically_increasing_id(),
                             "_model": F.xxhash64("model")})
    schema = rows.drop("text").schema
    names = [*schema.names, "n_tokens", "ids"]
    keep, text = [rows.columns.index(c) for c in schema.names], rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = K.byte_column(batch.column(text))
            for i, j in K.pieces(off):
                ids, first = unit.tokens(data, off[i:j + 1])
                size, part = np.diff(first), batch.slice(i, j - i)
                at = _EACH * np.repeat(first[:-1], size) + np.arange(len(ids)) - np.repeat(
                    first[:-1], size)
                body, step = np.zeros(_EACH * len(ids), np.uint8), np.repeat(size, size)
                for b, row in enumerate(planes(ids, _EACH)):
                    body[at + b * step] = row
                body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [
                    None, pa.py_buffer(_EACH * first.astype(np.int64)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(size.astype(np.int64)),
                     body.cast(pa.binary())], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    return rows.mapInArrow(run, ", ".join([*fields, "n_tokens long", "ids binary"]))


class Chunk:
    """Texts whose grams are put together: the number of the first, numbers of all from there,
    their models and marks; the text and the symbol of each token."""

    def __init__(self, at, model, chosen, data, off):
        self.base, self.number = int(at[0]), at - at[0]
        self.model, self.chosen = model.astype(np.int64), chosen
        size = (np.diff(off) // _EACH).astype(np.int32)
        self.first = (np.cumsum(size) - size).astype(np.int32)
        self.text = np.repeat(np.arange(len(at), dtype=np.int32), size)
        place = np.arange(off[0], off[0] + len(self.text)) + np.repeat(
            (_EACH - 1) * self.first, size)
        step, rows = np.repeat(size, size), []
        for _ in range(_EACH):
            rows.append(data[place])
            place += step
        self.ids = joined(rows)
        self.last = np.full(len(self.ids), L.START, np.int32)
        self.last[1:] = self.ids[:-1]
        self.last[self.first[size > 0]] = L.START

    def before(self, j: int, at: np.ndarray) -> np.ndarray:
        """What stands ``j`` places before some tokens."""
        out = self.ids[np.maximum(at - j, 0)]
        out[at - self.first[self.text[at]] < j] = L.START
        return out


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        at, model = (batch.column(k).to_numpy() for k in (0, 1))
        chosen = batch.column(2).to_numpy(zero_copy_only=False)
        data, off = K.byte_column(batch.column(3))
        for i, end in K.pieces(off, _EACH * CHUNK):
            cuts = np.flatnonzero(np.diff(at[i:end] >> 30)) + i + 1  # numbers fit their bytes
            for a, b in zip([i, *cuts], [*cuts, end], strict=True):
                yield Chunk(at[a:b], model[a:b], chosen[a:b], data, off[a:b + 1])


TEXTS = ("_at", "_model", "chosen", "ids")


def hot_contexts(texts: DataFrame, order: int, total: int) -> list[tuple[int, int, int, int]]:
    """(model, words, context, tokens) of the contexts of at least some ``HOT`` tokens.

    A context that has its share of all tokens has half of it in the chunks where it has half
    its share or more; only those counts leave a task.
    """
    longest = min(HOT_WORDS, order - 2)
    if longest < 1 or total < HOT:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            names, number = np.unique(chunk.model, return_inverse=True)
            least = max(1, HOT / 2 / total * len(chunk.ids))
            key, rows = number[chunk.text] << BITS | chunk.last, None
            for words in range(1, longest + 1):
                found, n = np.unique(key, return_counts=True)
                found, n = found[n >= least], n[n >= least]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[found >> (BITS * words)]),
                     pa.array(np.full(len(n), words, np.int32)),
                     pa.array(context_of(found, words)), pa.array(n)],
                    names=["model", "words", "context", "n"])
                if words < longest:
                    stays = np.flatnonzero(np.isin(key, found))
                    rows = stays if rows is None else rows[stays]
                    key = key[stays] << BITS | chunk.before(words + 1, rows)

    def context_of(key, words):
        out = np.zeros(len(key), np.int64)
        for j in range(words):  # the last word lies highest in the key, lowest in the context
            out |= ((key >> (BITS * (words - 1 - j))) & MASK) << (BITS * j)
        return out

    found = (texts.select(*TEXTS).mapInArrow(run, "model long, words int, context long, n long")
             .groupBy("model", "words", "context").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= HOT // 2))
    return [tuple(r) for r in found.collect()]  # at most some 2 * HOT_WORDS * total / HOT


class Places:
    """The bucket of each context."""

    def __init__(self, buckets: int, hot: list[tuple[int, int, int, int]]):
        self.buckets, self.hot, self.targets = buckets, [], []
        kept: dict[tuple[int, int, int], K.U64] = {}
        spread: dict[tuple[int, int, int], set[int]] = {}
        for words in range(1, HOT_WORDS + 1):
            keys, parts = [], []
            for model, _, context, n in (h for h in hot if h[1] == words):
                shorter = context & ((1 << (BITS * (words - 1))) - 1)
                if words > 1 and (model, words - 1, shorter) not in kept:
                    continue
                above = np.array([model], np.int64).view(K.U64) if words == 1 else kept[
                    model, words - 1, shorter]
                u = self._next(above, np.array([context >> (BITS * (words - 1))]))
                kept[model, words, context] = u
                keys.append(u[0])
                parts.append(-(-n // HOT))
                mine = {int((int(u[0]) % buckets + k) % buckets) for k in range(parts[-1])}
                for w in range(1, words + 1):  # they need the tables of all its hot endings
                    end = context & ((1 << (BITS * w)) - 1)
                    spread.setdefault((model, w, end), set()).update(mine)
            by = np.argsort(np.array(keys, K.U64))
            if len(by):
                self.hot.append((np.array(keys, K.U64)[by], np.array(parts, K.U64)[by]))
        self.targets = {h: sorted(found) for h, found in spread.items()}
        self.often = np.zeros(MASK + 1, bool)
        self.often[[c for _, w, c, _ in hot if w == 1]] = True
        self.by_word: dict[int, np.ndarray] = {}

    @staticmethod
    def _next(above, word):
        with np.errstate(over="ignore"):
            return K.mix(above + word.astype(K.U64) * _ODD)

    def words(self, model: int, size: int) -> np.ndarray:
        """Bucket of each symbol as a context; -1: hot."""
        if model not in self.by_word:
            if len(self.by_word) >= MODELS:
                self.by_word.clear()
            u = self._next(np.array([model], np.int64).view(K.U64), np.arange(size))
            bucket = (u % K.U64(self.buckets)).astype(np.int32)
            if self.hot:
                bucket[np.isin(u, self.hot[0][0])] = -1
            self.by_word[model] = bucket
        return self.by_word[model]

    def of(self, model, last, more):
        """(bucket, words of the context that decided it) of contexts: their last words, and
        ``more(j, rows)``, the words j places before in some rows."""
        n = K.U64(self.buckets)
        u = self._next(model.view(K.U64), last)
        bucket, depth = (u % n).astype(np.int32), np.ones(len(u), np.int8)
        at = np.arange(len(u))
        for words, (keys, parts) in enumerate(self.hot, 1):
            k = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
            found = keys[k] == u
            at, u, k = at[found], u[found], k[found]
            word = more(words, at)
            bucket[at] = (u % n + K.mix(word, 7) % parts[k]) % n
            depth[at] = words + 1
            u = self._next(u, word)
        return bucket, depth

    def depth(self, model: int, before: list[np.ndarray]) -> np.ndarray:
        """Words that decided the bucket of contexts of a model (``before[0]``: the last)."""
        out = np.ones(len(before[0]), np.int8)
        if self.hot:
            at = np.flatnonzero(self.often[before[0]])
            out[at] = self.of(np.full(len(at), model, np.int64), before[0][at],
                              lambda j, rows: before[j][at[rows]])[1]
        return out

    def of_chunk(self, chunk: Chunk, size: int) -> np.ndarray:
        """Bucket of each token."""
        names, of = np.unique(chunk.model, return_inverse=True)
        if len(names) > MODELS:
            far = np.arange(len(chunk.ids))
            bucket = np.empty(len(far), np.int32)
        else:
            table = np.concatenate([self.words(m, size) for m in names.tolist()] or [chunk.ids])
            bucket = table[(of * size)[chunk.text] + chunk.last]
            far = np.flatnonzero(bucket < 0)
        if len(far):
            bucket[far], _ = self.of(chunk.model[chunk.text[far]], chunk.last[far],
                                     lambda j, rows: chunk.before(j + 1, far[rows]))
        return bucket


BLOCKS = "bucket int, model long, base long, n int, body binary"


def _rows(columns, schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        names=[f for f, _ in fields])


def gram_blocks(texts: DataFrame, order: int, places, size: int, part: int, parts: int
                ) -> DataFrame:
    """The grams of the buckets of one part: a row for each chunk, bucket and model, its grams
    sorted by their last words, the text and its mark beside them. ``size``: symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            bucket = places.value.of_chunk(chunk, size)
            at = np.flatnonzero(bucket % parts == part) if parts > 1 else np.arange(len(bucket))
            if not len(at):
                continue
            names, of = np.unique(chunk.model, return_inverse=True)
            group = bucket[at].astype(np.int64) // parts * len(names) + of[chunk.text[at]]
            symbols = [chunk.ids[at], chunk.last[at], *(chunk.before(j, at)
                                                        for j in range(2, order))]
            by = np.argsort(packed(symbols[:3]))
            small = group.max() < 1 << 16
            by = by[np.argsort(group[by].astype(np.uint16) if small else group[by], kind="stable")]
            group, text = group[by], chunk.text[at[by]]
            doc = (2 * chunk.number + chunk.chosen)[text]
            body = np.concatenate([*(planes(s[by], _EACH) for s in symbols), planes(doc, _DOC)])
            cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            bounds, codec = np.append(cut, len(at)), _codec()
            yield _rows([group[cut] // len(names) * parts + part, names[group[cut] % len(names)],
                         np.full(len(cut), chunk.base), np.diff(bounds),
                         [codec.compress(body[:, a:b].tobytes(), asbytes=True)
                          for a, b in zip(bounds[:-1], bounds[1:], strict=True)]], BLOCKS)

    return texts.select(*TEXTS).mapInArrow(run, BLOCKS)


def table_blocks(tables: DataFrame, places, part: int, parts: int) -> DataFrame:
    """The tables of hot contexts for the buckets of one part (``base``: minus their words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets, codec = places.value.targets, _codec()
        for batch in batches:
            cells = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(6)])
            cut = np.flatnonzero(np.append(True, (cells[:3, 1:] != cells[:3, :-1]).any(0)))
            for a, b in zip(cut, np.append(cut[1:], cells.shape[1]), strict=True):
                model, words, context = cells[:3, a].tolist()
                to = [t for t in targets.get((model, words, context), ()) if t % parts == part]
                if to:
                    body = codec.compress(cells[2:, a:b].tobytes(), asbytes=True)
                    yield _rows([to, [model] * len(to), [-words] * len(to), [b - a] * len(to),
                                 [body] * len(to)], BLOCKS)

    return tables.select("model", "words", "context", "word", "a0", "a1").mapInArrow(run, BLOCKS)


def packed(words: list[np.ndarray]) -> np.ndarray:
    """At most three symbols as one number, the first one highest."""
    out = np.zeros(len(words[0]), np.int64) if words else None
    for w in words:
        out = out << BITS | w
    return out


def ordered(words: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their symbols, the first one first."""
    high = packed(words[:3])
    by = np.argsort(high)
    if len(words) <= 3 or not len(by):
        return by
    rank = np.cumsum(np.append(False, high[by][1:] != high[by][:-1]))
    low, bits = packed(words[3:]), BITS * (len(words) - 3)
    if int(rank[-1]).bit_length() + bits > 63:
        return np.lexsort((low, high))
    return by[np.argsort(rank << bits | low[by])]


def prefixes(words: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Where sorted rows begin to differ in their first symbol, their first two, ..."""
    new = np.zeros(len(words[0]), bool)
    new[:1] = True
    for w in words:
        new = new.copy()
        new[1:] |= w[1:] != w[:-1]
        yield new


class Types:
    """The different grams of a bucket and what they are on each level.

    ``start[k]``: a gram for each different ending of k + 1 words, ``number[k]``: that ending
    of each gram, ``context[k]``: the last k words of the context of each gram.
    """

    def __init__(self, words: list[np.ndarray], model: int, places):
        by = ordered(words)
        sorted_ = [w[by] for w in words]
        *_, new = prefixes(sorted_)
        self.of_row = np.empty(len(by), np.int32)
        self.of_row[by] = np.cumsum(new) - 1
        self.words = [w[new] for w in sorted_]
        self.order, self.size = len(words), int(new.sum())
        self.start, self.number = [], []
        for new in prefixes(self.words):
            self.start.append(np.flatnonzero(new))
            self.number.append((np.cumsum(new) - 1).astype(np.int32))
        before = self.words[1:]
        by = ordered(before)
        self.context = [np.zeros(self.size, np.int32)]
        for new in prefixes([w[by] for w in before]):
            of = np.empty(self.size, np.int32)
            of[by] = np.cumsum(new) - 1
            self.context.append(of)
        self.depth = places.depth(model, before)

    def inside(self, k: int) -> np.ndarray:
        """Whether all grams with the context of an ending of ``k + 1`` words are in this bucket."""
        return self.depth[self.start[k]] <= k

    def hot_key(self, k: int, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for j in range(k):
            out |= self.words[1 + j][at].astype(np.int64) << (BITS * j)
        return out

    def counts(self, top: np.ndarray) -> list[np.ndarray]:
        """Counts of the endings of each level: those given at the top, below the number of
        different words before, as far as the contexts one longer are in this bucket."""
        out = [top]
        for k in range(self.order - 2, -1, -1):
            longer = self.start[k + 1][(out[0] > 0) & self.inside(k + 1)]
            out.insert(0, np.bincount(self.number[k][longer], minlength=len(self.start[k])))
        return out


def _grams(body, n: int, order: int):
    """(symbols, text and mark) of the grams of a block."""
    size = _EACH * order + _DOC
    rows = np.frombuffer(_codec().decompress(body, n * size), np.uint8).reshape(size, n)
    return ([joined(rows[_EACH * k:_EACH * (k + 1)]) for k in range(order)],
            joined(rows[_EACH * order:], np.int64))


def _blocks(table_: pa.Table, order: int):
    """(first text's number, symbols of the different neighbouring grams, which of them a gram
    is, text and mark of each gram) of each block."""
    for base, n, body in zip(*(table_.column(c).to_pylist() for c in ("base", "n")),
                             table_.column("body"), strict=True):
        if base >= 0:
            symbols, doc = _grams(body.as_buffer(), n, order)
            *_, new = prefixes(symbols)
            at = np.flatnonzero(new)
            yield base, [s[at] for s in symbols], (np.cumsum(new) - 1).astype(np.int32), doc


def gathered(table_: pa.Table, model: int, order: int, places, trained):
    """(types of the grams of a bucket, their counts in each training text, its blocks without
    symbols); the blocks of a bucket with very many copies of its grams are read again."""
    words, counts, blocks = [[] for _ in range(order)], [[] for _ in trained], []
    few = sum(table_.column("n").to_pylist()) <= 4 * HOT
    for base, symbols, run, doc in _blocks(table_, order):
        for k in range(order):
            words[k].append(symbols[k])
        for c, which in zip(counts, trained, strict=True):
            c.append(np.bincount(run, doc & 1 if which == "chosen" else None, len(symbols[0])))
        if few:
            blocks.append((base, len(symbols[0]), run, doc.astype(np.int32)))
    if not words[0]:
        return None, [], []
    types = Types([np.concatenate(w) for w in words], model, places)
    if not few:
        blocks = ((base, len(symbols[0]), run, doc)
                  for base, symbols, run, doc in _blocks(table_, order))
    return types, [np.bincount(types.of_row, np.concatenate(c), types.size).astype(np.int64)
                   for c in counts], blocks


COUNTS = "model long, words int, context long, word long, a0 long, a1 long"


def bucket_counts(order: int, places, trained):
    """Per bucket: counts of the endings whose contexts are spread, and for each level
    (``words``: minus its length) and model (``context``) how many others have 1, 2, 3 and 4."""
    def run(key: tuple[pa.Scalar, ...], table_: pa.Table) -> pa.Table:
        model = key[1].as_py()
        types, tops, _ = gathered(table_, model, order, places.value, trained)
        counts, out = [types.counts(t) for t in tops], []
        for k in range(order):
            here, at = types.inside(k), types.start[k]
            for v, c in enumerate(counts):
                n = np.bincount(np.minimum(c[k][here], 5), minlength=6)[1:5]
                out.append((np.full(4, -1 - k), np.full(4, v), np.arange(1, 5), n, 0 * n))
            a = [c[k] for c in counts]
            some = ~here & (sum(a) > 0)
            a = [x[some] for x in a]
            out.append((np.full(some.sum(), k), types.hot_key(k, at[some]),
                        types.words[0][at[some]], a[0], a[-1]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.Table.from_batches([_rows([np.full(len(columns[0]), model), *columns], COUNTS)])

    return run


def discount(n: dict[int, int]) -> np.ndarray:
    """What is cut from counts of 0, 1, 2 and more, by how many types have 1, 2, 3 and 4 (as
    ``ngram_lm.discounts``)."""
    n = [n.get(k, 0) for k in range(5)]
    out = [0.0]
    for k in (1, 2, 3):
        known = n[1] > 0 and n[k] > 0 and n[k + 1] > 0
        raw = k - (k + 1) * (n[1] / (n[1] + 2 * n[2])) * n[k + 1] / n[k] if known else 0.5 * k
        out.append(max(0.1, min(float(k), raw)))
    return np.array(out)


class Table:
    """Counts of the words after given contexts."""

    def __init__(self, context, word, count, cut):
        some = count > 0
        context, word, count = context[some], word[some], count[some]
        by = np.argsort(context << BITS | word)
        self.key, self.count = (context << BITS | word)[by], count[by]
        self.context, of = np.unique(context, return_inverse=True)
        self.total, self.rest = sums(of, count, cut, len(self.context))

    @staticmethod
    def _find(keys, wanted):
        k = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return k, keys[k] == wanted if len(keys) else np.zeros(len(wanted), bool)

    def of(self, context, word):
        """(count, total of the context, share that it passes on); 0, 0, 1 where unseen."""
        k, found = self._find(self.key, context << BITS | word)
        count = np.where(found, self.count[k], 0) if len(self.key) else np.zeros(len(word))
        k, found = self._find(self.context, context)
        if not len(self.context):
            return count, np.zeros(len(word)), np.ones(len(word))
        return count, np.where(found, self.total[k], 0.0), np.where(found, self.rest[k], 1.0)


def sums(context, count, cut, size: int):
    """(total, share that is passed on) of each context; 0, 1 without counts."""
    total = np.bincount(context, count, size)
    off = np.bincount(context, cut[np.minimum(count, 3)], size)
    return total, np.where(total > 0, off / np.maximum(total, 1), 1.0)


def chances(types: Types, counts: list[np.ndarray], cuts, tables, size: int) -> np.ndarray:
    """Probability of the last word of each type after the others."""
    p = None
    for k in range(types.order):
        at = types.start[k]
        low = np.full(len(at), 1.0 / size) if k == 0 else p[types.number[k - 1][at]]
        here, count, context = types.inside(k), counts[k], types.context[k][at]
        total, rest = sums(context[here], count[here], cuts[k], int(context.max()) + 1)
        total, rest = total[context], rest[context]
        if not here.all():
            far = np.flatnonzero(~here)
            count = count.copy()
            count[far], total[far], rest[far] = tables[k].of(
                types.hot_key(k, at[far]), types.words[0][at[far]].astype(np.int64))
        own = np.where(total > 0, (count - cuts[k][np.minimum(count, 3)]) / np.maximum(total, 1), 0)
        p = own + rest * low
    return p


class Model:
    """Cuts of each level and the table of single words, by model; one for each training."""

    def __init__(self, counts: DataFrame, order: int, trained):
        levels: dict[tuple[int, int, int], dict[int, int]] = {}
        for r in counts.filter("words < 0").collect():  # 4 rows a model and level
            levels.setdefault((r.model, r.context, -1 - r.words), {})[r.word] = r.a0
        self.cuts = {k: discount(n) for k, n in levels.items()}
        single = counts.filter("words = 0").select("model", "word", "a0", "a1").toArrow()
        model, word, *a = (single.column(k).to_numpy() for k in range(4))
        by = np.argsort(model, kind="stable")
        bounds = np.append(np.flatnonzero(np.append(True, np.diff(model[by]) != 0)), len(by))
        self.single, self.order, self.trained = {}, order, trained
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            rows = by[i:j]
            if len(rows):
                name = int(model[rows[0]])
                for v in range(len(trained)):
                    self.single[name, v] = Table(0 * word[rows], word[rows], a[v][rows],
                                                 self.of(name, v)[0])

    def of(self, model: int, v: int) -> list[np.ndarray]:
        return [self.cuts.get((model, v, k), discount({})) for k in range(self.order)]

    def tables(self, model: int, v: int, cuts, hot: dict[int, list[np.ndarray]]) -> list:
        none = np.zeros(0, np.int64)
        first = self.single.get((model, v)) or Table(none, none, none, cuts[0])
        longer = [hot.get(k, [none] * 4) for k in range(1, self.order)]
        return [first, *(Table(t[0], t[1], t[2 + v], cuts[k])
                         for k, t in enumerate(longer, 1))]


def merged_counts(parts: list[DataFrame], longest: int) -> DataFrame:
    """The counts of all buckets: an ending whose context is spread counts for the ending one
    word shorter once, wherever its grams are."""
    key = ["model", "words", "context", "word"]
    add = lambda df: df.groupBy(*key).agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1"))
    rows = written(add(functools.reduce(DataFrame.unionByName, parts)), "lm-counts")
    out, level = [rows.filter("words < 0")], None
    for words in range(longest, -1, -1):
        here = rows.filter(F.col("words") == words)
        if level is not None:
            mask = (1 << (BITS * words)) - 1
            here = add(here.unionByName(level.select(
                "model", (F.col("words") - 1).alias("words"),
                F.col("context").bitwiseAND(F.lit(mask)).alias("context"), "word",
                *((F.col(a) > 0).cast("long").alias(a) for a in ("a0", "a1")))))
            here = written(here, "lm-counts")
        level = here
        out.append(here)
        for v, a in enumerate(("a0", "a1")):
            out.append(here.filter(F.col(a).between(1, 4)).groupBy("model", "words", a).count()
                       .select("model", (-1 - F.col("words")).alias("words"),
                               F.lit(v).cast("long").alias("context"), F.col(a).alias("word"),
                               F.col("count").alias("a0"), F.lit(0).cast("long").alias("a1")))
    return written(add(functools.reduce(DataFrame.unionByName, out)), "lm-counts")


def numbered(values: np.ndarray):
    """(different values, ascending, and which of them each one is)."""
    if len(values) and values.max() < 4 * len(values):
        new = np.bincount(values) > 0
        return np.flatnonzero(new), (np.cumsum(new) - 1)[values]
    return np.unique(values, return_inverse=True)


SUMS = "base long, n int, body binary"


def bucket_losses(order: int, places, model_, size: int):
    """Per bucket: for each chunk its texts and the sums of the losses of their grams."""
    def run(key: tuple[pa.Scalar, ...], table_: pa.Table) -> pa.Table:
        name, m, out, codec = key[1].as_py(), model_.value, [], _codec()
        types, tops, blocks = gathered(table_, name, order, places.value, m.trained)
        if types is None:
            return pa.Table.from_batches([_rows([[], [], []], SUMS)])
        hot: dict[int, list] = {}
        for base, n, body in zip(*(table_.column(c).to_pylist() for c in ("base", "n", "body")),
                                 strict=True):
            if base < 0:
                cells = np.frombuffer(codec.decompress(body, 32 * n), np.int64).reshape(4, n)
                hot.setdefault(-base, []).append(cells)
        hot = {k: list(np.concatenate(c, axis=1)) for k, c in hot.items()}
        losses = []
        for v, top in enumerate(tops):
            cuts = m.of(name, v)
            p = chances(types, types.counts(top), cuts, m.tables(name, v, cuts, hot), size)
            losses.append(np.rint(-np.log(p) * L.STEPS).astype(np.int64))
        begin = 0
        for base, size_, of, doc in blocks:
            of = types.of_row[begin:begin + size_][of]
            begin += size_
            docs, at = numbered(doc >> 1)
            body = [planes(docs, _DOC)]
            for loss in losses:  # halves of 30 bits have exact sums
                high, low = (np.bincount(at, x[of], len(docs)).astype(np.int64)
                             for x in (loss >> 30, loss & ((1 << 30) - 1)))
                body.append(planes((high << 30) + low, 8))
            out.append((base, len(docs), codec.compress(np.concatenate(body).tobytes(),
                                                        asbytes=True)))
        return pa.Table.from_batches([_rows(list(zip(*out, strict=True)), SUMS)])

    return run


def chunk_sums(values: int):
    """(number, sums) of the texts of a chunk, from those of all buckets."""
    def run(table_: pa.Table) -> pa.Table:
        docs, found, codec = [], [[] for _ in range(values)], _codec()
        for n, body in zip(*(table_.column(c).to_pylist() for c in ("n", "body")), strict=True):
            rows = np.frombuffer(codec.decompress(body, n * (_DOC + 8 * values)), np.uint8)
            rows = rows.reshape(-1, n)
            docs.append(joined(rows[:_DOC], np.int64))
            for v in range(values):
                a = _DOC + 8 * v
                found[v].append(joined(rows[a:a + 8], np.int64))
        docs = np.concatenate(docs)
        by = np.argsort(docs)
        cut = np.flatnonzero(np.append(True, np.diff(docs[by]) != 0))
        base = table_.column("base")[0].as_py()
        return pa.table({"_at": base + docs[by][cut],
                         **{f"s{v}": np.add.reduceat(np.concatenate(f)[by], cut)
                            for v, f in enumerate(found)}})

    return run


def text_losses(rows: DataFrame, order: int, unit, trained: tuple[str, ...],
                parts: int = PARTS) -> DataFrame:
    """The rows (with columns model, chosen and text) without text, with n_tokens and ``sums``:
    the sum of the losses of the text's words under each of the models, which are trained on
    the ``chosen`` rows or on ``every`` row of the same ``model``."""
    assert 2 <= order <= 6
    spark = rows.sparkSession
    rows = rows.withColumns({"model": F.coalesce(F.col("model").cast("string"), F.lit("")),
                             "chosen": F.coalesce("chosen", F.lit(False))})
    carried = [c for c in rows.columns if c != "text"]
    texts = written(coded(rows, unit), "coded")
    total = texts.agg(F.sum("n_tokens")).first()[0] or 0
    places = spark.sparkContext.broadcast(
        Places(max(1, -(-total // BUCKET)), hot_contexts(texts, order, total)))
    longest = len(places.value.hot)

    learned = texts if "every" in trained else texts.filter("chosen")
    first = max(1, parts // 3)
    counts = merged_counts([written(
        gram_blocks(learned, order, places, unit.size + 1, k, first).groupBy("bucket", "model")
        .applyInArrow(bucket_counts(order, places, trained), COUNTS)
        .groupBy("model", "words", "context", "word")
        .agg(F.sum("a0").alias("a0"), F.sum("a1").alias("a1")), "lm-part")
        for k in range(first)], longest)
    model = spark.sparkContext.broadcast(Model(counts, order, trained))

    if longest:
        context = ["model", "words", "context"]
        hot = written(counts.filter("words > 0").repartition(*context)
                      .sortWithinPartitions(*context), "lm-hot")
    sums_ = ", ".join(f"s{v} long" for v in range(len(trained)))
    found = []
    for k in range(parts):
        blocks = gram_blocks(texts, order, places, unit.size + 1, k, parts)
        if longest:
            blocks = blocks.unionByName(table_blocks(hot, places, k, parts))
        lost = blocks.groupBy("bucket", "model").applyInArrow(
            bucket_losses(order, places, model, unit.size), SUMS)
        found.append(written(lost.groupBy("base").applyInArrow(
            chunk_sums(len(trained)), f"_at long, {sums_}"), "lm-sums"))
    each = [f"s{v}" for v in range(len(trained))]
    by_text = functools.reduce(DataFrame.unionByName, found).groupBy("_at").agg(
        *(F.sum(s).alias(s) for s in each))
    return (texts.select(*carried, "_at", "n_tokens").join(by_text, "_at", "left")
            .select(*carried, "n_tokens", F.array(
                *(F.coalesce(F.col(s), F.lit(0)) / F.lit(L.STEPS) for s in each)).alias("sums")))

"""Byte-level BPE encoding and decoding with DuckDB inside each partition (operator 7).

Spark partitions the texts; a task splits them into pieces by the pattern of
the vocabulary, and every distinct piece becomes token-position rows in an
in-process DuckDB table. A recursive query joins neighbouring rows with the
merge table, picks the leftmost pair of least rank of each piece, contracts it,
and ends when no piece has a pair left. A query takes a bounded number of steps and the
last state is taken on, so memory follows the bytes of the pieces, not their merges. A
piece that is a token itself is that token. Distinct pieces are encoded once per worker (a bounded memory of
results, so whole texts only look ids up). Decoding joins token-position rows
with the vocabulary and aggregates their bytes in position order.

The pattern's classes are evaluated on arrays of code points: letters, numbers,
white space and others, with the contractions and the rule that the last of
several white-space characters stays with what follows.

Edge cases: null and empty texts have no tokens and decode to no bytes; texts
of one class or without spaces are one piece; ids and other columns are carried
along (a column named ``ids`` or ``decoded`` is replaced); an empty table gives
an empty result. An unknown id on decoding raises an error.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm.common import bounded_batches, table

#: Text bytes whose pieces are encoded together, and distinct pieces remembered.
CHUNK_BYTES = 1 << 19
#: Rows of a batch whose texts are copied at once.
ROWS = 500
REMEMBERED = 1_000_000
#: Bytes of new pieces that one encoding query holds, and ids that one decoding query holds.
QUERY_BYTES = 1 << 17
DECODE_IDS = 1 << 17
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# Code points of the Unicode property White_Space.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000)
# Contractions of the pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

#: Steps of one recursive query (its rows are those of all its steps) for short and long pieces.
STEPS, LONG_STEPS = 48, 16
LONG_PIECE = 1000

CONTRACT = f"""
WITH RECURSIVE state(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM symbols
  UNION ALL
  (WITH pair AS (
     SELECT a.w, min((m.tok::BIGINT << 32) + a.pos) AS best
     FROM state a JOIN state b ON a.w = b.w AND b.pos = a.pos + 1
     JOIN merges m ON m.pair = (a.tok::BIGINT << 32) + b.tok
     WHERE a.step < {STEPS}
     GROUP BY a.w),
   chosen AS (SELECT w, (best & 4294967295)::INT AS at, (best >> 32)::INT AS merged FROM pair)
   SELECT s.step + 1, s.w, s.pos - (s.pos > c.at)::INT,
          CASE WHEN s.pos = c.at THEN c.merged ELSE s.tok END
   FROM state s JOIN chosen c USING (w)
   WHERE s.pos <> c.at + 1))
SELECT w, pos, tok, step FROM (SELECT *, max(step) OVER (PARTITION BY w) AS done FROM state)
WHERE step = done
"""
# A long piece contracts all places of its least pair at once, from the left and without
# overlaps, if the new token is in no pair of a lower rank (``safe``): nothing can then come
# between them. Otherwise only the leftmost place is contracted.
CONTRACT_LONG = f"""
WITH RECURSIVE state(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM symbols
  UNION ALL
  (WITH pair AS (
     SELECT a.w, a.pos, m.tok, m.safe
     FROM state a JOIN state b ON a.w = b.w AND b.pos = a.pos + 1
     JOIN merges m ON m.pair = (a.tok::BIGINT << 32) + b.tok
     WHERE a.step < {LONG_STEPS}),
   least AS (SELECT w, min(tok) AS tok FROM pair GROUP BY w),
   place AS (SELECT w, pos, tok, safe, row_number() OVER (PARTITION BY w ORDER BY pos) AS n
             FROM pair JOIN least USING (w, tok)),
   turn AS (SELECT *, row_number() OVER (PARTITION BY w, pos - n ORDER BY pos) AS k FROM place),
   chosen AS (SELECT w, pos, tok FROM turn WHERE CASE WHEN safe THEN k % 2 = 1 ELSE n = 1 END)
   SELECT step, w, (row_number() OVER (PARTITION BY w ORDER BY pos) - 1)::INT, tok FROM (
     SELECT s.step + 1 AS step, s.w, s.pos, coalesce(c.tok, s.tok) AS tok
     FROM state s JOIN least ON least.w = s.w
     LEFT JOIN chosen c ON c.w = s.w AND c.pos = s.pos
     LEFT JOIN chosen gone ON gone.w = s.w AND gone.pos = s.pos - 1
     WHERE gone.w IS NULL)))
SELECT w, pos, tok, step FROM (SELECT *, max(step) OVER (PARTITION BY w) AS done FROM state)
WHERE step = done
"""
JOIN_BYTES = """
SELECT w, unhex(string_agg(v.hex, '' ORDER BY pos)) AS body, count(*) AS n
FROM ids JOIN vocabulary v ON v.tok = ids.tok GROUP BY w ORDER BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of each code point."""
    if not _CLASSES:
        t = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind == "L":
                t[c] = LETTER
            elif kind == "N":
                t[c] = NUMBER
        t[list(WHITE_SPACE)] = SPACE
        _CLASSES.append(t)
    return _CLASSES[0]


def piece_starts(points: np.ndarray, begin: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """Positions at which pieces start; texts start at ``begin`` (ascending, distinct)."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = table_[points]
    run = np.ones(n, bool)
    run[1:] = cls[1:] != cls[:-1]
    run[begin] = True
    first = np.flatnonzero(run)
    end = np.append(first[1:], n)
    opens = np.zeros(n + 1, bool)
    opens[begin] = True
    text_end = np.zeros(n + 1, bool)
    text_end[begin] = text_end[n] = True
    kind = cls[first]
    blank = kind == SPACE
    a, b = first[blank], end[blank]
    last = text_end[b]
    start = np.zeros(n + 1, bool)
    start[first[~blank]] = True
    start[a[last]] = True
    a, b = a[~last], b[~last]
    start[a[b - a >= 2]] = True
    start[b - 1] = True
    start[b] = points[b - 1] != 32
    # a lone apostrophe that starts a piece, before letters
    quote = first[(kind == OTHER) & (end - first == 1) & (points[first] == 39)]
    quote = quote[start[quote]]
    for word in CONTRACTIONS:
        rest = [ord(c) for c in word[1:]]
        at = quote[quote + len(rest) < n]
        for j, c in enumerate(rest, 1):
            at = at[(points[at + j] == c) & ~opens[at + j]]
        start[at + 1] = False
        start[at + 1 + len(rest)] = True
        quote = np.setdiff1d(quote, at)
    return np.flatnonzero(start[:n])


def split(data: np.ndarray, off: np.ndarray, table_: np.ndarray):
    """(byte start, byte end, number of the first piece of each text) of all pieces."""
    raw, base = data[off[0]:off[-1]], off - off[0]
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    begin = np.unique(np.searchsorted(lead, base[:-1][np.diff(base) > 0]))
    starts = lead[piece_starts(points, begin, table_)] if len(lead) else lead
    return starts, np.append(starts[1:], len(raw)), np.searchsorted(starts, base)


class Coder:
    """The merge table in DuckDB, and the pieces encoded so far."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb
        self.ranks = ranks
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, merged, unsafe = [], [], set()
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append((a << 32) + b)
                    merged.append(rank)
                    unsafe.update(part for part in (a, b) if part > rank)
        self.db = duckdb.connect(config={"threads": 1})
        self.db.execute("SET preserve_insertion_order = false")
        self._load("merges", pair=pa.array(pairs, pa.int64()), tok=pa.array(merged, pa.int32()),
                   safe=pa.array([rank not in unsafe for rank in merged]))
        self._load("vocabulary", tok=pa.array(list(ranks.values()), pa.int32()),
                   hex=pa.array([t.hex() for t in ranks], pa.string()))
        self.table = classes()
        self._forget()

    def _load(self, name, **cols):
        self.db.register("arrow_rows", pa.table(cols))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM arrow_rows")
        self.db.unregister("arrow_rows")

    def _forget(self):
        """No pieces: their hashes, the first of their ids, how many ids, and all ids."""
        self.known = self.other = np.zeros(0, K.U64)
        self.first = np.zeros(0, np.int64)
        self.size = self.ids = np.zeros(0, np.int32)

    def contract(self, pieces: list[bytes]):
        """(number of ids of each piece, all ids), a bounded part of the pieces at a time."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        parts = [self._contract(pieces[i:j]) for i, j in K.pieces(bounds, QUERY_BYTES)]
        sizes, ids = zip(*parts, strict=True)
        return np.concatenate(sizes), np.concatenate(ids)

    def _contract(self, pieces: list[bytes]):
        """The ids of pieces that fit a query: whole tokens, and contracted ones."""
        whole = [(k, self.ranks[p]) for k, p in enumerate(pieces) if p in self.ranks]
        rest = [(k, p) for k, p in enumerate(pieces) if p not in self.ranks]
        found = [(np.array([k for k, _ in whole], np.int32), np.zeros(len(whole), np.int32),
                  np.array([t for _, t in whole], np.int32))]
        for query, steps, part in (
                (CONTRACT, STEPS, [(k, p) for k, p in rest if len(p) <= LONG_PIECE]),
                (CONTRACT_LONG, LONG_STEPS, [(k, p) for k, p in rest if len(p) > LONG_PIECE])):
            found += self._fixpoint(query, steps, part)
        w, pos, tok = (np.concatenate(c) for c in zip(*found, strict=True))
        return np.bincount(w, minlength=len(pieces)), tok[np.lexsort((pos, w))]

    def _fixpoint(self, query: str, steps: int, pieces: list[tuple[int, bytes]]):
        """Runs of the recursive query, a bounded number of steps each, until no piece has a
        pair left; only the last state of a run is kept."""
        sizes = np.array([len(p) for _, p in pieces], np.int64)
        data = np.frombuffer(b"".join(p for _, p in pieces), np.uint8)
        begin = np.cumsum(sizes) - sizes
        state = {"w": np.repeat(np.array([k for k, _ in pieces], np.int32), sizes),
                 "pos": (np.arange(len(data)) - np.repeat(begin, sizes)).astype(np.int32),
                 "tok": self.bytes_[data]}
        while len(state["w"]):
            self._load("symbols", **state)
            got = self.db.execute(query).fetchnumpy()
            going = np.asarray(got["step"]) == steps
            cols = {c: np.asarray(got[c], np.int32) for c in ("w", "pos", "tok")}
            yield tuple(c[~going] for c in cols.values())
            state = {name: c[going] for name, c in cols.items()}

    def learn(self, hashes: np.ndarray, other: np.ndarray, pieces: list[bytes]):
        """Remember the ids of new pieces (``hashes`` ascending and not yet known)."""
        size, ids = self.contract(pieces)
        if len(self.known) + len(hashes) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, hashes)  # the ids stay where they are
        first = len(self.ids) + np.cumsum(size) - size
        self.known, self.other = np.insert(self.known, at, hashes), np.insert(self.other, at, other)
        self.first = np.insert(self.first, at, first)
        self.size = np.insert(self.size, at, size.astype(np.int32))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, data, off) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text) of texts between the offsets.

        Pieces are told apart by two independent hashes; should one alone be equal, the
        pieces of these texts are compared by their bytes and not remembered.
        """
        raw = data[off[0]:off[-1]]
        starts, ends, first = split(data, off, self.table)
        values = K.BYTE_VALUE[raw]
        hashes, other = (K.run_hashes(values, starts, ends, salt) for salt in (0, 1))
        del values
        words, sample, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = np.flatnonzero(at < len(self.known))
        new[inside] = self.known[at[inside]] != words[inside]
        old = np.flatnonzero(~new)
        if (other != other[sample][back]).any() or (
                self.other[at[old]] != other[sample[old]]).any():
            return self._encode_by_bytes(raw.tobytes(), starts, ends, first)
        if new.any():
            if len(self.known) + new.sum() > REMEMBERED:
                new[:] = True  # the memory starts anew with the pieces of these texts
            body = raw.tobytes()
            self.learn(words[new], other[sample[new]],
                       [body[starts[k]:ends[k]] for k in sample[new]])
            at = np.searchsorted(self.known, words)
        at = at[back]
        bounds, ids = gathered(self.ids, self.first[at], self.size[at])
        return ids, bounds[first]

    def _encode_by_bytes(self, body: bytes, starts, ends, first):
        """As ``encode``, with the bytes of the pieces as their identity."""
        number: dict[bytes, int] = {}
        back = np.array([number.setdefault(body[a:b], len(number))
                         for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        size, ids = self.contract(list(number))
        begin = np.cumsum(size) - size
        bounds, ids = gathered(ids, begin[back], size[back])
        return ids, bounds[first]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Bytes of each text: ordered aggregation over token-position rows."""
        size = np.diff(bounds)
        self._load("ids", w=np.repeat(np.arange(len(size), dtype=np.int32), size),
                   pos=np.arange(len(ids), dtype=np.int32), tok=ids.astype(np.int32))
        got = self.db.execute(JOIN_BYTES).fetchall()
        out = [b""] * len(size)
        for w, body, n in got:
            if n != size[w]:
                raise ValueError("an id is not in the vocabulary")
            out[w] = bytes(body)
        if sum(n for _, _, n in got) != len(ids):
            raise ValueError("an id is not in the vocabulary")
        return out


def gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray):
    """(bounds, values) of the concatenated slices values[first:first+size]."""
    bounds = np.concatenate(([0], np.cumsum(size)))
    index = np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1])
    return bounds, values[index]


def _coder(ranks: dict[bytes, int]) -> Coder:
    """One coder per vocabulary and worker process, until another operator's task."""
    coders = K.KEPT.setdefault("bpe", {})
    key = hash(frozenset(ranks.items()))
    if key not in coders:
        coders.clear()
        coders[key] = Coder(ranks)
    return coders[key]


def _encoded(coder: Coder, column, i: int, j: int):
    """Ids of the texts i..j of a column, as binary values."""
    data, off = column
    ids, bounds = coder.encode(data, off[i:j + 1])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int64) * 4),
                                   pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())


def _decoded(coder: Coder, column):
    """Bytes of a column of ids, a bounded number of ids to a query."""
    data, off = column
    out: list[bytes] = []
    for i, j in K.pieces(off, 4 * DECODE_IDS):
        ids = np.frombuffer(data[off[i]:off[j]].tobytes(), "<u4")
        out += coder.decode(ids, (off[i:j + 1] - off[i]) // 4)
    return pa.array(out, pa.binary())


def _mapped(rows: DataFrame, ranks_path: str, source: str, steps: list[str]) -> DataFrame:
    """All columns and those of the steps: ``ids`` from texts, ``decoded`` from ids. Steps
    asked for together run in one worker process."""
    bounded_batches(rows.sparkSession)
    ranks = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = rows.schema
    keep = [k for k, f in enumerate(schema) if f.name not in steps]
    names = [*(schema[k].name for k in keep), *steps]
    at = schema.names.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("bpe")
        coder, done = _coder(ranks.value), 0
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            column = K.byte_column(batch.column(at))
            for i, j in K.pieces(column[1], CHUNK_BYTES):
                part, new = batch.slice(i, j - i), []
                if "ids" in steps:
                    new.append(_encoded(coder, column, i, j))
                if "decoded" in steps:
                    new.append(_decoded(coder, K.byte_column(new[0] if new else part.column(at))))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *new],
                                                 names=names)
                done += 1
                if done % 8 == 0:
                    K.release()

    fields = [f"`{schema[k].name}` {schema[k].dataType.simpleString()}" for k in keep]
    return rows.mapInArrow(run, ", ".join([*fields, *(f"{c} binary" for c in steps)]))


def encode(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """All columns, and ``ids``: the ids as little-endian unsigned 32-bit integers."""
    return _mapped(docs, ranks_path, text_col, ["ids"])


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """All columns, and ``decoded``: the bytes of the column ``ids``."""
    tokens = tokens.drop("decoded").withColumnRenamed("ids", "_ids")
    return _mapped(tokens, ranks_path, "_ids", ["decoded"]).withColumnRenamed("_ids", "ids")


def round_trip(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """All columns, ``ids``, and ``decoded``: the bytes that the ids give again."""
    return _mapped(docs, ranks_path, text_col, ["ids", "decoded"])


def digests(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """Encode, decode, and the digests of both; all other columns stay."""
    return round_trip(docs, ranks_path, text_col).withColumns({
        "n_tokens": (F.octet_length("ids") / 4).cast("long"),
        "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256),
    }).drop("ids", "decoded")


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, default_ranks()).select("doc_id", "n_tokens", "ids_sha256",
                                                 "decoded_sha256")

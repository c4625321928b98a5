"""Vectorised text helpers shared by the operators (numpy inside Spark tasks).

All of them work on the UTF-8 bytes of whole texts, taken from the Arrow
buffers without copying them into Python strings. Work is done in pieces of
about ``PIECE`` bytes so that the 8-byte-per-byte intermediates stay small;
a text longer than a piece is a piece of its own, hashed in slices.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)
_BASE = U64(0x100000001B3 * 2 + 1)


def release() -> None:
    """Give freed memory back to the system: a worker process goes on to other stages, and
    what it keeps for itself counts against its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: What the tasks of an operator leave in a worker process for its next tasks, by operator.
KEPT: dict[str, dict] = {}


def begin(operator: str) -> dict:
    """What this operator has kept in the worker process; at the start of each task. What the
    tasks of other operators have kept goes, and freed memory is given back."""
    for other, kept in KEPT.items():
        if other != operator:
            kept.clear()
    release()
    return KEPT.setdefault(operator, {})


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) applied to each element."""
    z = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        z += U64(salt) * _MUL + _MUL
        z ^= z >> U64(30)
        z *= U64(0xBF58476D1CE4E5B9)
        z ^= z >> U64(27)
        z *= U64(0x94D049BB133111EB)
        z ^= z >> U64(31)
    return z


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=U64)
    out[1:] = U64(base)
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_INV = pow(int(_BASE), -1, 1 << 64)
_POWER_TABLES: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POWER_TABLES.get(base)
    if have is None or len(have) < n:
        have = _powers(base, max(n, PIECE + 1))
        if n <= 4 * PIECE:
            _POWER_TABLES[base] = have
    return have[:n]


#: One fixed random value per byte; spreads the polynomial over all 64 bits.
BYTE_VALUE = mix(np.arange(256, dtype=U64), 7) | U64(1)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()


def not_space() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, 9, 10, 11, 12, 13]] = False
    return t


def alnum_or_high() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z are lower-cased."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x41:0x5B] = True
    t[0x80:] = True
    return t


def byte_column(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data, off


def pieces(off: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose texts hold about ``size`` bytes; at least one row each."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray):
    """Starts and ends of maximal runs of ``inside`` bytes that do not cross texts.

    ``off`` are the text offsets into ``data`` (off[0] may be > 0); results are
    positions in ``data[off[0]:off[-1]]`` and the number of the first run of each text.
    """
    base = off[0]
    m = inside[data[base:off[-1]]]
    n = len(m)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    brk = off[1:-1] - base
    first = m.copy()
    first[1:] &= ~m[:-1]
    at = brk[brk < n]
    first[at] = m[at]
    last = m.copy()
    last[:-1] &= ~m[1:]
    at = brk[brk > 0] - 1
    last[at] = m[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off - base)


_PLACES: dict[int, np.ndarray] = {}


def place_values(n: int, salt: int) -> np.ndarray:
    """One fixed random odd number for each place below ``n`` in a run, kept between calls."""
    have = _PLACES.get(salt)
    if have is None or len(have) < n:
        size = min(PIECE, max(n, 1 << 12))
        have = _PLACES[salt] = mix(np.arange(size, dtype=U64), 17 + salt) | U64(1)
    return have[:n]


def _run_sums(values, starts, ends, first: int, salt: int) -> np.ndarray:
    """Sum of value times place value over runs whose first byte has the place ``first``."""
    size = ends - starts
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
    factor = place_values(int(size.max(initial=0)), salt)
    if first:  # a later part of a long run: other numbers
        factor = mix(factor, first // PIECE) | U64(1)
    if (starts[1:] == ends[:-1]).all():  # no gaps
        body = values[starts[0]:ends[-1]]
    else:
        body = values[np.repeat(starts, size) + place]
    acc = np.concatenate((np.zeros(1, U64), np.cumsum(body * factor[place])))
    return acc[bounds[1:]] - acc[bounds[:-1]]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0
               ) -> np.ndarray:
    """A 64-bit hash of each run; ``values`` holds a 64-bit value per byte of the piece.

    Each byte's value is multiplied by a random number of its place in the run (a multilinear
    hash), so no structure of a text makes runs collide as powers of a base would. Other
    values of ``salt`` give independent hashes.
    """
    out = np.zeros(len(starts), dtype=U64)
    i, n = 0, len(starts)
    with np.errstate(over="ignore"):
        while i < n:
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, side="right")))
            if ends[i] - starts[i] > PIECE:  # one long run, in parts
                j = i + 1
                for a in range(int(starts[i]), int(ends[i]), PIECE):
                    part = np.array([a]), np.array([min(a + PIECE, int(ends[i]))])
                    out[i:j] += _run_sums(values, *part, a - int(starts[i]), salt)
            else:
                out[i:j] = _run_sums(values, starts[i:j], ends[i:j], 0, salt)
            i = j
        return mix(out ^ mix((ends - starts).astype(U64), 3 + 2 * salt), 1 + 8 * salt)


def word_hashes(data, off, inside, fold: bool = True):
    """(hash of each word, number of the first word of each text)."""
    starts, ends, first = spans(data, off, inside)
    raw = data[off[0]:off[-1]]
    values = BYTE_VALUE[LOWER[raw] if fold else raw]
    return run_hashes(values, starts, ends), first


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (the last width-1 have none)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, U64)
        for j in range(width):
            acc = acc * _MUL + words[j:j + n]
    return mix(acc, 100 + width)


def shingle_sets(data, off, inside, width: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; short texts are one shingle."""
    words, first = word_hashes(data, off, inside)
    grams = window_hashes(words, width)
    for i in range(len(off) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            s = np.sort(grams[a:b - width + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            yield window_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, U64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

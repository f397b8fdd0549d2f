"""Vectorised word hashing shared by the operators whose task code is numpy.

A word is a run of bytes other than ASCII space, tab, LF, VT, FF and CR (the
UTF-8 form of ``[^\\x20\\x09-\\x0D]+``), with A-Z lower-cased.  Word hashes are
64-bit polynomial hashes computed from prefix sums over the whole Arrow
buffer, so no Python loop runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from inspect import signature

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_CODE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
for _c in range(ord("A"), ord("Z") + 1):
    _CODE[_c] = _CODE[_c + 32]

#: Bytes hashed at once; a longer text is cut at white space into pieces.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_POW_CACHE: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _POW_CACHE or len(_POW_CACHE["pow"]) < n:
        inv = pow(int(_BASE), -1, 2**64)
        for name, b in (("pow", int(_BASE)), ("inv", inv)):
            a = np.full(n, b, dtype=np.uint64)
            a[0] = 1
            _POW_CACHE[name] = np.multiply.accumulate(a)
    return _POW_CACHE["pow"][:n], _POW_CACHE["inv"][:n]


def _hash_piece(buf: np.ndarray, cuts: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of ``buf``; no word crosses one of
    the byte positions in ``cuts``.  With ``prefixes``, hashes has a column for
    the word and one for each of its prefixes of so many bytes."""
    w = _IS_WORD[buf]
    start, end = w.copy(), w.copy()
    start[1:] &= ~w[:-1]
    end[:-1] &= ~w[1:]
    inner = cuts[(cuts > 0) & (cuts < len(buf))]
    start[inner] = w[inner]
    end[inner - 1] = w[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    power, inverse = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_CODE[buf] * power[:-1], out=total[1:])
    if not prefixes:
        return mix((total[e] - total[s]) * inverse[s]), s
    ends = [e, *[np.minimum(e, s + p) for p in prefixes]]
    return np.stack([mix((total[x] - total[s]) * inverse[s]) for x in ends], axis=1), s


def give_back() -> None:
    """Return the freed memory of this process to the system: a Python worker outlives its
    tasks and would keep the most that any of them took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def frugal(run: Callable) -> Callable:
    """``run`` over a task's batches; freed memory goes back when they end."""
    @wraps(run)
    def batches(*args, **kwargs):
        try:
            yield from run(*args, **kwargs)
        finally:
            give_back()
    return batches


def frugal_group(run: Callable) -> Callable:
    """``run`` over one or two tables of a group; freed memory goes back at its end.
    Spark counts the parameters."""
    def both(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    def one(table):
        try:
            return run(table)
        finally:
            give_back()
    return both if len(signature(run).parameters) == 2 else one


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string Arrow array; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_blocks(off: np.ndarray, piece: int = PIECE) -> Iterator[tuple[int, int]]:
    """(first row, past the last row) of blocks of about ``piece`` bytes, or of one text."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = min(max(lo + 1, int(np.searchsorted(off, off[lo] + piece, side="right")) - 1), n)
        yield lo, hi
        lo = hi


def hashed_rows(column: pa.Array, prefixes: tuple[int, ...] = (), piece: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, past the last row, word hashes, word offsets): rows of
    the column in blocks of about ``piece`` bytes, each text whole.  The words
    of row ``lo + i`` are ``hashes[offsets[i]:offsets[i + 1]]``."""
    data, off = binary_parts(column)
    for lo, hi in row_blocks(off, piece):
        buf = data[off[lo]:off[hi]]
        if len(buf) <= 2 * piece:
            hashes, s = _hash_piece(buf, off[lo:hi + 1] - off[lo], prefixes)
            yield lo, hi, hashes, np.searchsorted(s, off[lo:hi + 1] - off[lo])
        else:  # one very long text: piece by piece, cut after a white space
            found, at = [], 0
            while at < len(buf):
                to = min(at + piece, len(buf))
                while to < len(buf) and _IS_WORD[buf[to - 1]]:
                    step = buf[to:to + 4096]
                    gap = np.flatnonzero(~_IS_WORD[step])
                    to += int(gap[0]) + 1 if len(gap) else len(step)
                found.append(_hash_piece(buf[at:to], np.zeros(0, np.int64), prefixes)[0])
                at = to
            hashes = np.concatenate(found)
            yield lo, hi, hashes, np.array([0, len(hashes)])


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every row, in text order, and their
    offsets; a row of 1 to k-1 words has its whole sequence as one shingle, a
    row without words has none."""
    n_words = np.diff(offsets)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    out_off = np.concatenate(([0], np.cumsum(counts)))
    rows = np.repeat(np.arange(len(counts)), counts)
    first = offsets[:-1][rows] + (np.arange(out_off[-1]) - out_off[:-1][rows])
    length = np.minimum(n_words, k)[rows]
    h = length.astype(np.uint64) * U64(0xD6E8FEB86659FD93)
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    for j in range(k):
        h = mix(h ^ np.where(j < length, padded[first + j] + U64(j + 1), U64(0)))
    return h, out_off


def distinct_sorted(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of every row, ascending, and their offsets."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[keep], rows[keep]
    return h, np.searchsorted(rows, np.arange(len(offsets)))

"""Vectorised work on batches of UTF-8 texts: one byte buffer plus row offsets, as Arrow holds them.

Polynomial prefix sums over the buffer give the hash of any range in constant time, so words, shingles and windows are
hashed without a Python object for each of them. ``text_hashes`` is for ranges of any length: 62 bits, two polynomials
modulo primes, so that two different texts of n signs meet in at most (n / 2**31)**2 of all pairs of bases.
``range_hashes`` works modulo 2**64, where long regular texts collide; it is for ranges of at most some hundred bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes of text that are worked on at once; a longer document is a block of its own.
BLOCK = 1 << 20

# A worker serves many stages. Freed arrays go back to the system at once instead of adding up in its heap: the size
# from which the C library maps memory singly (parameter -3 of glibc) otherwise grows with the arrays it has seen.
if hasattr(_libc := ctypes.CDLL(None), "mallopt"):
    _libc.mallopt(-3, 1 << 20)
pa.set_memory_pool(pa.system_memory_pool())

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown by doubling."""
    table = _powers.get(base)
    if table is None:
        table = np.ones(1, np.uint64)
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _powers[base] = table
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every other one."""
    h = h.astype(np.uint64, copy=True)
    shifted = h >> np.uint64(30)
    h ^= shifted
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= np.right_shift(h, np.uint64(27), out=shifted)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= np.right_shift(h, np.uint64(31), out=shifted)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column without nulls; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def prefix_sums(text: np.ndarray) -> np.ndarray:
    sums = np.empty(len(text) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _power_table(BASE, len(text)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end): equal bytes, equal hash, wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, len(sums))[starts])


def window_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """``range_hashes`` of every range of ``size`` bytes."""
    return mix((sums[size:] - sums[:-size]) * _power_table(_INVERSE, len(sums))[: len(sums) - size])


#: Signs that are hashed at once; tables of powers are not longer than two of these.
CHUNK = 1 << 18
#: Prime modulus and base of the two polynomials.
PRIMES = ((2147483647, 1103515245), (2147483629, 1974872341))
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_pair(prime: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo a prime, kept and grown by doubling."""
    if prime not in _tables:
        _tables[prime] = np.ones(1, np.uint64), np.ones(1, np.uint64)
    up, down = _tables[prime]
    while len(up) < n:
        size = len(up)
        up = np.concatenate([up, up * np.uint64(pow(base, size, prime)) % np.uint64(prime)])
        down = np.concatenate([down, down * np.uint64(pow(base, -size, prime)) % np.uint64(prime)])
    _tables[prime] = up, down
    return up[:n], down[:n]


def _sums(codes: np.ndarray, prime: int, base: int) -> np.ndarray:
    powers = _power_pair(prime, base, len(codes))[0]
    terms = powers * codes
    terms += powers  # a sign counts as one more than its code, so zeros tell too
    if codes.itemsize > 1:  # bytes stay below 2**64 in a whole chunk
        terms %= np.uint64(prime)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(terms, out=sums[1:])
    return sums


def text_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [start, end) of bytes or code points; starts ascend. Equal ranges, equal hash.

    Works on ``CHUNK`` signs at a time, so memory does not grow with the longest text; a longer range is hashed in pieces.
    """
    out = np.empty(len(starts), np.uint64)
    short = np.flatnonzero(ends - starts <= CHUNK)
    first, after, lo = starts[short], ends[short], 0
    while lo < len(short):
        hi = int(np.searchsorted(first, first[lo] + CHUNK, "right"))
        base, top = int(first[lo]), int(after[lo:hi].max())
        part, a, b = codes[base:top], first[lo:hi] - base, after[lo:hi] - base
        found = []
        for prime, root in PRIMES:
            sums, down = _sums(part, prime, root), _power_pair(prime, root, len(part) + 1)[1]
            found.append((sums[b] - sums[a]) % np.uint64(prime) * down[a] % np.uint64(prime))
        out[short[lo:hi]] = found[0] << np.uint64(32) | found[1]
        lo = hi
    for k in np.flatnonzero(ends - starts > CHUNK).tolist():
        found = []
        for prime, root in PRIMES:
            places = range(int(starts[k]), int(ends[k]), CHUNK)
            found.append(sum(int(_sums(codes[x : min(x + CHUNK, int(ends[k]))], prime, root)[-1]) % prime
                             * pow(root, x - int(starts[k]), prime) for x in places) % prime)
        out[k] = found[0] << 32 | found[1]
    return mix(out)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of ``inside`` bytes; no run crosses a row."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True  # a row may be empty, then the mark belongs to the next one
    first[0] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = first[1:].copy()
    last[-1] = True
    ends = np.flatnonzero(inside & (~after | last)) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def words(text: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, ...]:
    """Hash, row, start and end of every run of bytes that are not ASCII white space."""
    if lower:
        text = LOWER[text]
    starts, ends, rows = runs(~WHITE[text], offsets)
    return text_hashes(text, starts, ends), rows, starts, ends


def sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbours; the caller drops those that cross a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + n]
    return mix(out)


def shingles(text: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words by row: (hashes, bounds), hashes sorted within a row.

    A row with fewer words has its whole sequence as one shingle, a row without words none.
    """
    n_rows = len(offsets) - 1
    hashes, rows, _, _ = words(text, offsets)
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(counts)])
    grams = sequence_hashes(hashes, size)
    whole = np.flatnonzero(rows[: len(grams)] == rows[size - 1 :][: len(grams)])
    gram_rows, grams = rows[whole], grams[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for k, row in enumerate(short):
            extra[k] = sequence_hashes(hashes[first[row] : first[row + 1]], int(counts[row]))[0]
        gram_rows = np.concatenate([gram_rows, short])
        grams = np.concatenate([grams, extra])
    order = np.lexsort((grams, gram_rows))
    gram_rows, grams = gram_rows[order], grams[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (gram_rows[1:] != gram_rows[:-1])
        gram_rows, grams = gram_rows[new], grams[new]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(gram_rows, minlength=n_rows))])
    return grams, bounds


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start+1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total, dtype=np.int64) + skip

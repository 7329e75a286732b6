"""Texts of an Arrow batch as flat numpy arrays, and hashes over them.

Everything here is vectorised over a whole block of texts: word bounds, word
hashes and k-gram hashes cost a few array passes, not a Python step per word.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of each value."""
    z = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * MIX1
    z = (z ^ (z >> np.uint64(27))) * MIX2
    return z ^ (z >> np.uint64(31))


BYTE_CODE = mix(np.arange(256, dtype=np.uint64), 7)


def tidy(run):
    """A function of Arrow batches that gives freed memory back when its task
    ends; workers live on for later tasks of other stages."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)
    return wrapped


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column without nulls; bounds has n + 1 entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    buf = column.buffers()
    off = np.frombuffer(buf[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(buf[2], dtype=np.uint8) if buf[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(bounds: np.ndarray, limit: int):
    """Ranges [i, j) of rows holding at most ``limit`` units, one row at least."""
    n, i = len(bounds) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def gram_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of codes[i:i+k] for each i (len - k + 1 values), by doubling: the
    hash of a + b long grams is hash(a) * BASE**b + hash(b)."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, power, width = None, 0, codes, 1
    rest = k
    while rest:
        if rest & 1:
            m = len(codes) - have - width + 1
            scale = np.uint64(pow(int(BASE), width, 2**64))
            out = power.copy() if out is None else out[:m] * scale + power[have:have + m]
            have += width
        rest >>= 1
        if rest:
            scale = np.uint64(pow(int(BASE), width, 2**64))
            power = power[:-width] * scale + power[width:]
            width *= 2
    return out[:n]


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w] for each i, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    out, width = x, 1
    while width * 2 <= w:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:n], out[w - width:w - width + n])


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = False):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row: (starts, ends, hashes,
    word_bounds).  A word's 64-bit hash is a polynomial over random byte
    codes, from two running sums; words never cross rows."""
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    solid = np.ones(len(data) + 1, bool)
    solid[:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    solid[-1] = False
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge))
    ends = np.flatnonzero(before & (~solid | edge))
    size = ends - starts
    if len(starts) == 0:
        return starts, ends, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    # sum over the word of code[b] * BASE**(position in the word), by BASE**position / BASE**start
    powers = np.empty(len(data), np.uint64)
    powers[0] = 1
    powers[1:] = BASE
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers, out=total[1:])
    inverse = np.uint64(pow(int(BASE), -1, 2**64))
    back = np.empty(len(data), np.uint64)
    back[0] = 1
    back[1:] = inverse
    np.multiply.accumulate(back, out=back)
    h = (total[ends] - total[starts]) * back[starts]
    return starts, ends, mix(h ^ (size.astype(np.uint64) << np.uint64(48))), \
        np.searchsorted(starts, bounds)

"""Pre-tokens of a block of texts, found on arrays of code points.

Two splitting patterns are supported, told apart by their parameters: the
pattern of the rank files (a single space joins the following run; white
space is kept) and that of the lower-case word vocabulary (white space is
dropped, digits stand alone).  Both first cut the contractions
``'s 't 're 've 'm 'll 'd``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

from .textarrays import BASE, BYTE_CODE, mix

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, from the Unicode properties."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((SPACE, r"\p{White_Space}"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        for m in regex.finditer(f"{name}+", every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a:b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def split(codes: np.ndarray, bounds: np.ndarray, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pre-tokens of texts codes[bounds[i]:bounds[i+1]].

    ``keep_space``: the rank files' pattern; else the word vocabulary's.
    """
    n = len(codes)
    kind = classes()[codes]
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    if not keep_space:
        start[:n] |= kind == NUMBER
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start |= edge
    if keep_space:
        # where a run of white space is followed by something else in its text
        at = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n]) + 1 if n > 1 \
            else np.zeros(0, np.int64)
        start[at - 1] = True
        start[at[codes[at - 1] == 32]] = False
    apos = np.flatnonzero(codes == 39)
    apos = apos[start[apos]]
    if len(apos):
        def follows(at, text):
            ok = np.ones(len(at), bool)
            for k, ch in enumerate(text, 1):
                ok &= (at + k < n) & ~edge[np.minimum(at + k, n)]
                ok &= codes[np.minimum(at + k, n - 1)] == ord(ch)
            return ok
        for tail in ("s", "t", "re", "ve", "m", "ll", "d"):
            hit = apos[follows(apos, tail)]
            start[hit + 1] = False
            start[hit + 1 + len(tail)] = True
    cuts = np.flatnonzero(start[:n])
    ends = np.append(cuts[1:], n)
    if not keep_space:
        solid = kind[cuts] != SPACE
        cuts, ends = cuts[solid], ends[solid]
    return cuts, ends


def block_arrays(texts: list[str]):
    """(utf-8 bytes, code points, code point bounds, byte place of each code
    point) of the joined texts."""
    joined = "".join(texts)
    raw = joined.encode("utf-8")
    data = np.frombuffer(raw, np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    if len(raw) == len(joined):
        return raw, data, data.astype(np.uint32), bounds, np.arange(len(raw) + 1)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))
    return raw, data, codes, bounds, place


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept for blocks to come (16 bytes a place
    of the largest block)."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((int(BASE), pow(int(BASE), -1, 2**64))):
            x = np.full(n, np.uint64(base), np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte piece, from two running sums."""
    n = len(data)
    forth, back = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * forth, out=total[1:])
    h = (total[ends] - total[starts]) * back[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def distinct_pieces(texts: list[str], keep_space: bool):
    """(pieces, index, token_bounds): the distinct pre-tokens as bytes, for
    each pre-token its index among them, and the texts' bounds in ``index``."""
    raw, data, codes, bounds, place = block_arrays(texts)
    if not len(codes):
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    starts, ends = split(codes, bounds, keep_space)
    a, b = place[starts], place[ends]
    _, first, index = np.unique(piece_hashes(data, a, b), return_index=True, return_inverse=True)
    pieces = [raw[x:y] for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True)]
    return pieces, index, np.searchsorted(starts, bounds)

"""Removal of repeated byte strings by sorting suffixes (operator 3).

Every byte covered by a ``window``-byte string that also starts earlier
(smaller doc_id, or the same document before) is removed; strings are judged
on the input and never cross documents.

The suffixes that can matter (see :mod:`.repeats`) are sorted by difference-
cover blockwise construction.  In a task, the pieces of a few seeds form one
text of bounded size.  The suffixes that begin at places of a difference
cover modulo ``PERIOD`` (7 of 32) are ranked first, by prefix doubling.  The
others are then sorted one bucket of first bytes at a time: by their first
``PERIOD`` bytes, and where these tie, by the ranks of the cover suffixes at
the distance at which both have one.  So a tie of any length costs one
comparison of ranks, and memory holds the cover's ranks and one bucket.
Neighbours in the sorted order that share ``window`` bytes are repeats.

Defined cases: null text is empty; texts shorter than the window stay whole;
a null doc_id is smaller than any other; of rows with one doc_id the order of
a text hash decides, and rows equal in both get equal results; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import NO_ID, as_ranges, byte_units, repeated, row_blocks, seed_groups, with_lists

WINDOW, SEED = 100, 24
PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 19)     # FIXED VALUES: a difference cover modulo 32
BUCKET = 1 << 17                    # suffixes sorted at a time
TEXT = 1 << 21                      # bytes of pieces in one local text


@lru_cache(maxsize=1)
def cover_distance() -> np.ndarray:
    """[i, j]: the least d with (i + d) and (j + d) both in the cover, modulo PERIOD."""
    out = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = next(d for d in range(PERIOD)
                             if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER)
    return out


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a big-endian number (zeros after the end)."""
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(text)]
    return out


def at(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    """x at places, 0 after its end."""
    return np.where(places < len(x), x[np.minimum(places, len(x) - 1)], 0)


def dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the sorted keys; equal keys share a rank."""
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def cover_ranks(text: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the cover the rank of its suffix by ``depth`` bytes or
    more (0 elsewhere): by the first PERIOD bytes, then by doubling, since
    places a multiple of PERIOD apart are in the cover together."""
    places = np.flatnonzero(np.isin(np.arange(len(text)) % PERIOD, COVER))
    first = [at(eight, places + k) for k in range(0, PERIOD, 8)]
    order = np.lexsort(first[::-1])
    ranks = np.zeros(len(text), np.int64)
    ranks[places] = dense(order, *first)
    have = PERIOD
    while have < depth:
        pair = (ranks[places] << 32) | at(ranks, places + have)
        ranks[places] = dense(np.argsort(pair, kind="stable"), pair)
        have *= 2
    return ranks


def sort_bucket(eight: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``places`` in the order of their suffixes: by PERIOD bytes, then, where
    these tie, by three-way partition around a pivot with cover ranks."""
    first = [at(eight, places + k) for k in range(0, PERIOD, 8)]
    order = np.lexsort(first[::-1])
    places = places[order]
    group = dense(np.arange(len(order)), *[f[order] for f in first])
    distance = cover_distance()
    open_ = np.ones(len(places), bool)
    while True:
        idx = np.flatnonzero(open_)
        g = group[idx]
        begin = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(g)))
        alone = np.repeat(size == 1, size)
        open_[idx[alone]] = False
        idx, g = idx[~alone], g[~alone]
        if not len(idx):
            return places
        begin, size = np.cumsum(size[size > 1]) - size[size > 1], size[size > 1]
        p = places[idx]
        pivot = np.repeat(p[begin + size // 2], size)
        d = distance[p % PERIOD, pivot % PERIOD]
        side = np.sign(at(ranks, p + d) - at(ranks, pivot + d))
        key = g * 4 + side + 1      # groups are numbered by where they begin: see below
        o = np.argsort(key, kind="stable")
        places[idx] = p[o]
        key, side = key[o], side[o]
        new = np.append(True, key[1:] != key[:-1])
        # a group's number is the place of its first member: unique, and in order
        group[idx] = idx[np.maximum.accumulate(np.where(new, np.arange(len(idx)), 0))]
        open_[idx[side == 0]] = False


def equal_windows(eight: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether the window bytes from a and from b are the same (window >= 8)."""
    same = np.ones(len(a), bool)
    for k in [*range(0, window - 7, 8), window - 8]:
        same &= at(eight, a + k) == at(eight, b + k)
    return same


def sorted_classes(text: np.ndarray, places: np.ndarray, window: int, bucket: int = BUCKET):
    """Blocks (places, class) of the suffixes at ``places``, one bucket of
    first bytes at a time; equal windows have one class and one block."""
    eight = eight_bytes(text)
    ranks = cover_ranks(text, eight, window)
    lead = eight[places]
    cuts = np.sort(lead)[bucket::bucket]    # splitters: no bucket cuts equal first bytes
    which = np.searchsorted(np.unique(cuts), lead, side="right")
    order = np.argsort(which, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(which[order])) + 1):
        p = sort_bucket(eight, ranks, places[some])
        new = np.append(True, ~equal_windows(eight, p[1:], p[:-1], window))
        yield p, np.cumsum(new) - 1


def repeated_places(group: list, window: int):
    """(piece, place, count) ranges of windows in the pieces (doc, rid, a, n,
    bytes) that also start earlier."""
    size = np.array([len(x[4]) for x in group], np.int64)
    n = np.array([x[3] for x in group], np.int64)
    begin = np.cumsum(size) - size
    text = np.frombuffer(b"".join(x[4] for x in group), np.uint8)
    doc = np.array([NO_ID if x[0] is None else x[0] for x in group], np.int64)
    rid = np.array([x[1] for x in group], np.int64)
    a = np.array([x[2] for x in group], np.int64)
    # the pieces' order among all windows of a class: document, then place
    piece = np.repeat(np.arange(len(group)), n)
    places = begin[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    piece_of = np.zeros(len(text), np.int64)
    piece_of[places] = piece
    out_piece, out_place = [], []
    for p, c in sorted_classes(text, places, window):
        i = piece_of[p]
        start = a[i] + p - begin[i]
        order = np.lexsort((start, rid[i], doc[i], c))
        i, start, c = i[order], start[order], c[order]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        head = first[c]
        later = (doc[i] != doc[i[head]]) | (rid[i] != rid[i[head]]) | (start != start[head])
        out_piece.append(i[later])
        out_place.append(start[later])
    if not out_piece:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return as_ranges(np.concatenate(out_piece), np.concatenate(out_place))


def sort_pieces(batches):
    for group in seed_groups(batches, TEXT):
        i, at_, n = repeated_places(group, WINDOW)
        yield pa.RecordBatch.from_arrays(
            [pa.array([group[k][0] for k in i], pa.int64()), pa.array([group[k][1] for k in i], pa.int64()),
             pa.array(at_.astype(np.int32)), pa.array(n.astype(np.int32))], ["doc_id", "rid", "a", "n"])


def covered(n: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Mask of the n units covered by windows starting at [a, a + count)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + counts + window - 1, n), -1)
    return np.cumsum(edge[:-1]) > 0


SPANS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (``keep_text``) the
    kept bytes of every row."""
    rows, found = repeated(docs, byte_units, WINDOW, SEED, True, sort_pieces)

    def run(batches):
        for batch in batches:
            for b in row_blocks(batch):
                _, bounds, _, _, data = byte_units(b["text"])
                lists = b["found"].combine_chunks() if isinstance(b["found"], pa.ChunkedArray) else b["found"]
                out = []
                for i in range(b.num_rows):
                    own = data[bounds[i]:bounds[i + 1]]
                    one = lists[i]
                    if one.is_valid:
                        v = one.values
                        gone = covered(len(own), v.field("a").to_numpy().astype(np.int64),
                                       v.field("n").to_numpy().astype(np.int64), WINDOW)
                        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        kept = own[~gone].tobytes()
                        out.append((len(own), int(gone.sum()), spans,
                                    hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                    else:
                        kept = own.tobytes()
                        out.append((len(own), 0, 0, hashlib.sha256(kept).hexdigest(),
                                    kept if keep_text else None))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.binary())], [c.split()[0] for c in SPANS.split(", ")])

    out = with_lists(rows, found, "found", "a", "n").mapInArrow(run, SPANS)
    return out if keep_text else out.drop("kept")

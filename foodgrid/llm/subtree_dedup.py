"""Removal of repeated word sequences by prefix-partitioned suffix trees
(operator 6).

A word is removed when it is covered by a window of ``WINDOW`` words whose
sequence also starts in a document with a smaller doc_id; windows are judged
on the input and never cross documents.

The suffixes that can matter (see :mod:`.repeats`) reach a task as the pieces
of a few seeds.  There they are split by prefixes of variable length: all
suffixes that begin with the same words form a group, and a group that is
too large for memory is split by one word more.  Of each group a suffix tree
is built (its leaves in order, with the length that neighbours share, tell
its inner nodes); the leaves below an inner node of depth ``WINDOW`` or more
begin with the same window, so each such node is a repeat.

Defined cases: null text has no words; documents with fewer words than the
window stay whole; a null doc_id is smaller than any other; rows with the
same doc_id do not repeat each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import NO_ID, as_ranges, repeated, row_blocks, seed_groups, with_lists, word_units
from .suffix_dedup import covered

WINDOW, SEED = 13, 3
GROUP = 1 << 16     # suffixes in one subtree, unless they share WINDOW words
TEXT = 1 << 21      # bytes of pieces in one local text


def prefix_groups(word: np.ndarray, places: np.ndarray, limit: int, depth: int):
    """Groups (places, prefix length): suffixes that share their first words;
    larger groups are split by one word more, up to ``depth``."""
    todo = [(places, 0)]
    while todo:
        some, length = todo.pop()
        if len(some) <= limit or length == depth:
            yield some, length
            continue
        key = word[some + length]
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        parts = np.split(some[order], cuts)
        # small neighbours stay together under the shorter prefix
        pack, size = [], 0
        for p in parts:
            if len(p) > limit:
                todo.append((p, length + 1))
                continue
            if size + len(p) > limit:
                yield np.concatenate(pack), length
                pack, size = [], 0
            pack.append(p)
            size += len(p)
        if pack:
            yield np.concatenate(pack), length


def subtree(word: np.ndarray, places: np.ndarray, prefix: int, depth: int):
    """(leaves in order, length shared with the leaf before), to ``depth`` words.

    All leaves share ``prefix`` words already, when the group was split."""
    m = word[places[:, None] + np.arange(depth)]
    order = np.lexsort(m.T[::-1])
    m = m[order]
    equal = m[1:] == m[:-1]
    shared = np.where(equal.all(axis=1), depth, equal.argmin(axis=1))
    return places[order], np.append(0, shared)


def deep_nodes(shared: np.ndarray, depth: int) -> np.ndarray:
    """The inner node of depth ``depth`` or more above each leaf, numbered."""
    return np.cumsum(shared < depth) - 1


def repeated_places(group: list, window: int, limit: int = GROUP):
    """(piece, place, count) ranges of windows of the pieces (doc, rid, a, n,
    bytes) that also start in a smaller document."""
    word, bounds, *_ = word_units(pa.array([x[4] for x in group], pa.binary()))
    n = np.array([x[3] for x in group], np.int64)
    doc = np.array([NO_ID if x[0] is None else x[0] for x in group], np.int64)
    a = np.array([x[2] for x in group], np.int64)
    piece = np.repeat(np.arange(len(group)), n)
    places = bounds[:-1][piece] + np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    piece_of = np.zeros(len(word) + 1, np.int64)
    piece_of[places] = piece
    out_piece, out_place = [], []
    for some, prefix in prefix_groups(word, places, limit, window):
        leaves, shared = subtree(word, some, prefix, window)
        node = deep_nodes(shared, window)
        i = piece_of[leaves]
        least = np.full(node[-1] + 1 if len(node) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc[i])
        later = doc[i] != least[node]
        out_piece.append(i[later])
        out_place.append((a[i] + leaves - bounds[:-1][i])[later])
    if not out_piece:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return as_ranges(np.concatenate(out_piece), np.concatenate(out_place))


def sort_pieces(batches):
    for group in seed_groups(batches, TEXT):
        i, at, n = repeated_places(group, WINDOW)
        yield pa.RecordBatch.from_arrays(
            [pa.array([group[k][0] for k in i], pa.int64()), pa.array([group[k][1] for k in i], pa.int64()),
             pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], ["doc_id", "rid", "a", "n"])


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (``keep_text``) the kept
    words, joined by single spaces, of every row."""
    rows, found = repeated(docs, word_units, WINDOW, SEED, False, sort_pieces)

    def run(batches):
        for batch in batches:
            for b in row_blocks(batch):
                _, bounds, starts, ends, data = word_units(b["text"])
                out = []
                gone = np.zeros(len(starts), bool)
                for i in range(b.num_rows):
                    one = b["found"][i]
                    if one.is_valid:
                        v = one.values
                        gone[bounds[i]:bounds[i + 1]] = covered(
                            int(bounds[i + 1] - bounds[i]), v.field("a").to_numpy().astype(np.int64),
                            v.field("n").to_numpy().astype(np.int64), WINDOW)
                for i in range(b.num_rows):
                    x, y = bounds[i], bounds[i + 1]
                    kept = b" ".join(_words(data, starts[x:y][~gone[x:y]], ends[x:y][~gone[x:y]]))
                    out.append((int(y - x), int(gone[x:y].sum()), hashlib.sha256(kept).hexdigest(),
                                kept if keep_text else None))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary())],
                    [c.split()[0] for c in KEPT.split(", ")])

    out = with_lists(rows, found, "found", "a", "n").mapInArrow(run, KEPT)
    return out if keep_text else out.drop("kept")


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    if not len(starts):
        return []
    lo = int(starts[0])
    raw = data[lo:int(ends[-1])].tobytes()
    return [raw[x:y] for x, y in zip((starts - lo).tolist(), (ends - lo).tolist(), strict=True)]

"""Where can a window of W units (bytes or words) occur twice?

Sorting every suffix of every text would move each byte many times over, so
both repeat operators (3 and 6) first find the few suffixes that can matter.
Of the k-grams inside a window of W units one has the smallest hash, its
*seed*: equal windows have equal seeds at the same place.  Neighbouring
windows share their seed, so a text falls into runs: (seed, first start,
number of starts, hash of all units the run's windows touch).

The runs are sorted by (seed, touched units, doc_id, place) across the
cluster, range partitioned, so that a hot seed spreads over partitions.  In
that order:

* a run whose touched units equal those of an earlier run is an identical
  copy, and nothing new: it repeats as a whole;
* the first run of each such class is sorted with its suffixes (by the
  caller) if its seed has other classes as well, or touches the end of a
  partition; all others cannot repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import same_row, stored, texts
from .textarrays import blocks, gram_hash, mix, tidy, utf8, window_min, words

#: Seeds with more classes than this are too wide for one group of suffixes.
WIDE = 4000
BLOCK = 1 << 20
RUNS = "seed long, touched long, doc_id long, rid long, a int, n int"
FOUND = "kind int, seed long, doc_id long, rid long, a int, n int"
COPY, CANDIDATE = 0, 1
PLACE = np.uint64((1 << 30) - 1)
NO_ID = -(1 << 63)      # a null doc_id, before all others


def runs_of(codes: np.ndarray, bounds: np.ndarray, window: int, k: int):
    """(row, a, n, seed, touched) of the runs of rows codes[bounds[i]:bounds[i+1]].

    ``a`` is relative to the row.  Rows of less than ``window`` units have none.
    """
    n = len(codes) - window + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = mix(gram_hash(codes, k), 4)
    width = window - k + 1
    # the smallest gram by 34 bits of its hash, the leftmost of equal ones: its
    # place rides in the low 30 bits
    places = np.arange(len(grams), dtype=np.uint64)
    at = (window_min((grams & ~PLACE) | places, width) & PLACE).astype(np.int64)
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)[:n]
    valid = np.arange(n) + window <= bounds[1:][row]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    new &= valid
    first = np.flatnonzero(new)
    if not len(first):
        return empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # a run ends where the next begins, or where its row has no further window
    stop = np.minimum(np.append(first[1:], n), bounds[1:][row[first]] - window + 1)
    count = stop - first
    touched = _span_hash(codes, first, count + window - 1)
    return row[first], first - bounds[:-1][row[first]], count, grams[at[first]], touched


def _span_hash(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each codes[start:start+size], from one running sum."""
    from .textarrays import BASE
    base = np.uint64(int(BASE) * 5 % 2**64 | 1)
    n = len(codes)
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(codes, 9) * powers, out=total[1:])
    back = np.full(n, np.uint64(pow(int(base), -1, 2**64)), np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return mix(((total[start + size] - total[start]) * back[start])
               ^ (size.astype(np.uint64) << np.uint64(40)), 6)


def byte_units(column: pa.Array):
    """(units, bounds of the rows, begin and end of each unit in the bytes, bytes)."""
    data, bounds = utf8(column)
    at = np.arange(len(data) + 1)
    return data.astype(np.uint64), bounds, at[:-1], at[1:], data


def word_units(column: pa.Array):
    data, bounds = utf8(column)
    starts, ends, h, at = words(data, bounds)
    return h, at, starts, ends, data


def row_blocks(batch: pa.RecordBatch, limit: int = BLOCK):
    """Slices of a batch whose texts hold about ``limit`` bytes, one row at least."""
    _, bounds = utf8(batch["text"])
    for i, j in blocks(bounds, limit):
        yield batch.slice(i, j - i)


def runs(docs: DataFrame, units, window: int, k: int) -> DataFrame:
    """The runs of every row of ``docs`` (doc_id, rid, text)."""
    def run(batches):
        for batch in batches:
            for b in row_blocks(batch):
                codes, bounds, *_ = units(b["text"])
                row, a, n, seed, touched = runs_of(codes, bounds, window, k)
                if len(row):
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seed.view(np.int64)), pa.array(touched.view(np.int64)),
                         b["doc_id"].take(take), b["rid"].take(take),
                         pa.array(a.astype(np.int32)), pa.array(n.astype(np.int32))],
                        [c.split()[0] for c in RUNS.split(", ")])

    return docs.select("doc_id", "rid", "text").mapInArrow(tidy(run), RUNS)


class _Sorted:
    """The pass over one sorted partition of runs, batch by batch."""

    def __init__(self, within_document: bool):
        #: whether a second place in the same document repeats (operator 3) or not (6)
        self.within = within_document
        self.last = None    # seed, touched, first doc, first rid, first a
        self.multi = True   # the first seed may go on from the partition before
        self.held = []      # first class of the last seed, until a second one comes

    def batch(self, seed, touched, doc, rid, a, n):
        m = len(seed)
        new_seed, new_class = np.ones(m, bool), np.ones(m, bool)
        new_seed[1:] = seed[1:] != seed[:-1]
        new_class[1:] = touched[1:] != touched[:-1]
        if self.last is not None:
            new_seed[0] = seed[0] != self.last[0]
            new_class[0] = touched[0] != self.last[1]
        new_class |= new_seed
        at = np.flatnonzero(new_class)
        cid = np.cumsum(new_class)
        before = self.last or (0, 0, NO_ID, 0, -1)
        fd, fr, fa = (np.append(x, f[at])[cid] for x, f in
                      ((before[2], doc), (before[3], rid), (before[4], a)))
        same = (doc == fd) & (rid == fr) & (a == fa)
        copy = ~same if self.within else doc != fd
        member = new_class if self.within else doc == fd
        sid = np.cumsum(new_seed)
        per = np.bincount(sid, weights=new_class, minlength=sid[-1] + 1)
        wide = per >= 2
        if self.last is None:
            wide[1] = True
        goes_on = self.last is not None and not new_seed[0]
        wide[0] = self.multi or per[0] >= 1
        out = [np.flatnonzero(copy)]
        cand = member & wide[sid]
        out.append(np.flatnonzero(cand))
        rows = (seed, doc, rid, a, n)
        release = self.held if goes_on and wide[0] else []
        hold = member & ~wide[sid] & (sid == sid[-1])
        kept = [tuple(x[hold] for x in rows)] if hold.any() else []
        self.held = (self.held if goes_on and not wide[0] and sid[-1] == 0 else []) + kept
        self.multi = bool(wide[sid[-1]])
        self.last = (seed[-1], touched[-1], fd[-1], fr[-1], fa[-1])
        yield COPY, tuple(x[out[0]] for x in rows)
        yield CANDIDATE, tuple(x[out[1]] for x in rows)
        for x in release:
            yield CANDIDATE, x

    def end(self):
        for x in self.held:
            yield CANDIDATE, x


def classes(found: DataFrame, within_document: bool) -> DataFrame:
    """Copies and candidates (``FOUND``) of runs; the rest cannot repeat."""
    def run(batches):
        state = _Sorted(within_document)
        names = [c.split()[0] for c in FOUND.split(", ")]

        def rows(parts):
            for kind, (seed, doc, rid, a, n) in parts:
                if len(seed):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(seed), kind, np.int32)), pa.array(seed),
                         pa.array(doc, mask=doc == NO_ID), pa.array(rid), pa.array(a), pa.array(n)], names)

        for b in batches:
            if b.num_rows:
                doc = b["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
                yield from rows(state.batch(
                    b["seed"].to_numpy(), b["touched"].to_numpy(), doc, b["rid"].to_numpy(),
                    b["a"].to_numpy(), b["n"].to_numpy()))
        yield from rows(state.end())

    order = ["seed", "touched", "doc_id", "rid", "a"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidy(run), FOUND)


def with_lists(docs: DataFrame, found: DataFrame, name: str, *columns) -> DataFrame:
    """``docs`` with a list of structs per row (null: none).  A list is no
    longer than its document: what equal rows of a document found, as often as
    the row is repeated, counts once."""
    lists = found.groupBy("doc_id", "rid").agg(F.collect_set(F.struct(*columns)).alias(name))
    return docs.join(lists, same_row(docs, lists), "left").select(
        docs["doc_id"], docs["rid"], docs["text"], lists[name])


def pieces(docs: DataFrame, candidates: DataFrame, units, window: int) -> DataFrame:
    """(seed, doc_id, rid, a, n, piece): the bytes of the units that each
    candidate run touches."""
    def run(batches):
        for batch in batches:
            for b in row_blocks(batch):
                _, bounds, begin, end, data = units(b["text"])
                rows, seed, a, n, piece = [], [], [], [], []
                for i, some in enumerate(b["found"].to_pylist()):
                    base = bounds[i]
                    for x in some or ():
                        rows.append(i)
                        seed.append(x["seed"])
                        a.append(x["a"])
                        n.append(x["n"])
                        at = base + x["a"]
                        piece.append(data[begin[at]:end[at + x["n"] + window - 2]].tobytes())
                if rows:
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seed, pa.int64()), b["doc_id"].take(take), b["rid"].take(take),
                         pa.array(a, pa.int32()), pa.array(n, pa.int32()), pa.array(piece, pa.binary())],
                        ["seed", "doc_id", "rid", "a", "n", "piece"])

    return with_lists(docs, candidates, "found", "seed", "a", "n").filter("found is not null") \
        .mapInArrow(tidy(run), "seed long, doc_id long, rid long, a int, n int, piece binary")


def wide_repeats(wide: DataFrame, units, window: int, within_document: bool) -> DataFrame:
    """(doc_id, rid, a, n) of repeated windows in the pieces of wide seeds.

    A seed in very many surroundings (the edge of a passage that a large part
    of all documents share) would make one huge group of suffixes.  Its
    windows are grouped one by one by a 128-bit hash, with a map-side minimum.
    """
    def run(batches):
        for b in batches:
            codes, bounds, *_ = units(b["piece"])
            n = b["n"].to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = bounds[:-1][row] + within
            g, h = (mix(gram_hash(mix(codes, x), window), x).view(np.int64)[at] for x in (12, 13))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g), pa.array(h), b["doc_id"].take(take), b["rid"].take(take),
                 pa.array((b["a"].to_numpy()[row] + within).astype(np.int32))],
                ["g", "h", "doc_id", "rid", "a"])

    each = wide.mapInArrow(tidy(run), "g long, h long, doc_id long, rid long, a int")
    place = F.struct("doc_id", "rid", "a")
    first = each.groupBy("g", "h").agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .filter("first <> last")
    j = each.join(first, ["g", "h"])
    same = F.struct("doc_id", "rid", "a") == F.col("first") if within_document \
        else F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return j.filter(~same).select("doc_id", "rid", "a", F.lit(1).alias("n"))


def split_wide(found: DataFrame, limit: int = WIDE) -> tuple[DataFrame, DataFrame]:
    """(pieces of ordinary seeds, pieces of wide seeds)."""
    wide = found.groupBy("seed").agg(F.count(F.lit(1)).alias("w")).filter(F.col("w") > limit) \
        .select("seed")
    return found.join(wide, "seed", "left_anti"), found.join(wide, "seed", "left_semi")


def repeated(docs: DataFrame, units, window: int, k: int, within_document: bool, sort,
             wide: int = WIDE) -> tuple[DataFrame, DataFrame]:
    """(rows, found): the texts, and (doc_id, rid, a, n) of repeated windows.

    ``sort`` maps Arrow batches of ordinary pieces, sorted by seed within
    partitions that hold whole seeds, to (doc_id, rid, a, n).
    """
    rows = texts(docs)
    table = stored(classes(runs(rows, units, window, k), within_document), "runs")
    copies = table.filter(F.col("kind") == COPY).select("doc_id", "rid", "a", "n")
    cut = stored(pieces(rows, table.filter(F.col("kind") == CANDIDATE), units, window), "pieces")
    few, many = split_wide(cut, wide)
    sorted_ = few.repartition("seed").sortWithinPartitions("seed") \
        .mapInArrow(tidy(sort), "doc_id long, rid long, a int, n int")
    return rows, copies.unionByName(sorted_).unionByName(
        wide_repeats(many, units, window, within_document))


def seed_groups(batches, limit: int):
    """Lists (doc, rid, a, n, piece) of whole seeds, of about ``limit`` bytes."""
    held, size, last = [], 0, None
    for b in batches:
        for seed, *row in zip(*(b[c].to_pylist() for c in ("seed", "doc_id", "rid", "a", "n", "piece")),
                              strict=True):
            if size >= limit and seed != last:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
            last = seed
    if held:
        yield held


def as_ranges(piece: np.ndarray, place: np.ndarray):
    """Neighbouring places of a piece as (piece, first, count)."""
    order = np.lexsort((place, piece))
    piece, place = piece[order], place[order]
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    return piece[at], place[at], np.diff(np.append(at, len(piece)))

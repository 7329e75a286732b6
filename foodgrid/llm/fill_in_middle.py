"""Fill-in-the-middle transformation by displacement scatter (operator 12).

A text is cut at two token bounds into prefix, middle and suffix, and written
with marks as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm), or left as it is (plain).  The bytes of
a whole batch move at once: each piece has one displacement, so a difference
array over the batch holds three numbers a document, its running sum gives
every byte its place in the output, and one scatter writes them all.
:func:`restore` finds the marks in an output again, builds the displacements of
the way back and gathers; it reads nothing but output and form.

Tokens are ``[A-Za-z]+|[^A-Za-z]`` over code points.  The draw of a document
depends on its doc_id alone, so a retried task cuts at the same places.

Defined cases: null text is empty; an empty text, and one that has a mark in
it, is plain; a null doc_id draws as an empty one; rows with the same doc_id
draw alike; cuts may coincide, so any piece may be empty; a text longer than
``LIMIT`` is a batch of its own, and its bytes are placed ``STEP`` at a time, so
no index array grows with a text; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import blocks, tidy, utf8

#: The mark before each piece.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
FORMS = np.array(["plain", "psm", "spm"])
PLAIN, PSM, SPM = range(3)
PLAIN_FROM, SPM_BELOW = 90, 20      # percent
LIMIT = 4 << 20                     # bytes of text in a batch, one text at least
STEP = 1 << 20                      # bytes placed at once
FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
MARK_LETTERS = np.zeros(256, np.uint8)
for _i, _m in enumerate(MARKS.values(), 1):
    MARK_LETTERS[_m[1]] = _i


def code_point_starts(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a token begins: at each code point but a letter that follows a letter of its text."""
    letter = LETTER[data]
    follows = np.zeros(len(data), bool)
    follows[1:] = letter[:-1]
    first = bounds[:-1]
    follows[first[first < len(data)]] = False
    return code_point_starts(data) & ~(letter & follows)


def counts_before(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of ``mask`` are set before each place of ``at`` (ascending)."""
    out = np.zeros(len(at), np.int64)
    done = 0
    for x in range(0, len(mask), STEP):
        part = mask[x:x + STEP]
        a, b = np.searchsorted(at, (x, x + len(part)), side="right")
        upto = np.cumsum(part, dtype=np.int64)
        out[a:b] = done + upto[at[a:b] - x - 1]
        done += int(upto[-1])
    return out


def places_of(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the set entry with each of ``ranks`` (ascending, from 0) stands; the end beyond the last."""
    out = np.full(len(ranks), len(mask), np.int64)
    done = 0
    for x in range(0, len(mask), STEP):
        at = np.flatnonzero(mask[x:x + STEP])
        a, b = np.searchsorted(ranks, (done, done + len(at)))
        out[a:b] = x + at[ranks[a:b] - done]
        done += len(at)
    return out


def find_marks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, row, kind) of the marks inside the rows; kind counts in the order of ``MARKS``, from 1."""
    if len(data) < 3:
        return (np.zeros(0, np.int64),) * 3
    at = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62) & (MARK_LETTERS[data[1:-1]] > 0))
    row = np.searchsorted(bounds, at, side="right") - 1
    inside = at + 3 <= bounds[row + 1]
    return at[inside], row[inside], MARK_LETTERS[data[at[inside] + 1]]


def displaced(points: np.ndarray, shifts: np.ndarray, size: int):
    """(x, y, place of each byte x <= i < y): byte i moves by the shift of the
    last point at or before it.  ``points`` ascend; of equal ones the last counts."""
    steps = np.diff(shifts, prepend=0)
    moved = 0
    for x in range(0, size, STEP):
        y = min(size, x + STEP)
        a, b = np.searchsorted(points, (x, y))
        change = np.zeros(y - x, np.int64)
        np.add.at(change, points[a:b] - x, steps[a:b])
        change[0] += moved
        move = np.cumsum(change)
        moved = int(move[-1])
        yield x, y, move + np.arange(x, y)


def _laid(*columns: np.ndarray) -> np.ndarray:
    """One value of each column after another, row by row."""
    return np.stack(columns, axis=1).reshape(-1)


def cut(data: np.ndarray, bounds: np.ndarray, h: list[np.ndarray]) -> dict[str, np.ndarray]:
    """n, form and the byte places c1, c2 of both cuts of each text."""
    starts = token_starts(data, bounds)
    before = counts_before(starts, bounds)
    n = np.diff(before)
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    lo, hi = np.minimum(one, two), np.maximum(one, two)
    place = places_of(starts, _laid(before[:-1] + lo, before[:-1] + hi)).reshape(-1, 2)
    # the token after a text's last is the next text's first, but for texts without tokens between
    c1, c2 = (np.minimum(place[:, i], bounds[1:]) for i in (0, 1))
    form = np.where(h[3] % 100 < SPM_BELOW, SPM, PSM)
    form[(n == 0) | (h[2] % 100 >= PLAIN_FROM)] = PLAIN
    form[find_marks(data, bounds)[1]] = PLAIN
    return {"n": n, "form": form, "c1": c1, "c2": c2}


def scatter(data: np.ndarray, bounds: np.ndarray, form: np.ndarray, c1: np.ndarray,
            c2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of the outputs."""
    s, e = bounds[:-1], bounds[1:]
    marked = form != PLAIN
    out_bounds = np.concatenate([[0], np.cumsum(e - s + 9 * marked)])
    o = out_bounds[:-1]
    p, suf = c1 - s, e - c2
    prefix = np.where(form == PSM, o + 3, np.where(form == SPM, o + 6 + suf, o))
    suffix = np.where(form == PSM, o + 6 + p, np.where(form == SPM, o + 3, o + c2 - s))
    middle = np.where(marked, o + 9 + p + suf, o + p)
    out = np.empty(out_bounds[-1], np.uint8)
    points = _laid(s, c1, c2)
    for x, y, place in displaced(points, _laid(prefix - s, middle - c1, suffix - c2), len(data)):
        out[place] = data[x:y]
    for name, at in (("prefix", prefix), ("suffix", suffix), ("middle", middle)):
        for i, byte in enumerate(MARKS[name]):
            out[at[marked] - 3 + i] = byte
    return out, out_bounds


def gather(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of the texts, from outputs and forms alone."""
    s, e = bounds[:-1], bounds[1:]
    marked = np.flatnonzero(form != PLAIN)
    at, row, kind = find_marks(data, bounds)
    own = np.isin(row, marked)
    at, row, kind = at[own], row[own], kind[own]
    order = np.where(form[marked] == PSM, 123, 213)
    if not np.array_equal(row, np.repeat(marked, 3)) or not np.array_equal(
            kind.reshape(-1, 3) @ np.array([100, 10, 1]), order) or not np.array_equal(at[::3], s[marked]):
        raise ValueError("an output does not have the marks of its form")
    _, m2, m3 = at.reshape(-1, 3).T
    r_bounds = np.concatenate([[0], np.cumsum(e - s - 9 * (form != PLAIN))])
    r = r_bounds[:-1]
    prefix, middle, suffix = s.copy(), e.copy(), e.copy()   # where each piece stands in the output
    p, m = e - s, np.zeros(len(s), np.int64)                # plain: all of it is prefix
    psm = form[marked] == PSM
    prefix[marked] = np.where(psm, s[marked] + 3, m2 + 3)
    suffix[marked] = np.where(psm, m2 + 3, s[marked] + 3)
    middle[marked] = m3 + 3
    p[marked] = np.where(psm, m2, m3) - prefix[marked]
    m[marked] = e[marked] - middle[marked]
    out = np.empty(r_bounds[-1], np.uint8)
    points = _laid(r, r + p, r + p + m)
    for x, y, place in displaced(points, _laid(prefix - r, middle - r - p, suffix - r - p - m), len(out)):
        out[x:y] = data[place]
    return out, r_bounds


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))


def _numbers(batch, column: str) -> np.ndarray:
    return batch[column].to_numpy(zero_copy_only=False).astype(np.int64)


def transform(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def run(batches):
        for b in batches:
            every, all_bounds = utf8(b["text"])
            h = [_numbers(b, f"h{i}") for i in range(1, 5)]
            for i, j in blocks(all_bounds, LIMIT):
                data = every[all_bounds[i]:all_bounds[j]]
                bounds = all_bounds[i:j + 1] - all_bounds[i]
                got = cut(data, bounds, [x[i:j] for x in h])
                out, out_bounds = scatter(data, bounds, got["form"], got["c1"], got["c2"])
                upto = counts_before(code_point_starts(data), _laid(bounds[:-1], got["c1"], got["c2"])).reshape(-1, 3)
                plain = got["form"] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(i, j - i), pa.array(got["n"]), pa.array(FORMS[got["form"]], pa.string()),
                     pa.array(upto[:, 1] - upto[:, 0], pa.int64(), mask=plain),
                     pa.array(upto[:, 2] - upto[:, 1], pa.int64(), mask=plain), _strings(out, out_bounds)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"), *draws)
    return rows.mapInArrow(tidy(run), FIELDS)


def restore(rows: DataFrame) -> DataFrame:
    """The rows of :func:`transform` with ``restored``, the text rebuilt from
    ``output`` and ``form``.  An output without the marks of its form fails."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches):
        for b in batches:
            every, all_bounds = utf8(b["output"])
            form = np.array([{"plain": PLAIN, "psm": PSM, "spm": SPM}[f] for f in b["form"].to_pylist()], np.int64)
            for i, j in blocks(all_bounds, LIMIT):
                out, bounds = gather(every[all_bounds[i]:all_bounds[j]], all_bounds[i:j + 1] - all_bounds[i], form[i:j])
                yield pa.RecordBatch.from_arrays([b[c].slice(i, j - i) for c in names] + [_strings(out, bounds)],
                                                 [*names, "restored"])

    return rows.select(*names).mapInArrow(tidy(run), f"{FIELDS}, restored string")


def digests(docs: DataFrame) -> DataFrame:
    """The transformation there and back, as digests."""
    return restore(transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))

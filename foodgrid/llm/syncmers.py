"""Document fingerprints from closed syncmers (operator 1).

A k-mer of code points is a closed syncmer when the smallest hash among its
s-mers stands at its first or last place.  That depends on the k-mer alone,
so the same passage gives the same anchors wherever it stands.  The
fingerprint of a text keeps all anchors with a hash below ``ALWAYS`` (one in 16,
so their number grows with the text, and a passage keeps the same ones in every
text), and at least its ``ANCHORS`` anchors of smallest hash, written
as 8 hex digits each in text order.  The likeness of two fingerprints is read
from the two strings: of the hashes below ``ALWAYS`` of both together, or the
``ANCHORS`` smallest if those are more, the share
found in both in the same order (a longest increasing chain, so anchors
that match by chance elsewhere in the text do not count).

Defined cases: null text is empty; the fingerprint of an empty text is the
empty string; a text with fewer than k code points has one anchor, of the
whole text; a longer one without any syncmer (at most 9 k-mers) has all its
k-mers as anchors; two empty fingerprints have likeness 1, one empty and one not 0;
equal texts have equal fingerprints and likeness 1.  In ``with_edited`` the
next document is the one with the next doc_id (null first; rows of one doc_id
in order of their text), the last one's next is the first; a single document
is its own next.  Long texts are hashed in overlapping segments, so besides
the text only its anchors (about one in 88 code points) are held.  An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import gram_hash, mix, tidy, window_min

K, S, ANCHORS = 16, 6, 64
ALWAYS = 1 << 28      # of hashes below 2**32
SEGMENT = 1 << 19     # code points hashed at once
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, n_anchors int")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _anchors(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the closed syncmers of ``codes``."""
    return _kmers(codes, k, _syncmers(codes, k, s))


def _syncmers(codes: np.ndarray, k: int, s: int) -> np.ndarray:
    """The positions of the closed syncmers of ``codes``."""
    inner = mix(gram_hash(codes.astype(np.uint64), s), 1)
    width = k - s + 1
    low = window_min(inner, width)
    n = len(low)
    return np.flatnonzero((inner[:n] == low) | (inner[width - 1:width - 1 + n] == low))


def _kmers(codes: np.ndarray, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the k-mers of ``codes`` at ``at``."""
    # a k-mer's hash, from its overlapping halves: only where it is asked for
    whole = gram_hash(codes.astype(np.uint64), k)[at]
    return (mix(whole, 2) >> np.uint64(32)).astype(np.uint32), at


def _smallest(h: np.ndarray, at: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes below ``ALWAYS``, the m smallest at least, with their first positions."""
    if len(h) > 4 * m:  # only the lowest part need be sorted
        cut = max(np.partition(h, 2 * m)[2 * m], np.uint32(ALWAYS))
        part = h <= cut
        u, first = np.unique(h[part], return_index=True)
        n = max(m, int(np.searchsorted(u, ALWAYS)))
        if len(u) >= m:
            return u[:n], at[part][first[:n]]
    u, first = np.unique(h, return_index=True)
    n = max(m, int(np.searchsorted(u, ALWAYS)))
    return u[:n], at[first[:n]]


def sketch(texts: list[str], k: int = K, s: int = S, m: int = ANCHORS) -> list[tuple]:
    """(hashes in text order) of each text, texts hashed together in blocks."""
    out: list[np.ndarray | None] = [None] * len(texts)
    todo: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        nonlocal held
        if not todo:
            return
        codes = np.concatenate([c for _, c in todo])
        h, at = _anchors(codes, k, s)
        begin = 0
        for i, c in todo:
            a, b = np.searchsorted(at, (begin, begin + len(c) - k + 1))
            if a < b:
                u, p = _smallest(h[a:b], at[a:b], m)
            else:  # too short to be sure of a syncmer, and has none
                u, p = _smallest(*_kmers(c, k, np.arange(len(c) - k + 1)), m)
            out[i] = u[np.argsort(p, kind="stable")]
            begin += len(c)
        todo.clear()
        held = 0

    for i, t in enumerate(texts):
        if len(t) < k:
            d = hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=4).digest()
            out[i] = np.frombuffer(d, np.uint32) if t else np.zeros(0, np.uint32)
        elif len(t) <= SEGMENT:
            todo.append((i, code_points(t)))
            held += len(t)
            if held >= SEGMENT:
                flush()
        else:
            hs, ps = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            for b in range(0, len(t) - k + 1, SEGMENT):
                h, p = _anchors(code_points(t[b:b + SEGMENT + k - 1]), k, s)
                hs, ps = _smallest(np.concatenate([hs, h]), np.concatenate([ps, p + b]), m)
            out[i] = hs[np.argsort(ps, kind="stable")]
    flush()
    return out


def to_text(anchors: np.ndarray) -> str:
    return anchors.astype(">u4").tobytes().hex()


def _chain(places: np.ndarray) -> int:
    """Length of the longest increasing chain."""
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    import bisect
    tails: list[int] = []
    for p in places.tolist():
        i = bisect.bisect_left(tails, p)
        tails[i:i + 1] = [p]
    return len(tails)


def likeness_of(a: np.ndarray, b: np.ndarray, m: int = ANCHORS) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    ia, ib = np.argsort(a), np.argsort(b)
    sa, sb = a[ia], b[ib]
    at = np.minimum(np.searchsorted(sb, sa), len(sb) - 1)
    both = sb[at] == sa
    if not both.any():
        return 0.0
    union = np.union1d(sa, sb)
    # all below ALWAYS, m at least; beyond them a sketch says nothing
    size = max(min(len(union), m), int(np.searchsorted(union, ALWAYS)))
    both &= sa <= union[size - 1]
    order = np.argsort(ia[both])
    return _chain(ib[at[both]][order]) / size


def likeness(x: str, y: str, m: int = ANCHORS) -> float:
    """Likeness (0 to 1) of two fingerprint strings."""
    return likeness_of(*(np.frombuffer(bytes.fromhex(t), ">u4").astype(np.uint32) for t in (x, y)), m)


def fingerprints(docs: DataFrame, k: int = K, s: int = S, m: int = ANCHORS) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``, with no shuffle."""
    def run(batches):
        for b in batches:
            got = sketch(b["text"].to_pylist(), k, s, m)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([to_text(a) for a in got], pa.string())],
                ["doc_id", "fingerprint"])

    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")) \
        .mapInArrow(tidy(run), "doc_id long, fingerprint string")


def in_order_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(part, doc_id, text, extra) sorted in each partition by part and
    doc_id: each part is a range of doc_id, followed by a copy (``extra``) of
    the first document of the next one.  One shuffle of the texts."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / parts for i in range(1, parts)]
    # one row of parts - 1 numbers
    bounds = ids.select(F.percentile_approx("doc_id", F.lit(at), F.lit(20 * parts))).first()[0]
    bounds = sorted(set(bounds or []))
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(
        _part_of(bounds))
    heads = ids.withColumn("part", part).groupBy("part").agg(
        F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    if not heads:
        return rows.withColumns({"part": F.lit(0), "extra": F.lit(False)}).select(
            "part", "doc_id", "text", "extra")
    # the part before each head; a null id (part 0 only) comes before all ids
    no_id = ids.filter("doc_id is null").limit(1).count()
    before = [(heads[i]["part"], None if i == 0 and no_id else heads[i]["head"],
               heads[i - 1]["part"], i == 0) for i in range(len(heads))]
    head = F.broadcast(spark.createDataFrame(before, "p int, head long, goes int, wraps boolean"))
    rows = rows.withColumn("part", part)
    j = rows.join(head, (rows["part"] == head["p"]) & rows["doc_id"].eqNullSafe(head["head"]), "left")
    own = F.struct(F.col("part"), F.lit(0).alias("extra"))
    ahead = F.struct(F.col("goes").alias("part"), F.lit(1).alias("extra"))
    return (j.withColumn("to", F.explode(F.when(F.col("goes").isNull(), F.array(own))
                                         .otherwise(F.array(own, ahead))))
            .select(F.col("to.part").alias("part"), "doc_id", "text",
                    (F.col("to.extra") == 1).alias("extra"))
            .repartition("part").sortWithinPartitions("part", "extra", "doc_id", "text"))


def _part_of(bounds: list[int]):
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def part(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, doc_id.fillna(0).to_numpy(np.int64), side="right")
                         .astype(np.int32))

    return part("doc_id")


def with_edited(docs: DataFrame, k: int = K, s: int = S, m: int = ANCHORS) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the second half
    replaced by the first half's length of the next document), and the
    likeness of its fingerprint to the edited text's and the next document's."""

    def run(batches):
        cols = {c: [] for c in [f.split()[0] for f in SCHEMA.split(", ")]}
        last = None  # (part, doc_id, text): waits for its next document

        def pairs():
            nonlocal last
            for b in batches:
                for part, doc_id, text, extra in zip(*(b[c].to_pylist() for c in
                                                       ("part", "doc_id", "text", "extra")),
                                                     strict=True):
                    if last is not None and last[0] == part:
                        yield last[1], last[2], text
                    last = None if extra else (part, doc_id, text)

        def rows(some):
            edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for _, t, n in some]
            got = sketch([t for _, t, _ in some] + [some[-1][2]] + edited, k, s, m)
            own, edit = got[:len(some) + 1], got[len(some) + 1:]
            after = [own[i + 1] if i + 1 < len(some) and some[i + 1][1] is some[i][2] else None
                     for i in range(len(some) - 1)] + [own[-1]]
            for i, (d, t, n) in enumerate(some):
                nxt = after[i] if after[i] is not None else sketch([n], k, s, m)[0]
                yield (d, len(t), hashlib.sha256(edited[i].encode("utf-8", "surrogatepass")).hexdigest(),
                       to_text(own[i]), to_text(edit[i]), likeness_of(own[i], edit[i], m),
                       likeness_of(own[i], nxt, m), len(own[i]))

        def out(some):
            r = list(zip(*rows(some), strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                     pa.float64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(r, kinds, strict=True)],
                                              list(cols))

        some, held = [], 0
        for x in pairs():
            some.append(x)
            held += len(x[1])
            if held >= SEGMENT or len(some) >= 2000:
                yield out(some)
                some, held = [], 0
        if some:
            yield out(some)

    return in_order_with_next(docs).mapInArrow(tidy(run), SCHEMA)

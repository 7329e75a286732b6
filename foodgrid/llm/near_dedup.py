"""Near-duplicate groups by MinHash with sequential Bayesian verification
(operator 10).

Documents are sets of distinct word shingles; two are linked when their
Jaccard similarity is at least ``similarity``, and a group is a connected
component of links.

1. Each set gets 64 bands of 8 MinHash values, from one pass over the texts.
   Equal sets form a class, which is one node from here on.
2. Bands are sorted across the cluster by (band value, node), range
   partitioned, so a hot bucket spreads over partitions.  In a bucket only
   star edges to its first member are made, never all pairs.  An edge whose
   signatures rule out a similarity that could matter is dropped; members
   that were dropped, and those they could still be linked to, form a smaller
   bucket for the next round, until no bucket has an undecided pair.
3. Components of the edges left are the candidates: linked documents are in
   one candidate component.  Each document's set is sent to its component
   once.  Components of more than ``GROUP`` documents are cut into blocks,
   with a few hub documents in every block to join them.  Of the documents that
   are then not in their component's main group, up to ``GROUP`` are compared
   with every block; more are compared where they share a band, the bucket cut
   into chunks of ``GROUP`` and a block being two chunks.
4. In a block a document is compared with the earlier ones of other groups:
   signatures batch by batch, pruning a pair as soon as the posterior chance
   that it reaches the similarity is below ``MISS``; what survives is verified
   on the full sets, the most similar first.

So no link between different sets is lost but by a band or posterior miss
(below 1e-5 at the threshold), and nothing of the size of the corpus or of a
group comes to the driver or to one task.

Defined cases: null text and texts without words have an empty set and are
linked with nothing; texts of fewer words than a shingle have their whole
sequence as one; a null doc_id is never the smallest unless the whole group
has none; rows with one doc_id and other text are documents of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import components, one_each, same_row, stored, texts, unused
from .repeats import row_blocks
from .textarrays import gram_hash, mix, tidy, utf8, words

BANDS, ROWS = 64, 8
SMALL = 64          # sets up to 5/4 of this get bands of independent hashes too
BATCH = 32          # signature values compared at a time
PLAIN = 256         # sets from here have signatures of one permutation in bins
OWN = 427           # sets up to here (PLAIN / 0.6) have signatures of independent hashes
MISS = 1e-9         # posterior chance at which a pair is given up
GROUP = 2048        # documents in one block
HUBS = 16
EDGE_BYTES = 128    # signature bytes an edge is judged by
ROUNDS = 4          # of stars; what a bucket has left then is judged in blocks
CHUNK = 2048        # members of a bucket in a chunk; a block is two chunks
SEEN = 100_000      # sets a task remembers, so as not to send copies again


# --- sets and signatures ----------------------------------------------------------

def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    data, bounds = utf8(column)
    _, _, h, at = words(data, bounds, lower=True)
    h = mix(h, 21)
    grams = mix(gram_hash(h, width), 22) if len(h) >= width else h[:0]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:  # the whole sequence as one
            out.append(mix(gram_hash(h[a:b], b - a) + np.uint64(b - a), 23))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@lru_cache(maxsize=1)
def probes() -> np.ndarray:
    """The order in which an empty bin looks for a full one."""
    keys = mix(np.arange(BANDS * BANDS, dtype=np.uint64), 24).reshape(BANDS, BANDS)
    return np.argsort(keys, axis=1)


def one_permutation(s: np.ndarray) -> np.ndarray:
    """ROWS x BANDS MinHash values: in each of ROWS hashings a set falls into
    BANDS bins, whose minima are the values; an empty bin borrows another's."""
    h = np.sort(mix(s[None, :] + np.arange(ROWS, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15), 25),
                axis=1)
    edges = np.arange(BANDS, dtype=np.uint64) << np.uint64(58)
    out = np.empty((ROWS, BANDS), np.uint64)
    for r in range(ROWS):
        i = np.searchsorted(h[r], edges)
        full = np.append(i[1:], h.shape[1]) > i
        v = h[r][np.minimum(i, h.shape[1] - 1)]
        if not full.all():
            order = probes()
            v = np.where(full, v, v[order[np.arange(BANDS), full[order].argmax(axis=1)]])
        out[r] = v
    return out


def _hashed(s: np.ndarray, n: int) -> np.ndarray:
    seeds = mix(np.arange(n, dtype=np.uint64), 26)
    return mix(s[None, :] ^ seeds[:, None], 27).min(axis=1)


def independent(s: np.ndarray) -> np.ndarray:
    """ROWS x BANDS MinHash values of as many hash functions, for small sets."""
    return _hashed(s, ROWS * BANDS).reshape(ROWS, BANDS)


def own_signature(s: np.ndarray) -> np.ndarray:
    """EDGE_BYTES bytes, one of each of as many independent MinHash values."""
    return (_hashed(s, EDGE_BYTES) & np.uint64(0xFF)).astype(np.uint8)


def band_values(sig: np.ndarray, seed: int) -> np.ndarray:
    scale = mix(np.arange(ROWS, dtype=np.uint64), 28) | np.uint64(1)
    return mix((sig * scale[:, None]).sum(axis=0, dtype=np.uint64)
               + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), seed)


def signature(s: np.ndarray) -> np.ndarray:
    """512 bytes, one of each MinHash value."""
    return (one_permutation(s) & np.uint64(0xFF)).astype(np.uint8).reshape(-1)


SKETCH = "doc_id long, rid long, n int, k1 long, k2 long, sig binary, own binary, bands array<long>"


def sketches(rows: DataFrame, width: int) -> DataFrame:
    """Size, identity, signature and bands of every row's set.  A set that the
    task has met before has no bands: the first one speaks for the class."""
    def run(batches):
        seen: set = set()
        for batch in batches:
            for b in row_blocks(batch):
                n, k1, k2, sig, own, bands = [], [], [], [], [], []
                for s in shingle_sets(b["text"], width):
                    key = (int(mix(s, 29).sum(dtype=np.uint64).view(np.int64)),
                           int(mix(s, 30).sum(dtype=np.uint64).view(np.int64)))
                    n.append(len(s))
                    k1.append(key[0])
                    k2.append(key[1])
                    if not len(s) or key in seen:
                        sig.append(None)
                        own.append(None)
                        bands.append(None)
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    got = []
                    if len(s) < SMALL * 5 // 4 + 1:
                        got.append(band_values(independent(s), 31))
                    if len(s) >= SMALL:
                        one = one_permutation(s)
                        got.append(band_values(one, 32))
                    sig.append((one & np.uint64(0xFF)).astype(np.uint8).reshape(-1)[:EDGE_BYTES].tobytes()
                               if len(s) >= PLAIN else None)
                    own.append(own_signature(s).tobytes() if len(s) <= OWN else None)
                    bands.append(np.concatenate(got).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"], b["rid"], pa.array(n, pa.int32()), pa.array(k1, pa.int64()),
                     pa.array(k2, pa.int64()), pa.array(sig, pa.binary()), pa.array(own, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], [c.split()[0] for c in SKETCH.split(", ")])

    return rows.select("doc_id", "rid", "text").mapInArrow(tidy(run), SKETCH)


# --- posterior bounds -------------------------------------------------------------

@lru_cache(maxsize=None)
def least_matches(n: int, similarity: float, miss: float) -> int:
    """The fewest matches among n signature bytes at which the posterior
    (uniform prior) chance of at least ``similarity`` reaches ``miss``.

    Bytes of different values agree by chance once in 256.  The posterior
    tail of a Beta distribution is a binomial sum.
    """
    p = similarity + (1 - similarity) / 256
    total, m = 0.0, 0
    while m <= n:
        total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                          + m * math.log(p) + (n + 1 - m) * math.log1p(-p))
        if total >= miss:
            return m
        m += 1
    return n


def survivors(one: np.ndarray, others: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(indices, matches) of rows of ``others`` not ruled out, batch by batch."""
    left = np.arange(len(others))
    matches = np.zeros(len(others), np.int32)
    for begin in range(0, others.shape[1], BATCH):
        if not len(left):
            break
        end = begin + BATCH
        matches = matches + (others[left, begin:end] == one[begin:end]).sum(axis=1)
        keep = matches >= least_matches(end, similarity, MISS)
        left, matches = left[keep], matches[keep]
    return left, matches


# --- candidate edges --------------------------------------------------------------

STARS = "kind int, band long, a long, b long"


def stars(members: DataFrame) -> DataFrame:
    """Edges (band, a, b) from the first member of each bucket to the others.

    ``members``: (band, rid).  A bucket that goes over a partition's end is
    joined through the partitions' first and last rows.
    """
    def run(batches):
        names = [c.split()[0] for c in STARS.split(", ")]
        last, head, none = None, 0, True

        def rows(kind, band, a, b):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(band, pa.int64()),
                 pa.array(a, pa.int64()), pa.array(b, pa.int64())], names)

        for x in batches:
            if not x.num_rows:
                continue
            band, rid = x["band"].to_numpy(), x["rid"].to_numpy()
            new = np.append(last is None or band[0] != last, band[1:] != band[:-1])
            at = np.flatnonzero(new)
            first = np.append(head, rid[at])[np.cumsum(new)]
            if none:
                yield rows(1, band[:1], rid[:1], rid[:1])
                none = False
            other = rid != first
            if other.any():
                yield rows(0, band[other], first[other], rid[other])
            last, head = band[-1], first[-1]
        if not none:
            yield rows(1, [last], [head], [head])

    made = stored(members.repartitionByRange("band", "rid").sortWithinPartitions("band", "rid")
                  .mapInArrow(tidy(run), STARS), "stars")
    ends = made.filter("kind = 1").select("band", "a")   # two rows per partition
    least = ends.groupBy("band").agg(F.min("a").alias("a"))
    across = ends.withColumnRenamed("a", "b").join(least, "band").filter("a <> b").distinct()
    return made.filter("kind = 0").select("band", "a", "b").unionByName(across.select("band", "a", "b"))


def _matches(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal signature bytes of each pair of rows; a row is the signature of
    independent hashes, that of bins, and whether it has either.  Sets of which
    one has only the first and one only the second differ too much in size to be near."""
    own = x[:, -2] & y[:, -2] > 0
    bins = (x[:, -1] & y[:, -1] > 0) & ~own
    n = EDGE_BYTES
    return np.where(own, (x[:, :n] == y[:, :n]).sum(axis=1),
                    np.where(bins, (x[:, n:2 * n] == y[:, n:2 * n]).sum(axis=1), 0))


def _signatures(own: list, sig: list) -> np.ndarray:
    none = bytes(EDGE_BYTES)
    return np.frombuffer(b"".join((o or none) + (s or none) + bytes([o is not None, s is not None])
                                  for o, s in zip(own, sig, strict=True)), np.uint8).reshape(len(own), -1)


def judged(edges: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Adds ``near`` (the two could have a common linked document, so 2s - 1
    or more) and ``sure`` (far above the threshold) to edges (a, b)."""
    one = sketch.filter("bands is not null").groupBy("rid").agg(F.first("sig").alias("sig"), F.first("own").alias("own"))
    side = lambda c, x, o: one.select(F.col("rid").alias(c), F.col("sig").alias(x), F.col("own").alias(o))
    both = edges.join(side("a", "x", "ox"), "a").join(side("b", "y", "oy"), "b")

    def run(batches):
        low = least_matches(EDGE_BYTES, max(0.0, 2 * similarity - 1), MISS)
        for b in batches:
            if not b.num_rows:
                continue
            sides = [_signatures(b[o].to_pylist(), b[x].to_pylist()) for o, x in (("ox", "x"), ("oy", "y"))]
            m = _matches(*sides)
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(m >= low), pa.array(m >= EDGE_BYTES * 0.97)],
                                             ["a", "b", "near", "sure"])

    return both.select("a", "b", "x", "ox", "y", "oy").mapInArrow(
        tidy(run), "a long, b long, near boolean, sure boolean")


def near_in_block(sig: np.ndarray, first: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs (i, j) that join all rows of a block that may be linked.  ``first``:
    rows of the first of two chunks, which are compared with the second only."""
    low = least_matches(EDGE_BYTES, similarity, MISS)
    n = len(sig)
    root = np.arange(n)
    across = first.any() and not first.all()
    left, right = (np.flatnonzero(first), np.flatnonzero(~first)) if across else (np.arange(n), np.arange(n))
    out = []
    for k, i in enumerate(left.tolist()):
        other = right if across else right[k + 1:]
        other = other[root[other] != root[i]]   # joined already
        hit = other[_matches(np.broadcast_to(sig[i], (len(other), sig.shape[1])), sig[other]) >= low]
        for j in hit.tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def block_edges(members: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that join all members (band, rid) of a bucket that may be
    linked, each pair judged once: a bucket is dealt into chunks of about ``CHUNK``,
    and every two chunks are a block of one task.  Edges of a block join rows
    that were apart, so there are fewer than it has rows."""
    one = sketch.filter("bands is not null").groupBy("rid").agg(F.first("sig").alias("sig"), F.first("own").alias("own"))
    sizes = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("rid", F.lit(33)), F.col("chunks")).cast("int")
    dealt = members.join(sizes, "band").withColumn("chunk", chunk) \
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))) \
        .filter("chunks = 1 or other <> chunk") \
        .select("band", "rid", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk")
    # two chunks together hold each one's own pairs as well: they are left to one block of each
    own = members.join(sizes.filter("chunks > 1"), "band").withColumn("chunk", chunk) \
        .select("band", "rid", F.col("chunk").alias("i"), F.col("chunk").alias("j"), "chunk")
    rows = dealt.unionByName(own).join(one.hint("merge"), "rid")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("rid")
        rid = pdf["rid"].to_numpy()
        first = (pdf["chunk"] == key[1]).to_numpy() if key[1] != key[2] else np.ones(len(pdf), bool)
        absent = lambda c: [None if v is None or isinstance(v, float) else bytes(v) for v in pdf[c]]
        pairs = near_in_block(_signatures(absent("own"), absent("sig")), first, similarity)
        return pd.DataFrame({"a": [int(rid[i]) for i, _ in pairs], "b": [int(rid[j]) for _, j in pairs]}, dtype="int64")

    return rows.groupBy("band", "i", "j").applyInPandas(run, "a long, b long")


def candidate_edges(sketch: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that join every two documents that may be linked.

    Stars settle most buckets in a round or two.  A bucket that a template fills
    with documents far from each other would take a round for each: after
    ``ROUNDS`` what is left is judged pair by pair, in blocks.
    """
    members = sketch.filter("bands is not null").select("rid", F.explode("bands").alias("band"))
    kept = None
    for _ in range(ROUNDS):
        made = stored(stars(members), "buckets")
        verdict = stored(judged(made.select("a", "b").distinct(), sketch, similarity), "verdict")
        near = verdict.filter("near").select("a", "b")
        kept = near if kept is None else kept.unionByName(near)
        if verdict.filter("not near").isEmpty():
            return kept.distinct()
        # Buckets with a member that was dropped: it may be linked to another
        # one dropped, or to one that is not very near the first member.  They are
        # read three times from here, so they are written once.
        told = made.join(verdict, ["a", "b"])
        several = told.groupBy("band").agg(F.max(~F.col("near")).alias("open"), F.count_if(~F.col("sure")).alias("m")) \
            .filter("open and m > 1").select("band")
        members = stored(told.filter("not sure").select("band", F.col("b").alias("rid"))
                         .join(several, "band", "left_semi"), "members")
        if members.isEmpty():
            return kept.distinct()
    rest = stored(block_edges(members, sketch, similarity), "blocks")
    return kept.unionByName(rest).distinct()


# --- verification on sets ---------------------------------------------------------

def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    i = np.searchsorted(y, x)
    i[i == len(y)] = 0
    return int((y[i] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = overlap(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def link(sets: list[np.ndarray], group: list[int], percent: int,
         only: np.ndarray | None = None, across: bool = False) -> list[tuple[int, int]]:
    """Links (i, j) that join all documents linked through any of ``sets``.

    ``group``: documents with equal numbers are joined already.  ``only``:
    mask of the documents of which one must be in a pair (else all pairs);
    with ``across`` exactly one.
    """
    n, similarity = len(sets), percent / 100
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict[int, int] = {}
    for i, g in enumerate(group):
        root[i] = find(first.setdefault(g, i))
    size = np.array([len(s) for s in sets])
    sig = np.zeros((n, ROWS * BANDS), np.uint8)
    for i, s in enumerate(sets):
        if len(s) >= PLAIN * 4 // 5:
            sig[i] = signature(s)
    out = []
    order = np.argsort(size, kind="stable")
    place = np.sort(size)
    few = int(np.searchsorted(place, PLAIN))   # sets compared with all smaller ones at once
    _, codes = np.unique(np.concatenate([sets[i] for i in order[:few]] or [np.zeros(0, np.uint64)]),
                         return_inverse=True)
    start = np.append(0, np.cumsum(place[:few]))
    has = np.zeros(len(codes), np.int32)
    for k, i in enumerate(order.tolist()):
        # sizes alone rule out documents much smaller than this one
        low = int(np.searchsorted(place, math.ceil(similarity * size[i] - 1e-9)))
        cand = order[low:k]
        if not len(cand):
            continue
        if k < few:
            mine = codes[start[k]:start[k + 1]]
            has[mine] = 1
            both = np.add.reduceat(has[codes[start[low]:start[k]]], start[low:k] - start[low])
            has[mine] = 0
            cand = cand[100 * both >= percent * (size[i] + size[cand] - both)]
        if only is not None and not only[i]:
            cand = cand[only[cand]]
        elif across:
            cand = cand[~only[cand]]
        mine = find(i)
        cand = cand[[find(j) != mine for j in cand.tolist()]] if len(cand) else cand
        if not len(cand):
            continue
        if size[i] >= PLAIN:
            keep, score = survivors(sig[i], sig[cand], similarity)
            cand = cand[keep][np.argsort(-score, kind="stable")]
        for j in cand.tolist():
            if find(j) != find(i) and (k < few or linked(sets[i], sets[j], percent)):
                root[find(j)] = find(i)
                out.append((i, j))
    return out


SETS = "root long, block string, node long, grp long, extra boolean, across boolean, s binary"
LINKS = "a long, b long"


def link_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links in each (root, block) of ``rows`` (``SETS``), one block in memory:
    of pairs with an ``extra`` document, in an ``across`` block exactly one."""
    def run(batches):
        def blocks():
            held, last = [], None
            for b in batches:
                for root, block, *x in zip(*(b[c].to_pylist() for c in
                                             ("root", "block", "node", "grp", "extra", "across", "s")), strict=True):
                    if (root, block) != last and held:
                        yield held
                        held = []
                    last = (root, block)
                    held.append(x)
            if held:
                yield held

        for held in blocks():
            sets = [np.frombuffer(x[4], np.uint64) for x in held]
            got = link(sets, [x[1] for x in held], percent, np.array([x[2] for x in held]), held[0][3])
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[i][0] for i, _ in got], pa.int64()),
                 pa.array([held[j][0] for _, j in got], pa.int64())], ["a", "b"])

    return rows.repartition("root", "block").sortWithinPartitions("root", "block", "node") \
        .mapInArrow(tidy(run), LINKS)


def bucket_blocks(told: DataFrame, bands: DataFrame) -> DataFrame:
    """(root, block, node, grp, extra, across) that brings every extra document
    of ``told`` together with the documents of other groups that share a band
    with it.  A bucket of more than ``GROUP`` is cut into chunks, and a block is
    a chunk of extras, or one with another chunk: two chunks at most."""
    of = bands.join(told.select("node"), "node", "left_semi").dropDuplicates(["node"]) \
        .select("node", F.explode("bands").alias("band")).distinct()
    members = stored(told.select("root", "node", "grp", "extra").join(of, "node"), "members")
    chunks = lambda n: F.ceil(n / GROUP).cast("int")
    e, m = F.count_if("extra"), F.count_if(~F.col("extra"))
    whole = e + m <= GROUP
    per = members.groupBy("root", "band").agg(
        F.when(whole, F.lit(1)).otherwise(chunks(e)).alias("es"),
        F.when(whole, F.lit(0)).otherwise(chunks(m)).alias("ms"),
        e.alias("e"), F.min("grp").alias("least"), F.max("grp").alias("most"))
    per = per.filter("e > 0 and least <> most").drop("e", "least", "most")
    salt = F.xxhash64("node", "band")
    main = ~F.col("extra") & (F.col("ms") > 0)
    chunk = F.when(main, F.col("es") + F.pmod(salt, F.col("ms"))).otherwise(F.pmod(salt, F.col("es"))).cast("int")
    others = F.sequence(F.lit(0), F.when(main, F.col("es")).otherwise(F.col("es") + F.col("ms")) - 1)
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return members.join(per, ["root", "band"]).withColumn("chunk", chunk).withColumn("other", F.explode(others)) \
        .select("root", F.concat_ws(":", "band", low, high).alias("block"), "node", "grp",
                (F.col("chunk") == low).alias("extra"), (low < high).alias("across"))


def verified_links(nodes: DataFrame, bands: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) that join each group; ``nodes``: (root, node, s),
    ``bands``: (node, bands), a node at least once."""
    many = F.col("blocks") > 1
    per = nodes.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("blocks"))
    placed = nodes.join(per, "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    plain = placed.withColumn("grp", F.col("node")).withColumn("extra", F.lit(True)).withColumn("across", F.lit(False))
    cols = [c.split()[0] for c in SETS.split(", ")]
    large = plain.filter(many)
    # the few documents whose hash is among the lowest of a large component
    chance = F.lit(float(HUBS)) / (F.col("blocks") * GROUP)
    hub = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < chance
    hubs = large.filter(hub).withColumn("own", F.col("block")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("block <> own")
    first = stored(link_blocks(plain.select(*cols).unionByName(hubs.select(*cols)), percent), "links")
    if large.isEmpty():
        return first
    groups = components(first)
    labelled = large.select("root", "node", "blocks", "block").join(
        groups.select(F.col("node").alias("gn"), F.col("root").alias("g")), F.col("node") == F.col("gn"), "left") \
        .select("root", "node", "blocks", "block", F.coalesce("g", "node").alias("grp"))
    labelled = stored(labelled, "labelled")
    sizes = labelled.groupBy("root", "grp").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("root").agg(F.max_by("grp", F.struct("m", "grp")).alias("main"),
                                     (F.sum("m") - F.max("m")).alias("extras"))
    told = labelled.join(main, "root").withColumn("extra", F.col("grp") != F.col("main"))
    few = told.filter(F.col("extras").between(1, GROUP))
    every = few.filter("extra").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # two extras are compared in block 0 only
    placed = few.filter("not extra").unionByName(every).withColumn("across", F.col("block") > 0) \
        .withColumn("block", F.col("block").cast("string")).select(*cols[:-1])
    wide = told.filter(F.col("extras") > GROUP)
    if not wide.isEmpty():
        placed = placed.unionByName(bucket_blocks(wide, bands))
    second = link_blocks(placed.join(nodes.select("node", "s").hint("merge"), "node").select(*cols), percent)
    return first.unionByName(stored(second, "links"))


def groups(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, rid, n_shingles, component_id, kept of every row."""
    return grouped(docs, width, similarity).drop("group")


def grouped(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """``groups`` with the ``group`` of every row, null where the set is empty."""
    percent = round(similarity * 100)
    rows = texts(docs)
    sketch = stored(sketches(rows, width), "sketch")
    per_set = sketch.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min("rid").alias("node"))
    of = stored(sketch.filter("n > 0").select("doc_id", "rid", "k1", "k2", "n")
                .join(per_set, ["k1", "k2", "n"]).select("doc_id", "rid", "node"), "classes")
    node = of.select("rid", "node").distinct()
    edges = candidate_edges(sketch, similarity)
    a, b = (node.select(F.col("rid").alias(c), F.col("node").alias(f"n{c}")) for c in "ab")
    edges = edges.join(a, "a").join(b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    roots = components(edges)

    def to_sets(batches):
        for batch in batches:
            for x in row_blocks(batch):
                yield pa.RecordBatch.from_arrays(
                    [x["root"], x["node"],
                     pa.array([s.tobytes() for s in shingle_sets(x["text"], width)], pa.binary())],
                    ["root", "node", "s"])

    # One document of each node's class brings the set.  Both sides grow with
    # the corpus: never a broadcast, at no size.
    chosen = rows.join(roots.hint("merge"), rows["rid"] == roots["node"]).select("root", "node", "text") \
        .mapInArrow(tidy(to_sets), "root long, node long, s binary")
    bands = sketch.filter("bands is not null").select("rid", "bands").join(node, "rid").select("node", "bands")
    links = verified_links(stored(chosen.dropDuplicates(["node"]), "sets"), bands, percent)
    found = components(links)
    named = of.join(found, "node", "left").withColumn("group", F.coalesce("root", "node"))
    least = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    labels = named.select("doc_id", "rid", "group").distinct().join(least, "group")
    labels = labels.select("doc_id", "rid", "component_id", "group")
    base = sketch.select("doc_id", "rid", F.col("n").cast("long").alias("n_shingles"))
    out = base.join(labels, same_row(base, labels), "left")
    own = F.when(F.col("n_shingles") == 0, base["doc_id"]).otherwise(labels["component_id"])
    return out.select(base["doc_id"], base["rid"], "n_shingles", own.alias("component_id"),
                      base["doc_id"].eqNullSafe(own).alias("kept"), "group")


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group,
    and one of the rows without words that are equal in doc_id and text."""
    kept = grouped(docs, width, similarity).filter("kept") \
        .groupBy("group", "doc_id", "rid").agg(F.count(F.lit(1)).alias("n"))
    alone = F.when(F.col("group").isNull(), F.col("rid")).alias("alone")
    keep = stored(kept.groupBy("group", "doc_id", alone).agg(
        F.min("rid").alias("__rid"), F.max("n").alias("__n")).withColumnRenamed("doc_id", "__doc")
        .select("__doc", "__rid", "__n"), "keep")
    if not keep.filter("__n > 1").isEmpty():
        docs = one_each(docs, docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    rid = F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    kept, of = unused(docs, "kept_id", "kept_rid")
    keep = keep.select(F.col("__doc").alias(kept), F.col("__rid").alias(of))
    return docs.join(keep, (rid == F.col(of)) & docs["doc_id"].cast("long").eqNullSafe(F.col(kept)), "left_semi")

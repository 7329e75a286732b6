"""Byte-level BPE encoding and decoding (operator 8), in two tiers.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect
hash: one displacement per bucket of keys places every vocabulary entry in
its own slot of a table with no empty slot, so a whole block of pre-tokens is
looked up in a few array operations, and the bytes found are compared.  The
others are merged by rank: the bytes form a linked list, a heap holds the
pairs by (rank, place), and stale entries are skipped, so a pre-token of n
bytes costs O(n log n) however long it is.  Each distinct pre-token of a
block is encoded once; a bounded memory of earlier results is kept per worker.

The vocabulary file is read by the driver and sent to the tasks as one
broadcast: its size is fixed by the file (under 1 MB).  No shuffle.

Defined cases: null text is empty; empty text has no ids; long pre-tokens are
encoded whole; an empty table gives no rows; repeated rows get equal results;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import distinct_pieces, piece_hashes
from .textarrays import mix, tidy

#: Characters encoded at once, and results a worker remembers.
BLOCK, MEMORY = 1 << 21, 400_000


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file by id."""
    with open(path, "rb") as f:
        found = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    return [found[i] for i in range(len(found))]


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, by hash and displace."""

    def __init__(self, keys: list[bytes], load: int = 4):
        data = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        h = piece_hashes(data, ends - np.array([len(k) for k in keys]), ends)
        n = len(keys)
        self.n, self.buckets = np.uint64(n), np.uint64(max(1, n // load))
        self.shift = np.zeros(int(self.buckets), np.uint64)
        bucket = (mix(h, 3) % self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(int(self.buckets) + 1))
        slot_of, used = np.zeros(n, np.int64), np.zeros(n, bool)
        for b in np.argsort(cuts[:-1] - cuts[1:], kind="stable"):  # large buckets first
            own = order[cuts[b]:cuts[b + 1]]
            if not len(own):
                break
            base = 0
            while True:  # many displacements are tried at once
                tries = np.arange(base, base + 1024, dtype=np.uint64)
                at = (mix(h[own][:, None] ^ mix(tries)[None, :], 5) % self.n).astype(np.int64)
                ok = ~used[at].any(axis=0)
                if len(own) > 1:
                    s = np.sort(at, axis=0)
                    ok &= (s[1:] != s[:-1]).all(axis=0)
                if ok.any():
                    i = int(np.argmax(ok))
                    self.shift[b], slot_of[own] = tries[i], at[:, i]
                    used[at[:, i]] = True
                    break
                base += 1024
        self.hash, self.key = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        self.hash[slot_of], self.key[slot_of] = h, np.arange(n)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The index of the key with each hash, or -1."""
        d = self.shift[(mix(h, 3) % self.buckets).astype(np.int64)]
        slot = (mix(h ^ mix(d), 5) % self.n).astype(np.int64)
        return np.where(self.hash[slot] == h, self.key[slot], -1)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair of least rank, leftmost first, is merged until
    no neighbouring pair has a rank."""
    n = len(piece)
    get = ranks.get
    end = list(range(1, n + 1))       # where the part that begins here ends; 0: merged away
    prev = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            heap.append(r << 40 | i)
    heapq.heapify(heap)
    pop, push, mask = heapq.heappop, heapq.heappush, (1 << 40) - 1
    while heap:
        x = pop(heap)
        i = x & mask
        j = end[i]
        if j == 0 or j >= n:
            continue
        k = end[j]
        if get(piece[i:k]) != x >> 40:  # stale: one of the two has grown
            continue
        end[i], end[j] = k, 0
        if k < n:
            prev[k] = i
            r = get(piece[i:end[k]])
            if r is not None:
                push(heap, r << 40 | i)
        p = prev[i]
        if p >= 0:
            r = get(piece[p:k])
            if r is not None:
                push(heap, r << 40 | p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: list[bytes]):
        self.vocabulary = vocabulary
        self.ranks = {t: i for i, t in enumerate(vocabulary)}
        self.whole = PerfectHash(vocabulary)
        self.memory: dict[bytes, list[int]] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text in them)."""
        pieces, index, at = distinct_pieces(texts, keep_space=True)
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        size = np.array([len(p) for p in pieces])
        ends = np.cumsum(size)
        found = self.whole.find(piece_hashes(np.frombuffer(b"".join(pieces), np.uint8),
                                             ends - size, ends)).tolist()
        memory, vocabulary, ranks = self.memory, self.vocabulary, self.ranks
        ids, count = [], np.ones(len(pieces), np.int64)
        for k, (p, f) in enumerate(zip(pieces, found, strict=True)):
            if f >= 0 and vocabulary[f] == p:
                ids.append(f)
                continue
            got = memory.get(p)
            if got is None:
                got = merge_bytes(p, ranks)
                if len(memory) >= MEMORY:
                    memory.clear()
                if len(p) <= 64:
                    memory[p] = got
            ids += got
            count[k] = len(got)
        ids = np.array(ids, np.int64)
        first = np.cumsum(count) - count
        each = count[index]
        upto = np.cumsum(each)
        out = ids[np.repeat(first[index] - (upto - each), each) + np.arange(upto[-1])]
        return out, np.append(0, upto)[at]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


_CODECS: dict[str, Codec] = {}


def codec(shared) -> Codec:
    """The worker's codec of a broadcast vocabulary, built once."""
    vocabulary = shared.value
    key = hashlib.blake2b(b"\0".join(vocabulary), digest_size=16).hexdigest() \
        if id(vocabulary) not in _SEEN else _SEEN[id(vocabulary)]
    _SEEN[id(vocabulary)] = key
    if key not in _CODECS:
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


_SEEN: dict[int, str] = {}


def text_blocks(batches, limit: int = BLOCK):
    """(rows' doc_ids, texts) with about ``limit`` characters at most, one row at least."""
    ids, some, held = [], [], 0
    for b in batches:
        for d, t in zip(b.column(0), b.column(1), strict=True):
            t = t.as_py()
            if some and held + len(t) > limit:
                yield ids, some
                ids, some, held = [], [], 0
            ids.append(d.as_py())
            some.append(t)
            held += len(t)
    if some:
        yield ids, some


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        c = codec(shared)
        for d, texts in text_blocks(batches):
            ids, at = c.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))],
                ["doc_id", "ids"])

    return _input(docs).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes binary) of rows (doc_id, ids)."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        c = codec(shared)
        for b in batches:
            at = b["ids"].offsets.to_numpy()
            ids = b["ids"].values.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([c.decode(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)],
                                       pa.binary())], ["doc_id", "bytes"])

    return rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")) \
        .mapInArrow(tidy(run), "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and (``keep_ids``) ids:
    digests of the ids that :meth:`Codec.encode` gives and of the bytes
    :meth:`Codec.decode` makes of them, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        c = codec(shared)
        name = [str(i) for i in range(len(c.vocabulary))].__getitem__
        for d, texts in text_blocks(batches):
            ids, at = c.encode(texts)
            spans = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            listed = [",".join(map(name, ids[a:b].tolist())) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(np.diff(at), pa.int64()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
                 pa.array([hashlib.sha256(c.decode(ids[a:b])).hexdigest() for a, b in spans],
                          pa.string())]
                + [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))] * keep_ids,
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)

    return _input(docs).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<int>" * keep_ids)

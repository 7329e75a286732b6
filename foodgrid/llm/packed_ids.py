"""Token ids in fixed-width bit packing (operator 2).

Ids are stored in the fewest bits that hold the vocabulary.  A block is
``BLOCK`` ids; 32 ids of width w fill w 32-bit words exactly, so a block is
unpacked by 32 vectorised shifts and any id can be found without the others:
block b of a chunk begins at ``offsets[b]``.

The file format is a folder of Parquet files, written and committed by Spark
(a lost executor leaves no half file behind).  A row is a chunk of whole
documents in ascending doc_id order:

    part, chunk   place in the order: chunks of a part are numbered
    first         ids of the part before the chunk
    doc_ids       the chunk's documents
    ends          end of each document, in ids, from the chunk's begin
    bits          width of an id
    offsets       byte offset of each block in ``payload``
    payload       the packed blocks

A document's global start is the sum of the parts before (one row per part)
plus ``first`` plus its place in the chunk.

Defined cases: null text is empty (only the end id is stored); empty tables
give no rows; rows with the same doc_id follow each other in order of their
text; long texts make a chunk of their own; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import scratch_dir
from .byte_bpe import text_blocks
from .pretokens import distinct_pieces
from .textarrays import tidy

BLOCK = 1024            # ids in a block; a multiple of 32
CHUNK = 1 << 17         # ids after which a chunk is closed
CHARACTERS = 1 << 20    # characters encoded at once
WORDS = 2000            # words in one call of the library
MEMORY = 800_000        # words a worker remembers (about 120 MB)
FILE_SCHEMA = ("part int, chunk int, first long, doc_ids array<long>, ends array<long>, "
               "bits int, offsets array<long>, payload binary")


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> tuple[bytes, np.ndarray]:
    """(payload, byte offset of each block)."""
    n = len(ids)
    groups = -(-n // 32)
    lanes = np.zeros((groups, 32), np.uint64)
    lanes.reshape(-1)[:n] = ids
    out = np.zeros((groups, bits + 1), np.uint64)
    for j in range(32):
        word, shift = divmod(j * bits, 32)
        x = lanes[:, j] << np.uint64(shift)
        out[:, word] |= x & np.uint64(0xFFFFFFFF)
        out[:, word + 1] |= x >> np.uint64(32)
    words = out[:, :bits].astype("<u4")
    return words.tobytes(), np.arange(0, max(1, groups), BLOCK // 32, dtype=np.int64) * bits * 4


def unpack(payload: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed groups."""
    words = np.frombuffer(payload, "<u4").reshape(-1, bits)
    groups = -(-n // 32)
    wide = np.zeros((groups, bits + 1), np.uint64)
    wide[:, :bits] = words[:groups]
    out = np.empty((groups, 32), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(32):
        word, shift = divmod(j * bits, 32)
        both = wide[:, word] | (wide[:, word + 1] << np.uint64(32))
        out[:, j] = (both >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def read_ids(payload: bytes, offsets, bits: int, begin: int, end: int) -> np.ndarray:
    """Ids [begin, end) of a chunk; only the blocks that hold them are unpacked."""
    if end <= begin:
        return np.zeros(0, np.uint32)
    b = begin // BLOCK
    skip = begin - b * BLOCK
    return unpack(memoryview(payload)[int(offsets[b]):], bits, skip + end - begin)[skip:]


class WordEncoder:
    """The tokenizers library, asked once for each distinct word of a block.

    A text is normalised as the vocabulary file says (NFC, lower case) and cut
    into the words that the file's pattern would find, and the library encodes
    the words.  Texts that hold a special token's string, or characters whose
    lower case depends on their place, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        names = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[i for t, i in names.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Words met so far: their numbers, and where the ids of each lie in ``flat``."""
        self.memory: dict[bytes, int] = {}
        self.flat, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word): many words in one call, told apart by
        the ids that end one."""
        ids = np.array(self.library.encode(" ".join(w.decode() for w in words),
                                           add_special_tokens=False).ids, np.int32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # a word without an end of its own
            got = self.library.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
            return (np.array([x for g in got for x in g.ids], np.int32),
                    np.array([len(g.ids) for g in got], np.int32))
        return ids, np.diff(ends, prepend=0).astype(np.int32)

    def learn(self, words: list[bytes]) -> None:
        """Encode words that are new and remember them."""
        got = [self.encode_words(words[k:k + WORDS]) for k in range(0, len(words), WORDS)]
        count = np.concatenate([c for _, c in got])
        self.first = np.append(self.first, len(self.flat) + np.cumsum(count, dtype=np.int64) - count)
        self.count = np.append(self.count, count)
        self.flat = np.concatenate([self.flat, *(x for x, _ in got)])
        self.memory.update(zip(words, range(len(self.memory), len(self.first)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        import unicodedata
        plain, own = [], {}
        for i, t in enumerate(texts):
            if any(s in t for s in self.special) or "Σ" in t or "İ" in t:
                own[i] = np.array(self.whole(t), np.int64)
                plain.append("")
            else:
                plain.append((t if t.isascii() else unicodedata.normalize("NFC", t)).lower())
        pieces, index, at = distinct_pieces(plain, keep_space=False)
        if not pieces:
            return [own.get(i, np.zeros(0, np.int64)) for i in range(len(texts))]
        if len(self.memory) > MEMORY:
            self.forget()
        new = [p for p in pieces if p not in self.memory]
        if new:
            self.learn(new)
        word = np.fromiter(map(self.memory.__getitem__, pieces), np.int64, len(pieces))[index]
        each = self.count[word]
        upto = np.cumsum(each, dtype=np.int64)
        out = self.flat[np.repeat(self.first[word] - (upto - each), each) + np.arange(upto[-1])]
        ends = np.append(0, upto)[at]
        return [own[i] if i in own else out[ends[i]:ends[i + 1]] for i in range(len(texts))]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_packed(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int) -> None:
    """Encode ``docs`` and write them in the packed format below ``folder``.

    ``tokenizer`` is a path that every executor has (the library's file).
    The texts are shuffled once, by range of doc_id.
    """
    bits = width_of(vocabulary)

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        chunk = first = held = 0
        ids, docs_, ends = [], [], []

        def close():
            flat = np.concatenate(ids)
            payload, offsets = pack(flat, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()),
                 pa.array([first], pa.int64()), pa.array([docs_], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([bits], pa.int32()),
                 pa.array([offsets], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                [c.split()[0] for c in FILE_SCHEMA.split(", ")])

        for d, texts in text_blocks(batches, CHARACTERS):
            for doc_id, got in zip(d, enc.encode(texts), strict=True):
                ids.append(np.append(got, end_id))
                held += len(got) + 1
                docs_.append(doc_id)
                ends.append(held)
                if held >= CHUNK:
                    yield close()
                    chunk, first, held = chunk + 1, first + held, 0
                    ids, docs_, ends = [], [], []
        if ids:
            yield close()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
         .mapInArrow(tidy(run), FILE_SCHEMA).write.option("compression", "none").parquet(folder))


def part_starts(files: DataFrame) -> DataFrame:
    """(part, part_start): ids of all parts before; one row per part."""
    parts = files.groupBy("part").agg(F.max(F.col("first") + F.element_at("ends", -1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def read_packed(spark, folder: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every stored document."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                flat = unpack(r["payload"], r["bits"], r["ends"][-1])
                at = np.array([0, *r["ends"]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(r["ends"]), pa.int32()),
                     pa.array(r["doc_ids"], pa.int64()), pa.array(at[:-1] + r["first"], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                              pa.array(flat.astype(np.int32), pa.int32()))],
                    ["part", "doc_id", "at", "ids"])

    rows = files.mapInArrow(tidy(run), "part int, doc_id long, at long, ids array<int>")
    return rows.join(F.broadcast(part_starts(files)), "part") \
        .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "ids")


def read_digests(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from the files: unpacked and
    digested in one pass, so that ids need not travel."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                begin = [0, *r["ends"][:-1]]
                flat = unpack(r["payload"], r["bits"], r["ends"][-1]).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(begin), pa.int32()),
                     pa.array(r["doc_ids"], pa.int64()),
                     pa.array([r["first"] + x for x in begin], pa.int64()),
                     pa.array([y - x for x, y in zip(begin, r["ends"], strict=True)], pa.int64()),
                     pa.array([zlib.crc32(flat[x:y].tobytes()) for x, y in
                               zip(begin, r["ends"], strict=True)], pa.int64())],
                    ["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(tidy(run), "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(part_starts(files)), "part") \
        .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def find_ids(spark, folder: str, start: int, end: int) -> np.ndarray:
    """Ids [start, end) of the whole stream: only the chunks that hold them
    are read, and of those only the blocks."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    at = F.col("part_start") + F.col("first")
    size = F.element_at("ends", -1)
    found = files.join(F.broadcast(part_starts(files)), "part").withColumn("at", at) \
        .filter((F.col("at") < end) & (F.col("at") + size > start)).orderBy("at").collect()
    return np.concatenate([np.zeros(0, np.uint32)] + [
        read_ids(r["payload"], r["offsets"], r["bits"], max(0, start - r["at"]),
                 min(end - r["at"], r["ends"][-1])) for r in found])


def encode_to_files(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> str:
    """Write into a fresh shared folder; returns it."""
    folder = f"{scratch_dir(docs.sparkSession)}/packed_ids"
    write_packed(docs, folder, tokenizer, vocabulary, end_id)
    return folder

"""Toxicity from a weighted lexicon (operator 4).

Texts are folded (lower case, accents dropped, homoglyphs and digit
substitutions replaced by the letter they stand for, everything else a
space) and matched against the whole lexicon at once by an Aho-Corasick
automaton.  An entry is a word or the beginning of words, with a weight.  A
hit inside an exception phrase (the word, or the word with a neighbour) does
not count.  A document's evidence is the sum of the weights of the words
hit, as it stands and per 100 words; a logistic curve makes it a score.

The lexicon, the exceptions and the curve are learned from labelled rows: at
most ``TRAIN_ROWS`` of them, drawn by a hash of doc_id.  An entry needs
``MIN_CONTEXTS`` different preceding words in toxic rows, so that copies of
one text do not count as evidence.  The model is a few thousand short
strings at most (``MAX_ENTRIES``) and is broadcast; scoring is one pass over
whole texts with no shuffle.

Defined cases: null text is empty; an empty text scores as a text without
hits; without toxic labels every score is 0; rows with the same doc_id are
scored separately; a null doc_id is not held out and never trained on;
labels of a null doc_id or null label are ignored; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import text_blocks
from .textarrays import tidy

TRAIN_ROWS = 20_000     # labelled rows used at most
MAX_ENTRIES = 5_000     # lexicon entries and exceptions kept at most, each
MIN_CONTEXTS = 8
MIN_WEIGHT = 2.0        # natural log of the odds against clean rows
PREFIXES = (4, 5, 6)    # lengths of word beginnings tried as entries
THRESHOLD = 0.7
BLOCK = 1 << 20

# FIXED VALUES: look-alikes of Latin letters and digits used for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "д": "d", "е": "e", "з": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d",
    "ӏ": "l", "ԛ": "q", "ԝ": "w", "ь": "b", "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ѵ": "v", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
          "@": "a", "$": "s"}


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """For each code point the folded one: a letter, or a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c).lower()[:1]
        ch = HOMOGLYPHS.get(ch) or DIGITS.get(ch) or ch
        if ord(ch) > 127:
            base = unicodedata.normalize("NFKD", ch)[:1].lower()
            ch = HOMOGLYPHS.get(base, base) or ch
        if ch.isalpha():
            out[c] = ord(ch)
    for c in range(0x300, 0x370):  # combining marks vanish into a letter-free mark, see fold()
        out[c] = 0
    return out


def fold(text: str) -> str:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    got = folding()[codes]
    got = got[got != 0]
    return " " + got.tobytes().decode("utf-32-le", "replace") + " "


def entries(words: list[str]) -> set[str]:
    """What a folded text's words offer as entries: `` word `` and `` begin``."""
    out = set()
    for w in set(words):
        if 3 <= len(w) <= 40:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in PREFIXES if len(w) > n)
    return out


def word_before(folded: str, at: int) -> str:
    """The word that ends before the space at ``at`` (none: empty); by places, the text is not copied."""
    while at > 0 and folded[at - 1] == " ":
        at -= 1
    return folded[folded.rfind(" ", 0, at) + 1:at] if at else ""


def word_after(folded: str, at: int) -> str:
    """The word that begins after the space at ``at`` (none: empty)."""
    while at < len(folded) and folded[at] == " ":
        at += 1
    stop = folded.find(" ", at)
    return folded[at:stop] if stop >= 0 else folded[at:]


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset = frozenset()
    curve: tuple = (0.0, 0.0, 0.0)
    empty: bool = True
    _machine: object = None

    def machine(self):
        if self._machine is None:
            import ahocorasick
            self._machine = ahocorasick.Automaton()
            for e, w in self.lexicon.items():
                self._machine.add_word(e, (len(e), w))
            self._machine.make_automaton()
        return self._machine

    def hits(self, folded: str):
        """(weight, phrases) of each word hit: the word, and it with a neighbour."""
        best: dict[int, float] = {}
        if self.lexicon:
            for end, (n, w) in self.machine().iter(folded):
                at = end - n + 1
                if w > best.get(at, -1.0):
                    best[at] = w
        for at, w in sorted(best.items()):
            stop = folded.find(" ", at + 1)
            word = folded[at + 1:stop]
            yield w, (word, f"{word_before(folded, at)} {word}", f"{word} {word_after(folded, stop)}")

    def evidence(self, text: str) -> tuple[float, float, int]:
        """(weight, weight per 100 words as a logarithm, hits)."""
        folded = fold(text)
        total, n = 0.0, 0
        for w, phrases in self.hits(folded):
            if not self.exceptions.intersection(phrases):
                total, n = total + w, n + 1
        if not n:
            return 0.0, 0.0, 0
        return math.log1p(total), math.log1p(total / max(1.0, len(folded.split()) / 100)), n

    def score(self, x: tuple[float, float, int]) -> float:
        if self.empty:
            return 0.0
        z = self.curve[0] + self.curve[1] * x[0] + self.curve[2] * x[1]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, toxic): at most about ``rows`` labelled rows that are not
    held out, one for each labelled doc_id (of several texts the one of least hash)."""
    lab = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic")) \
        .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id"))) \
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = lab.count()
    if n > rows:
        lab = lab.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 40)) < int(rows * 0.98 / n * (1 << 40)))
    # bounded by ``rows`` whatever the input, hence broadcast
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")) \
        .join(F.broadcast(lab), F.col("doc_id") == F.col("id")) \
        .withColumn("text", F.coalesce("text", F.lit(""))).groupBy("doc_id") \
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    from .base import stored
    spark = docs.sparkSession
    train = stored(training_rows(docs, labels, rows), "train")
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1, 0), sum(counts.values()) - counts.get(1, 0)
    if not toxic or not clean:
        return Model()

    def contexts(batches):
        for _, some in text_blocks(batches, BLOCK // 4):
            out = set()
            for t in some:
                w = fold(t).split()
                for a, b in zip(["", *w[:-1]], w, strict=True):
                    out.update((e, hash_of(a)) for e in entries([b]))
            yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in out], pa.string()),
                                              pa.array([h for _, h in out], pa.int64())], ["e", "h"])

    seen = train.filter("toxic = 1").select("doc_id", "text").mapInArrow(tidy(contexts), "e string, h long") \
        .distinct().groupBy("e").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_CONTEXTS)
    # the entries of most contexts; a bounded number
    tried = {r["e"] for r in seen.orderBy(F.desc("n"), "e").limit(20 * MAX_ENTRIES).collect()}
    shared = spark.sparkContext.broadcast(tried)

    def presence(batches):
        for b in batches:
            n = defaultdict(Counter)
            for t, y in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                n[y].update(entries(fold(t).split()) & shared.value)
            for y, c in n.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([y] * len(c), pa.int32()),
                     pa.array(list(c.values()), pa.int64())], ["e", "toxic", "n"])

    table = train.mapInArrow(tidy(presence), "e string, toxic int, n long").groupBy("e").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("b")).collect()
    odds = lambda a, b: math.log((a + 0.5) / (toxic + 1) / ((b + 0.5) / (clean + 1)))
    ranked = sorted(((odds(r["a"], r["b"]), r["a"], r["e"]) for r in table), reverse=True)
    chosen: dict[str, float] = {}
    for w, _, e in sorted(ranked, key=lambda x: (-round(x[0], 1), -x[1], x[2])):
        if w >= MIN_WEIGHT and len(chosen) < MAX_ENTRIES:
            chosen[e] = w
    model = Model(lexicon=chosen, empty=False)
    shared_model = spark.sparkContext.broadcast(model)

    def phrases(batches):
        for b in batches:
            c = Counter()
            for t, y in zip(b["text"].to_pylist(), b["toxic"].to_pylist(), strict=True):
                c.update({(p, y) for _, ps in shared_model.value.hits(fold(t)) for p in ps})
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in c], pa.string()), pa.array([y for _, y in c], pa.int32()),
                 pa.array(list(c.values()), pa.int64())], ["p", "toxic", "n"])

    n = lambda y: F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0))
    benign = train.mapInArrow(tidy(phrases), "p string, toxic int, n long").groupBy("p") \
        .agg(n(1).alias("a"), n(0).alias("b")).filter("b >= 3") \
        .filter((F.col("a") + 0.5) * (clean + 1) < (F.col("b") + 0.5) * (toxic + 1)) \
        .orderBy(F.desc("b"), "p").limit(MAX_ENTRIES).collect()
    model = Model(lexicon=chosen, exceptions=frozenset(r["p"] for r in benign), empty=False)
    shared_model = spark.sparkContext.broadcast(model)

    def observed(batches):
        for b in batches:
            x = [shared_model.value.evidence(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()),
                 b["toxic"]], ["x", "z", "y"])

    # one small row per training row, at most ``rows`` of them
    points = train.mapInArrow(tidy(observed), "x double, z double, y int").toPandas() \
        .sort_values(["x", "z", "y"])  # the same sums in every run
    return Model(chosen, model.exceptions,
                 fit_curve(points[["x", "z"]].to_numpy(), points["y"].to_numpy()), False)


def hash_of(word: str) -> int:
    import zlib
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple:
    """Logistic regression with an intercept, by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, hits per row; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for d, some in text_blocks(batches, BLOCK):
            x = [m.evidence(t) for t in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array([m.score(v) for v in x], pa.float64()),
                 pa.array([v[2] for v in x], pa.int32())], ["doc_id", "score", "hits"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, score double, hits int").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns.  Each text is
    scored where it lies; no join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(text: pd.Series) -> pd.Series:
        m = shared.value
        return text.fillna("").map(lambda t: m.score(m.evidence(t))).astype("float64")

    return docs.filter(of(docs["text"]) < threshold)

"""Source divergence audit (operator 13).

How far do the sources of a language use its words differently?  Terms are
runs of letters and of code points above 127, A-Z lower-cased.  A language
keeps the terms in at least ``MIN_DOCS`` of its documents: one CountVectorizer
serves all languages, over tokens that carry their language in front, so its
document frequencies are each language's own.  Its sparse vectors hold the
exact counts of every document; they are summed by (lang, source) and by lang
without ever being made dense, combined map-side, so a hot source costs a row
per term and task.

Per group, p = 1 + floor(SCALE * (count + 5) / (N + 5 * V)) for each kept term,
in whole numbers.  Pairs of sources are compared sparsely: per pair the terms
that neither has add V * |p0 - q0|, and blocks of at most ``BLOCK`` by ``BLOCK``
sources and ``TERMS`` terms correct that for the terms that one of them has.

What a vocabulary needs of the documents is prepared in arrays: each task
lists its tokens as often as documents have them, up to ``MIN_DOCS``
(:func:`supports`), which leaves every minDF decision as it is.
Vocabularies are fitted in slices of the tokens by hash, of about
``SLICE_TERMS`` kept terms at most, since a fitted vocabulary passes the driver
and is broadcast.  How many slices that takes is told by one in ``SAMPLED`` of the
terms, followed through all documents; the slices change no result.

Defined cases: null text, lang and source are empty texts; a group without
kept terms takes part with p of count 0 everywhere; a language without kept terms
gives its pairs with value 0 and no term rows; a single source gives no pairs;
repeated rows are documents of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import scratch_dir, stored
from .textarrays import BYTE_CODE, blocks, mix, tidy, utf8

MIN_DOCS, TOP = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
ALL_TERMS = 2**31 - 1          # vocabSize: no term is cut
SLICE_TERMS, SAMPLED = 1_000_000, 1024
LIMIT = 4 << 20                # bytes of text cut into terms at once
HELD = 1 << 20                 # tokens or sums held in a task
ROW = 1 << 15                  # tokens in a row for the vocabulary
BLOCK, TERMS = 64, 512
CHUNK = 64                     # terms compared at once in a block
#: Between language and term: no term has it, so the last one splits a token.
SEP = "\u0000"
PARTIALS = "lang string, sid long, other long, value long"


TERM_BYTE = np.zeros(256, bool)   # letters, and all bytes of code points above 127
TERM_BYTE[65:91] = TERM_BYTE[97:123] = TERM_BYTE[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Closes every text of a batch, so that no term crosses texts.
END = "\n"


def tokens_of(data: np.ndarray, bounds: np.ndarray, prefixes: list[bytes],
              sample: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The tokens of each text (closed by ``END``), as lists, and which of all
    tokens belong to the sampled terms.  ``prefixes``: what stands before each text's terms."""
    solid = TERM_BYTE[data]
    turns = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(solid) and solid[0]:
        turns = np.concatenate([[0], turns])
    starts, sizes = turns[::2], turns[1::2] - turns[::2]
    kept = LOWER[data[solid]]
    at = np.concatenate([[0], np.cumsum(sizes)])   # of terms in kept
    rows = np.searchsorted(starts, bounds)
    which: dict[bytes, int] = {}
    kind = np.repeat([which.setdefault(p, len(which)) for p in prefixes], np.diff(rows)).astype(np.int64)
    ahead = np.array([len(p) for p in which], np.int64)[kind] if len(kind) else kind
    offsets = at + np.concatenate([[0], np.cumsum(ahead)])
    out = np.empty(offsets[-1], np.uint8)
    for i, j in blocks(at, LIMIT):
        step = np.ones(at[j] - at[i], np.int64)     # a term's first byte also steps over its prefix
        step[at[i:j] - at[i]] += ahead[i:j]
        step[:1] += offsets[i] - 1
        out[np.cumsum(step)] = kept[at[i]:at[j]]
    for prefix, k in which.items():
        begin = offsets[:-1][kind == k] if len(which) > 1 else offsets[:-1]
        for i, byte in enumerate(prefix):
            out[begin + i] = byte
    # cheap and the same for equal terms; any one of them may decide, since it only counts slices
    sampled = np.zeros(len(starts), bool)
    if sample and len(starts):
        ends = BYTE_CODE[kept[at[:-1]]] + BYTE_CODE[kept[at[1:] - 1]] * BYTE_CODE[kept[at[:-1] + sizes // 2]]
        sampled = mix(ends + sizes.astype(np.uint64)) % np.uint64(SAMPLED) == 0
    tokens = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), tokens), sampled


def token_batches(batches, sample: bool = False):
    """(batch, tokens, sampled) of bounded pieces of (text, lang, ...) batches."""
    for b in batches:
        data, bounds = utf8(b["text"])
        prefixes = [(x + SEP).encode() for x in b["lang"].to_pylist()]
        for i, j in blocks(bounds, LIMIT):
            yield b.slice(i, j - i), *tokens_of(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i],
                                                prefixes[i:j], sample)


def _input(docs: DataFrame) -> DataFrame:
    text, lang, source = (F.coalesce(docs[c].cast("string"), F.lit("")) for c in ("text", "lang", "source"))
    return docs.select(F.concat(text, F.lit(END)).alias("text"), lang.alias("lang"), source.alias("source"))


def term_rows(docs: DataFrame) -> DataFrame:
    """(lang, source, tokens) of every row; a token is its language, ``SEP`` and the term."""

    def run(batches):
        for b, tokens, _ in token_batches(batches):
            yield pa.RecordBatch.from_arrays([b["lang"], b["source"], tokens], ["lang", "source", "tokens"])

    return _input(docs).mapInArrow(tidy(run), "lang string, source string, tokens array<string>")


def supports(docs: DataFrame, min_docs: int) -> DataFrame:
    """(tokens, some): rows for the vocabulary alone.  A task counts in how many
    of its documents each token is, and puts the token into as many rows, but
    not over ``min_docs``: a token is in ``min_docs`` documents exactly if it is
    in ``min_docs`` of these rows.  ``some`` are a row's tokens of sampled terms."""

    def run(batches):
        held, size = [], 0

        def out():
            t = pa.concat_tables(held).group_by("t").aggregate([("n", "sum"), ("some", "max")])
            n, some = t["n_sum"].to_numpy(), t["some_max"].to_numpy(zero_copy_only=False)
            terms = t["t"].combine_chunks()
            for k in range(1, min_docs + 1):
                at = np.flatnonzero(n >= k)
                for x in range(0, len(at), ROW):
                    part = at[x:x + ROW]
                    rows = [terms.take(pa.array(p)) for p in (part, part[some[part]])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(r)], pa.int32()), r) for r in rows], ["tokens", "some"])

        for _, tokens, sampled in token_batches(batches, sample=True):
            coded = tokens.flatten().dictionary_encode()
            code, terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
            if not len(terms):
                continue
            row = np.repeat(np.arange(len(tokens)), np.diff(tokens.offsets.to_numpy()))
            own = pd.unique(row * len(terms) + code) % len(terms)
            flag = np.zeros(len(terms), bool)
            flag[code[sampled]] = True
            held.append(pa.table({"t": terms, "n": np.bincount(own, minlength=len(terms)), "some": flag}))
            size += len(terms)
            if size > HELD:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return _input(docs).mapInArrow(tidy(run), "tokens array<string>, some array<string>")


def fit(rows: DataFrame, min_docs: int) -> tuple[CountVectorizerModel, DataFrame]:
    """The model of the tokens in at least ``min_docs`` rows, and its vocabulary (idx, lang, term).

    ``min_docs`` rows of a token of its own keep an empty vocabulary from
    failing; no text has it (a token has ``SEP`` in it), and it is left out again.
    """
    spark = rows.sparkSession
    own = spark.range(min_docs).select(F.array(F.lit("own")).alias("tokens"))
    model = CountVectorizer(inputCol="tokens", outputCol="vector", minDF=float(min_docs), vocabSize=ALL_TERMS) \
        .fit(rows.select("tokens").unionByName(own))
    path = f"{scratch_dir(spark)}/vocabulary"
    model.write().save(path)    # the vocabulary as a table, without a list in Python
    words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("idx", "token")) \
        .filter(F.instr("token", SEP) > 0)
    term = F.substring_index("token", SEP, -1)
    lang = F.expr("left(token, length(token) - length(substring_index(token, '\\u0000', -1)) - 1)")
    return model, words.select(F.col("idx").cast("long").alias("idx"), lang.alias("lang"), term.alias("term"))


def summed(batches):
    """Sums (lang, source, idx, count) of sparse vectors (lang, source, idx
    array, n array), combined over a task's batches while they are few."""
    group: dict[tuple, int] = {}
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        lang, source = (pa.array([g[i] for g in group], pa.string()) for i in (0, 1))
        order = np.argsort(keys)    # neighbours alike: smaller shuffle files
        of, idx, n = keys[order] >> 32, keys[order] & 0xFFFFFFFF, counts[order]
        for x in range(0, len(keys), 1 << 17):
            part = slice(x, x + (1 << 17))
            who = pa.array(of[part])
            yield pa.RecordBatch.from_arrays(
                [lang.take(who), source.take(who), pa.array(idx[part]), pa.array(n[part])],
                ["lang", "source", "idx", "count"])

    for b in batches:
        of = np.array([group.setdefault(x, len(group)) for x in
                       zip(b["lang"].to_pylist(), b["source"].to_pylist(), strict=True)], np.int64)
        size = np.diff(b["idx"].offsets.to_numpy())
        idx = b["idx"].flatten().to_numpy().astype(np.int64)
        new = (np.repeat(of, size) << 32) | idx
        n = b["n"].flatten().to_numpy().astype(np.int64)
        at, keys = pd.factorize(np.concatenate([keys, new]))
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, np.concatenate([counts, n]))
        counts = sums
        if len(keys) > HELD:
            yield from out()
            group.clear()
            keys, counts = keys[:0], counts[:0]
    yield from out()


def slice_counts(rows: DataFrame, model: CountVectorizerModel) -> DataFrame:
    """(lang, source, idx, count): the summed vectors of the documents."""
    vector = F.unwrap_udt("vector")
    return model.transform(rows) \
        .select("lang", "source", vector["indices"].alias("idx"), vector["values"].alias("n")) \
        .mapInArrow(tidy(summed), "lang string, source string, idx long, count long") \
        .groupBy("lang", "source", "idx").agg(F.sum("count").alias("count"))


def counted(docs: DataFrame, min_docs: int = MIN_DOCS, slices: int | None = None) -> tuple[DataFrame, ...]:
    """(counts, vocabulary, groups): counts (lang, source, idx, count), (idx, lang, term) and the
    occurring (lang, source)."""
    seen = stored(supports(docs, min_docs), "supports")
    if slices is None:
        some = seen.select(F.explode("some").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
        slices = 1 + some.filter(F.col("n") >= min_docs).count() * SAMPLED // SLICE_TERMS
    rows = term_rows(docs)
    counts = words = None
    for i in range(slices):
        own = F.expr("tokens" if slices == 1 else f"filter(tokens, t -> pmod(xxhash64(t), {slices}) = {i})")
        model, w = fit(seen.withColumn("tokens", own), min_docs)
        c = slice_counts(rows.withColumn("tokens", own), model)
        number = F.col("idx") * slices + i      # none twice
        c, w = (stored(x.withColumn("idx", number), "slice") for x in (c, w))
        counts, words = (c, w) if counts is None else (counts.unionByName(c), words.unionByName(w))
    return counts, words, _input(docs).select("lang", "source").distinct()


def _share(count: str, n: str = "n", v: str = "v") -> Column:
    """p of a term with ``count``; in decimals where whole numbers of 64 bits would not hold it."""
    wide = f"cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + {SMOOTH})"
    all_ = f"(cast({n} as decimal(20,0)) + cast({SMOOTH} as decimal(1,0)) * cast({v} as decimal(19,0)))"
    most = 2**62 // SCALE
    return F.expr(f"case when {v} = 0 then 0 "
                  f"when {count} < {most} and {n} < {2**61} and {v} < {2**58} "
                  f"then 1 + ({SCALE}L * ({count} + {SMOOTH})) div ({n} + {SMOOTH}L * {v}) "
                  f"else 1 + ({wide}) div {all_} end").cast("long")


def compare_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Over the terms of one slice, per ordered pair of sources of two blocks:
    the sum of |p - q| - |p0 - q0| where one of them has the term, and in the
    first slice V * |p0 - q0|.  Rows: (sid, block, idx, p); idx -1 has p0 and V."""
    lang, one, two, first = key[0], key[1], key[2], key[3] == 0
    roster = rows[rows["idx"] < 0].sort_values("sid")
    sid, p0 = roster["sid"].to_numpy(np.int64), roster["p"].to_numpy(np.int64)
    side = roster["block"].to_numpy(np.int64)
    v = int(roster["v"].iloc[0]) if len(roster) else 0
    a, b = np.flatnonzero(side == one), np.flatnonzero(side == two)
    base = np.abs(p0[a][:, None] - p0[b][None, :])
    total = base * v if first else np.zeros_like(base)
    seen = rows[rows["idx"] >= 0]
    idx, at = np.unique(seen["idx"].to_numpy(np.int64), return_inverse=True)
    who, p = np.searchsorted(sid, seen["sid"].to_numpy(np.int64)), seen["p"].to_numpy(np.int64)
    order = np.argsort(at, kind="stable")
    at, who, p = at[order], who[order], p[order]
    for x in range(0, len(idx), CHUNK):
        y = min(len(idx), x + CHUNK)
        i, j = np.searchsorted(at, (x, y))
        m = np.repeat(p0[None, :], y - x, axis=0)
        m[at[i:j] - x, who[i:j]] = p[i:j]
        total += np.abs(m[:, a][:, :, None] - m[:, b][:, None, :]).sum(axis=0) - (y - x) * base
    s, t = np.repeat(sid[a], len(b)), np.tile(sid[b], len(a))
    value = total.reshape(-1)
    if one != two:  # both directions
        s, t, value = np.concatenate([s, t]), np.concatenate([t, s]), np.concatenate([value, value])
    keep = s != t
    return pd.DataFrame({"lang": lang, "sid": s[keep], "other": t[keep], "value": value[keep]})


def pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, sid, other, value) of every ordered pair of a language's sources.

    ``groups``: (lang, sid, blocks, p0, v); ``shares``: (lang, sid, idx, p)."""
    block = F.expr(f"sid div {BLOCK}").alias("block")
    part = lambda idx: F.expr(f"case when {idx} < 0 then 0 else {idx} div {TERMS} end")
    slices = shares.select("lang", part("idx").alias("part")).unionByName(
        groups.select("lang", F.lit(0).cast("long").alias("part"))).distinct()
    roster = groups.join(slices, "lang").select("lang", "sid", block, "blocks", F.lit(-1).cast("long").alias("idx"),
                                                F.col("p0").alias("p"), "v", "part")
    own = shares.join(groups.select("lang", "sid", "blocks"), ["lang", "sid"]).select(
        "lang", "sid", block, "blocks", "idx", "p", F.lit(0).cast("long").alias("v"), part("idx").alias("part"))
    met = roster.unionByName(own).withColumn("met", F.explode(F.expr("sequence(0L, blocks - 1)"))) \
        .withColumns({"one": F.least("block", "met"), "two": F.greatest("block", "met")})
    sums = met.groupBy("lang", "one", "two", "part").applyInPandas(compare_blocks, PARTIALS)
    return sums.groupBy("lang", "sid", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, slices: int | None = None) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    counts, words, groups = counted(docs, min_docs, slices)
    kept = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    numbers = Window.partitionBy("lang").orderBy("source")   # sources, not documents
    groups = groups.join(sums, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["n", "v"]) \
        .withColumn("sid", F.row_number().over(numbers) - F.lit(1).cast("long")) \
        .withColumn("blocks", F.expr(f"1 + (count(*) over (partition by lang) - 1) div {BLOCK}")) \
        .withColumn("p0", _share("0"))
    groups = stored(groups.select("lang", "source", "sid", "blocks", "n", "v", "p0"), "groups")
    totals = groups.groupBy("lang").agg(F.sum("n").alias("all_n"))
    whole = counts.groupBy("lang", "idx").agg(F.sum("count").alias("all_count")).join(totals, "lang")
    shares = counts.join(groups.select("lang", "source", "sid", "n", "v"), ["lang", "source"]) \
        .join(whole, ["lang", "idx"]) \
        .select("lang", "source", "sid", "idx", _share("count").alias("p"), _share("all_count", "all_n").alias("q"))
    shares = stored(shares, "shares")

    names = groups.select("lang", "source", "sid")
    pairs = pair_values(groups, shares.select("lang", "sid", "idx", "p")) \
        .join(names, ["lang", "sid"]) \
        .join(names.select("lang", F.col("source").alias("item"), F.col("sid").alias("other")), ["lang", "other"]) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.filter("p > q").join(words.select("idx", "term"), "idx") \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                (F.col("p") - F.col("q")).alias("value"))
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", F.row_number().over(ranks)).select(*columns).unionByName(
        terms.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top).select(*columns))

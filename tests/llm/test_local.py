"""Operators 1, 2, 4, 5, 7, 8 and 9 against brute force on whole small tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from foodgrid.llm import (byte_bpe, exact_dedup, mixing, packed_ids, queries, sharding, syncmers,
                          textarrays, toxicity)

from .conftest import ODD, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- arrays ---------------------------------------------------------------------

def test_gram_hash_and_window_min():
    x = np.random.default_rng(1).integers(0, 4, 200).astype(np.uint64)
    for k in (1, 2, 3, 7, 24, 100):
        want = [sum(int(x[i + j]) * pow(int(textarrays.BASE), k - 1 - j, 2**64) for j in range(k))
                % 2**64 for i in range(len(x) - k + 1)]
        assert textarrays.gram_hash(x, k).tolist() == want
        assert textarrays.window_min(x, k).tolist() == [min(x[i:i + k]) for i in range(len(x) - k + 1)]


def test_words_of_a_block():
    import pyarrow as pa
    t = ["a bb\x0bccc  a", "", "a", "  ", "bb ccc", "x\xa0y é"]
    data, bounds = textarrays.utf8(pa.array(t))
    s, e, h, wb = textarrays.words(data, bounds)
    got = [[bytes(data[s[k]:e[k]]).decode() for k in range(wb[i], wb[i + 1])] for i in range(len(t))]
    assert got == [WORDS.findall(x) for x in t]
    assert h[0] == h[3] == h[4] and h[1] == h[5] and h[0] != h[1]


# --- 1 --------------------------------------------------------------------------

def brute_anchors(t, k, s):
    """Closed syncmers by their definition, one k-mer at a time."""
    c = np.array([ord(x) for x in t], np.uint64)
    inner = textarrays.mix(textarrays.gram_hash(c, s), 1)
    whole = textarrays.mix(textarrays.gram_hash(c, k), 2)
    out = {}
    for i in range(len(t) - k + 1):
        w = inner[i:i + k - s + 1]
        if w.min() in (w[0], w[-1]):
            out.setdefault(int(whole[i] >> np.uint64(32)), i)
    return out


def test_sketch_is_the_smallest_syncmers_in_text_order():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd é漢") for _ in range(n)) for n in (16, 17, 60, 900, 3000)]
    for m in (8, 64):
        for t, got in zip(texts, syncmers.sketch(texts, 16, 6, m), strict=True):
            every = brute_anchors(t, 16, 6) or brute_anchors(t, 16, 16)  # without any: all k-mers
            low = sum(h < syncmers.ALWAYS for h in every)
            want = sorted(sorted(every)[:max(m, low)], key=every.get)
            assert got.tolist() == want


def test_short_texts_without_syncmers_differ():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in range(16, 25) for _ in range(40)]
    assert sum(not brute_anchors(t, 16, 6) for t in texts) > 50
    got = syncmers.sketch(texts)
    assert len({syncmers.to_text(a) for a in got} | {""}) == len(texts) + 1
    none = [a for t, a in zip(texts, got, strict=True) if not brute_anchors(t, 16, 6)]
    assert max(syncmers.likeness_of(a, b) for i, a in enumerate(none) for b in none[:i]) < 1
    one = next(t for t in texts if len(t) == 20 and not brute_anchors(t, 16, 6))
    assert all(len(a) for a in syncmers.sketch([one, one[:18], one[1:]]))


def test_long_texts_show_a_shared_passage():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    for _ in range(5):
        passage = [word() for _ in range(80)]
        texts = []
        for n in (20_000, 20_000):
            ws = [word() for _ in range(n)]
            at = rng.randrange(n)
            texts.append(" ".join(ws[:at] + passage + ws[at:]))
        other = " ".join(word() for _ in range(20_000))
        a, b, c = syncmers.sketch([*texts, other])
        assert len(a) > 600
        assert len(np.intersect1d(a, b)) >= 2 and syncmers.likeness_of(a, b) > 0
        assert syncmers.likeness_of(a, c) < syncmers.likeness_of(a, b)


def test_likeness_counts_the_complete_part():
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 2000, 30_000)]
    texts = base + [t[:len(t) // 2] for t in base] + [base[2][:20_000] + base[1]]
    for a, x in zip(texts, syncmers.sketch(texts), strict=True):
        for b, y in zip(texts, syncmers.sketch(texts), strict=True):
            one, two = brute_anchors(a, 16, 6), brute_anchors(b, 16, 6)
            both = sorted(set(one) | set(two))
            part = both[:max(64, sum(h < syncmers.ALWAYS for h in both))]
            common = sum(h in one and h in two for h in part) / len(part)
            assert syncmers.likeness_of(x, y) <= common + 1e-9
            if b.startswith(a) or a.startswith(b):
                assert syncmers.likeness_of(x, y) == pytest.approx(common)


def test_op1_matches_definition(spark, rows):
    got = by_id(queries.op1_syncmer_fingerprints(spark, SF))
    ids = [r[0] for r in rows]
    for i, (d, t, _) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        g = got[d]
        assert (g["n_chars"], g["edited_sha256"]) == (len(t), sha(edited))
        a, b, c = syncmers.sketch([t, edited, nxt])
        assert (g["fingerprint"], g["edited_fingerprint"]) == (syncmers.to_text(a), syncmers.to_text(b))
        assert g["near_edited"] == syncmers.likeness(g["fingerprint"], g["edited_fingerprint"])
        assert g["near_next"] == syncmers.likeness(g["fingerprint"], got[ids[(i + 1) % len(ids)]]["fingerprint"])
    long = [g for g in got.values() if g["n_chars"] > 500]
    assert np.mean([g["near_edited"] > g["near_next"] for g in long]) > 0.95


def test_likeness_needs_the_same_order():
    a, b = "the first passage of some length stands here. ", "and a second one follows after it, also long. "
    x, y, z = syncmers.sketch([a + b, b + a, a + b])
    assert syncmers.likeness_of(x, z) == 1
    assert syncmers.likeness_of(x, y) < 0.75


# --- 2 --------------------------------------------------------------------------

def test_packing_round_trip():
    for bits in (1, 5, 16, 17, 31, 32):
        for n in (0, 1, 31, 32, 33, 1024, 5000):
            x = np.random.default_rng(n).integers(0, 2**bits, n)
            payload, offsets = packed_ids.pack(x, bits)
            assert (packed_ids.unpack(payload, bits, n) == x).all()
            if n == 5000:
                assert len(offsets) == 5
                assert (packed_ids.read_ids(payload, offsets, bits, 1500, 3001) == x[1500:3001]).all()


ALPHABET = "ab's't'RElLvem d  \n\té漢字123½_!?…'́\x1c\x85ÉﬁΣς<|>"


def noise(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)] + [
        "", "'s", " 's", "x" * 5000 + " " * 3000, "it's we'll  I'm\n\nok <|endoftext|> a", "İ"]


def test_word_encoder_equals_library():
    e = packed_ids.WordEncoder(P.path(queries.WORD_VOCABULARY))
    texts = noise(2000)
    assert [x.tolist() for x in e.encode(texts)] == [e.whole(t) for t in texts]


def test_op2_files_hold_the_library_ids(spark, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path(queries.WORD_VOCABULARY))
    got, start, stream = by_id(queries.op2_packed_ids(spark, SF)), 0, []
    for d, text, _ in rows:
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        g = got[d]
        assert (g["start"], g["n_tokens"]) == (start, len(ids))
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        stream += ids
    folder = packed_ids.encode_to_files(spark.read.parquet(f"{SF}/documents.parquet"),
                                        P.path(queries.WORD_VOCABULARY), queries.WORD_IDS, 2)
    for a, b in ((0, 10), (4000, 9001), (start - 7, start)):
        assert packed_ids.find_ids(spark, folder, a, b).tolist() == stream[a:b]
    whole = {r["doc_id"]: (r["start"], r["ids"]) for r in packed_ids.read_packed(spark, folder).collect()}
    assert all(stream[s:s + len(i)] == i for s, i in whole.values())


# --- 4 --------------------------------------------------------------------------

def test_fold_and_exceptions():
    assert toxicity.fold("Tr4sh, ідіоt!").split() == ["trash", "idiot"]
    m = toxicity.Model({" trash ": 5.0, " scum": 3.0}, frozenset({"trash can"}), (-2.0, 2.0, 0.0), False)
    assert m.evidence("the trash can")[2] == 0 and m.evidence("you trash")[2] == 1
    assert m.evidence("sCuMbag")[2] == 1 and m.evidence("circumscum")[2] == 0
    assert m.score(m.evidence("")) < 0.5 < m.score(m.evidence("tr4sh scum"))


def test_op4_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op4_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    hit = sum(r["predicted"] and r["toxic"] for r in held)
    assert hit / sum(r["toxic"] for r in held) > 0.9
    assert hit / max(1, sum(r["predicted"] for r in held)) > 0.9


# --- 5 --------------------------------------------------------------------------

def test_op5_groups(spark, rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[t.translate(lower)].append(d)
    got = by_id(queries.op5_exact_dedup(spark, SF))
    for t, ids in groups.items():
        for d in ids:
            g = got[d]
            assert (g["keep_id"], g["group_size"], g["kept"], g["text_sha256"]) == \
                (max(ids), len(ids), d == max(ids), sha(t))


def test_digest_index_persists(spark):
    new = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, buckets=2)
    exact_dedup.exact_dedup(new((1, "a"), (2, "b"), (3, "A")), index).collect()
    again = exact_dedup.DigestIndex(spark, index.path, buckets=2)  # another session's view of it
    got = by_id(exact_dedup.exact_dedup(new((9, "a"), (10, "c")), again))
    assert (got[9]["keep_id"], got[9]["kept"]) == (3, False)
    assert (got[10]["keep_id"], got[10]["kept"]) == (10, True)
    assert (got[9]["group_size"], got[10]["group_size"]) == (3, 1)
    third = [(20 + i, "A" if i % 2 else "d") for i in range(40)]
    got = by_id(exact_dedup.exact_dedup(new(*third), again))
    assert {(g["keep_id"], g["group_size"]) for g in got.values()} == {(3, 23), (58, 20)}
    assert [d for d, g in got.items() if g["kept"]] == [58]
    groups = {r["keep_id"]: r["group_size"] for r in again.groups().collect()}
    assert groups == {3: 23, 2: 1, 10: 1, 58: 20}
    plan = again.groups()._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
    plan = new((9, "a")).select(exact_dedup.F.lit(b"x").alias("digest")).join(
        again.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 1


# --- 7 --------------------------------------------------------------------------

def check_shards(rows, sizes, shards=16):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    per = [sum(r["size"] for r in by[i]) for i in range(shards)]
    assert max(per) - min(per) <= 2 * max(sizes)


def test_op7_bytes_law(spark, rows):
    got = by_id(queries.op7_sharding(spark, SF))
    assert len(got) == len(rows)
    for d, t, _ in rows:
        assert got[d]["size"] == len(t.encode()) + 1
        assert got[d]["text_crc32"] == zlib.crc32(t.encode())
    check_shards(got.values(), [r["size"] for r in got.values()])


def test_shards_split_a_hot_key(spark):
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"text {i}") for i in range(3000)],
                                 "doc_id long, text string")
    got = sharding.shard_by_bytes(docs, ranges=200).collect()
    check_shards(got, [r["size"] for r in got])
    assert max(Counter(r["split_range"] for r in got).values()) < 200


def test_shards_split_a_row_that_is_a_third_of_all(spark, monkeypatch):
    drawn, draw = [], sharding._draw
    monkeypatch.setattr(sharding, "_draw", lambda *a: drawn.append(draw(*a)) or drawn[-1])
    docs = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'the same row', "
                                          "concat('text ', id)) as text").repartition(5)
    got = sharding.shard_by_bytes(docs, ranges=100).collect()
    check_shards(got, [r["size"] for r in got])
    assert max(Counter(r["split_range"] for r in got).values()) < 1200     # 300 are an even share
    assert max(map(len, drawn)) < 2 * sharding.SAMPLES * 100
    assert len({r["shard"] for r in got if r["doc_id"] == 7}) > 4


def test_ranges_count_boundaries_at_or_below(spark):
    bounds = sorted({(random.Random(i).randrange(3), i % 4, i % 5) for i in range(40)})
    rows = [(k, d, s) for k in range(-1, 4) for d in (None, 0, 1, 2, 3, 4) for s in range(-1, 6)]
    df = spark.createDataFrame(rows, "key long, doc_id long, salt long")
    low = lambda d: -(1 << 63) if d is None else d
    for some in (bounds, bounds[:1], []):
        for r in sharding.with_range(df, some).collect():
            assert r["range"] == sum(b <= (r["key"], low(r["doc_id"]), r["salt"]) for b in some)


# --- 8 --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    import tiktoken
    path = P.path(queries.BYTE_VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return byte_bpe.Codec(byte_bpe.read_ranks(path)), tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(both):
    own, lib = both
    texts = noise(3000)
    ids, at = own.encode(texts)
    for i, t in enumerate(texts):
        one = ids[at[i]:at[i + 1]]
        assert one.tolist() == lib.encode_ordinary(t)
        assert own.decode(one) == t.encode()


def test_perfect_hash_is_minimal(both):
    h = both[0].whole
    assert sorted(h.key.tolist()) == list(range(len(both[0].vocabulary)))


def test_op8_digests(spark, rows, both):
    got = by_id(queries.op8_byte_bpe(spark, SF))
    for d, t, _ in rows:
        ids = both[1].encode_ordinary(t)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"], got[d]["decoded_sha256"]) == \
            (len(ids), sha(",".join(map(str, ids))), sha(t))


def test_encode_then_decode_frames(spark, docs):
    path = P.path(queries.BYTE_VOCABULARY)
    back = by_id(byte_bpe.decode(byte_bpe.encode(docs, path), path))
    assert all(back[r["doc_id"]]["bytes"] == (r["text"] or "").encode() for r in docs.collect())


# --- 9 --------------------------------------------------------------------------

def test_share_targets():
    t = mixing.share_targets([("a", 100), ("b", 1000), ("c", 10), (None, 0)])
    assert t[2] == 30 and t[3] == 0 and abs(sum(t) - 1110) < 1e-9
    assert t[0] == 300 and abs(t[1] - 780) < 1e-9


def test_op9_meets_targets(spark, rows):
    got = by_id(queries.op9_mixing(spark, SF))
    per = defaultdict(list)
    for d, t, s in rows:
        assert got[d]["size"] == len(WORDS.findall(t))
        assert 0 <= got[d]["taken"] <= 3 * got[d]["size"]
        per[s].append(got[d])
    order = sorted(per, key=lambda s: (s is None, s or ""))
    want = mixing.share_targets([(s, sum(r["size"] for r in per[s])) for s in order])
    for s, t in zip(order, want, strict=True):
        assert all(abs(r["target"] - t) < 1e-6 * max(1, t) for r in per[s])
        assert abs(sum(r["taken"] for r in per[s]) - t) <= 2 * max(r["size"] for r in per[s])
    again = by_id(queries.op9_mixing(spark, SF))
    assert all(again[d]["taken"] == g["taken"] for d, g in got.items())


# --- odd rows -------------------------------------------------------------------

@pytest.mark.parametrize("run", [
    syncmers.with_edited, syncmers.fingerprints,
    lambda d: packed_ids.read_digests(d.sparkSession, packed_ids.encode_to_files(
        d, P.path(queries.WORD_VOCABULARY), queries.WORD_IDS, 2)),
    lambda d: toxicity.score(d, toxicity.learn(d, d.sparkSession.createDataFrame(
        [(1, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int"))),
    exact_dedup.exact_dedup, sharding.shard_by_bytes, mixing.mix,
    lambda d: byte_bpe.round_trip(d, P.path(queries.BYTE_VOCABULARY))],
    ids=["syncmers", "fingerprints", "packed", "toxicity", "exact", "shards", "mix", "bpe"])
def test_odd_and_empty_tables(run, odd, none):
    got = run(odd).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ODD)
    assert run(none).collect() == []


def test_toxicity_trains_on_one_row_of_a_repeated_id(spark):
    """A labelled doc_id may be a third of all rows: the training rows stay bounded."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    hot = ids[0]
    rows = [(i, f"text {i}") for i in range(400)] + [(hot, "again")] * 3000 + [(hot, f"other {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.training_rows(docs, labels, rows=10_000).collect()
    assert sorted(r["doc_id"] for r in got) == ids
    assert toxicity.training_rows(docs, labels, rows=50).count() < 80
    assert toxicity.training_rows(docs.repartition(7), labels).filter(f"doc_id = {hot}").first() == \
        next(r for r in got if r["doc_id"] == hot)


def test_toxicity_hits_match_a_plain_scan():
    """Hits and their neighbours against a word-by-word statement; neighbours of any length count."""
    rng = random.Random(4)
    words = ["bad", "badly", "good", "b4d", "awful", "x" * 200, "y" * 90, "so", "-", "  "]
    model = toxicity.Model(lexicon={" bad ": 2.0, " bad": 1.0, " awf": 3.0}, empty=False)
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
        flat = toxicity.fold(text).split()
        want = []
        for i, w in enumerate(flat):
            best = max([v for e, v in model.lexicon.items() if (f" {w} " if e.endswith(" ") else f" {w}").startswith(e)],
                       default=None)
            if best is not None:
                before, after = flat[i - 1] if i else "", flat[i + 1] if i + 1 < len(flat) else ""
                want.append((best, (w, f"{before} {w}", f"{w} {after}")))
        assert list(model.hits(toxicity.fold(text))) == want


def test_toxicity_time_is_linear_in_the_text():
    import time
    model = toxicity.Model(lexicon={" bad ": 2.0}, empty=False)
    took = []
    for n in (20_000, 160_000):
        text = "bad " + "one two three four five bad " * (n // 6)
        t = time.thread_time()
        model.evidence(text)
        took.append(time.thread_time() - t)
    assert took[1] < 8 * took[0] * 4, took


def test_mixing_of_a_row_that_is_a_third_of_all(spark, monkeypatch):
    """Equal rows are one entry: no cell holds them, and each still gets its own output row."""
    monkeypatch.setattr(mixing, "DEALT", 64)
    hot = [(7, "three words here", "a")] * 5000
    rest = [(i, " ".join(["w"] * (1 + i % 9)), "abc"[i % 3]) for i in range(100, 3100)]
    nulls = [(None, " ".join(["n"] * (i % 5)) + f" {i}", "b") for i in range(2000)]
    rows = hot + rest + nulls
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    seen = mixing.mix_groups(df).cache()
    assert seen.count() == 1 + len(rest) + len(nulls) and seen.agg({"n": "max"}).first()[0] == 5000
    got = mixing.mix(df).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == \
        Counter((d, len(WORDS.findall(t)), s) for d, t, s in rows)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORDS.findall(t))
    for s, target in zip("abc", mixing.share_targets(sorted(size.items())), strict=True):
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - target) <= 20
        assert all(r["taken"] <= 3 * r["size"] for r in got)
    copies = Counter(r["copies"] for r in got if r["doc_id"] == 7)
    assert len(copies) <= 2 and sum(copies.values()) == 5000
    again = Counter(map(tuple, mixing.mix(df.repartition(3)).collect()))
    assert again == Counter(map(tuple, got))

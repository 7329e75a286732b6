"""Operators 3 and 6 against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from foodgrid.llm import queries, repeats, subtree_dedup, suffix_dedup

from .conftest import LONG, ODD, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def gone_bytes(rows, window=100):
    """Mask of removed bytes per row of [(doc, bytes)], rows in order."""
    first, out = set(), []
    for _, t in rows:
        mask, end = bytearray(len(t)), 0
        for i in range(len(t) - window + 1):
            w = t[i:i + window]
            if w in first:
                mask[max(i, end):i + window] = b"\1" * (i + window - max(i, end))
                end = i + window
            first.add(w)
        out.append(bytes(mask))
    return out


def gone_words(rows, window=13):
    first, out = {}, []
    for d, ws in rows:
        for i in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[i:i + window]), d)
    for d, ws in rows:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] != d:
                gone.update(range(i, i + window))
        out.append(gone)
    return out


def check_bytes(got, rows):
    for (d, t), mask in zip(rows, gone_bytes(rows), strict=True):
        kept = bytes(b for b, m in zip(t, mask, strict=True) if not m)
        spans = len([x for x in bytes(mask).split(b"\0") if x])
        g = got[d]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"]) == (len(t), sum(mask), spans), d
        assert g["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def check_words(got, rows):
    for (d, ws), gone in zip(rows, gone_words(rows), strict=True):
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        g = got[d]
        assert (g["n_words"], g["n_removed"]) == (len(ws), len(gone)), d
        assert g["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_op3_equals_brute_force(spark, rows):
    check_bytes(by_id(queries.op3_suffix_dedup(spark, SF)), [(d, t.encode()) for d, t, _ in rows])


def test_op6_equals_brute_force(spark, rows):
    check_words(by_id(queries.op6_subtree_dedup(spark, SF)), [(d, WORDS.findall(t)) for d, t, _ in rows])


def made(seed):
    """Texts of few letters, with passages that many documents share."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab ") for _ in range(rng.randrange(90, 260))) for _ in range(6)]
    out = []
    for i in range(150):
        t = "".join(rng.choice("abc ") for _ in range(rng.randrange(120)))
        t += "".join(rng.choice(passages)[rng.randrange(30):] for _ in range(rng.randrange(4)))
        out.append((i, t + ("a" * 150 if i % 9 == 0 else "")))
    return out


@pytest.mark.parametrize("wide", [repeats.WIDE, 2])
def test_made_texts(spark, wide, monkeypatch):
    """``wide=2`` sends almost all seeds the way of very wide ones."""
    monkeypatch.setattr(repeats.repeated, "__defaults__", (wide,))
    rows = made(wide)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check_bytes(by_id(suffix_dedup.remove_repeats(df)), [(d, t.encode()) for d, t in rows])
    rows = [(d, " ".join(t.replace(" ", ""))) for d, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check_words(by_id(subtree_dedup.remove_repeats(df)), [(d, t.split()) for d, t in rows])


def test_cover_meets_every_pair():
    d = suffix_dedup.cover_distance()
    for i in range(32):
        for j in range(32):
            assert {(i + d[i, j]) % 32, (j + d[i, j]) % 32} <= set(suffix_dedup.COVER)


@pytest.mark.parametrize("bucket", [7, 1 << 17])
def test_suffixes_are_sorted_and_grouped(bucket):
    rng = random.Random(bucket)
    text = np.frombuffer(b"".join(bytes(rng.choice(b"ab") for _ in range(20)) * rng.randrange(1, 30)
                                  for _ in range(40)), np.uint8)
    places = np.arange(0, len(text) - 100, 3)
    raw, seen = text.tobytes(), []
    for p, c in suffix_dedup.sorted_classes(text, places, 100, bucket):
        windows = [raw[x:x + 100] for x in p]
        assert windows == sorted(windows)
        assert [x == y for x, y in zip(windows, windows[1:])] == (np.diff(c) == 0).tolist()
        seen += windows
    assert len(seen) == len(places) and len(set(seen)) == len(set(raw[x:x + 100] for x in places))


@pytest.mark.parametrize("limit", [3, 40, 10_000])
def test_subtree_groups(limit):
    rng = random.Random(limit)
    base = [rng.choice(["x", "yy", "z"]) for _ in range(60)]
    group = []
    for k in range(60):
        w = base[(x := rng.randrange(30)):x + rng.randrange(13, 25)]
        if len(w) >= 13:
            group.append((rng.randrange(6), 0, 1000 * k, len(w) - 12, "  ".join(w).encode()))
    i, a, n = subtree_dedup.repeated_places(group, 13, limit)
    got = {(group[k][0], p) for k, s, c in zip(i, a, n, strict=True) for p in range(s, s + c)}
    where = defaultdict(list)
    for d, _, at, m, p in group:
        for x in range(m):
            where[tuple(p.split()[x:x + 13])].append((d, at + x))
    assert got == {o for v in where.values() for o in v if o[0] != min(v)[0]}


def test_odd_rows(spark, odd, none):
    for f in (suffix_dedup.remove_repeats, subtree_dedup.remove_repeats):
        got = f(odd).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ODD)
        assert f(none).collect() == []
    got = by_id(subtree_dedup.remove_repeats(odd))
    assert got[5]["n_removed"] == 0 and got[6]["n_removed"] == len(LONG.split())
    got = by_id(suffix_dedup.remove_repeats(odd))
    assert got[10]["kept"] == b"x" and got[6]["kept"] == b"end"


def test_lists_do_not_grow_with_repeated_rows(spark):
    """A row that is a third of all: its list is as long as that of one such row."""
    rng = random.Random(5)
    ws = [rng.choice(["aa", "b", "cc", "d"]) + str(rng.randrange(9)) for _ in range(300)]
    text = " ".join(ws + ws[40:120])
    rows = [(7, text)] * 500 + [(100 + i, " ".join(ws[i % 90:i % 90 + 40])) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for module, units, window, k, inside in ((suffix_dedup, repeats.byte_units, 100, 12, True),
                                             (subtree_dedup, repeats.word_units, 13, 3, False)):
        own = repeats.texts(docs)
        found = repeats.classes(repeats.runs(own, units, window, k), inside)
        lists = repeats.with_lists(own, found, "found", "seed", "a", "n")
        assert lists.count() == 1500
        assert lists.selectExpr("max(size(found))").first()[0] <= len(text)
        once = {tuple(r) for r in module.remove_repeats(docs).filter("doc_id = 7").collect()}
        assert len(once) == 1      # equal rows, equal results

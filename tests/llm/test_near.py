"""Operator 10 against all pairs, on whole small tables."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from foodgrid.llm import base, near_dedup, queries

from .conftest import ODD, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORDS.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or {tuple(w)}


def brute(rows, width, percent=80):
    """component_id by comparing every document with all that share a shingle."""
    sets = {d: shingles(t, width) for d, t in rows}
    having, root = defaultdict(list), {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in sorted(sets):
        common = defaultdict(int)
        for x in sets[d]:
            for o in having[x]:
                common[o] += 1
            having[x].append(d)
        for o, c in common.items():
            if 100 * c >= percent * (len(sets[d]) + len(sets[o]) - c):
                a, b = sorted((find(d), find(o)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def check(got, rows, width):
    want = brute(rows, width)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_op10_equals_all_pairs(spark, rows):
    check(queries.op10_minhash_bayes(spark, SF).collect(), [(d, t) for d, t, _ in rows], 2)


def near_copies(seed, bases=12, copies=25):
    """Texts of 2 to 600 words, each with copies of which up to an eighth of the words differ."""
    rng, out = random.Random(seed), []
    for b in range(bases):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([2, 6, 15, 40, 90, 300, 600]))]
        for _ in range(copies):
            w = list(words)
            for _ in range(rng.randrange(len(w) // 8 + 1)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(4000)}"
            out.append(" ".join(w).title() if rng.random() < 0.1 else " ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("seed", "group"), [(1, 2048), (2, 8), (3, 2)])
def test_near_copies(spark, seed, group, monkeypatch):
    """Small blocks make every group one of many blocks."""
    monkeypatch.setattr(near_dedup, "GROUP", group)
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(near_dedup.groups(df, 2).collect(), rows, 2)


def test_no_block_holds_all_of_a_component_without_main_group(spark, monkeypatch):
    """Short texts on one template, likeness about a half: one candidate component, few links."""
    rng = random.Random(7)
    form = [f"t{i}" for i in range(40)]
    rows = [(i, " ".join(form + [f"o{rng.randrange(90_000)}" for _ in range(20)])) for i in range(400)]
    rows += [(400 + i, rows[i * 9][1].replace(" o", " z", 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    most, plain = [], near_dedup.link_blocks

    def watched(blocks, *rest):
        most.append(blocks.groupBy("root", "block").count().agg({"count": "max"}).first()[0])
        return plain(blocks, *rest)

    monkeypatch.setattr(near_dedup, "GROUP", 32)
    monkeypatch.setattr(near_dedup, "link_blocks", watched)
    check(near_dedup.groups(df, 2).collect(), rows, 2)
    assert len(most) == 2 and max(most) < 4 * 32, most


def test_common_passage_does_not_link(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(300)}" for _ in range(150))
    rows = [(i, passage + " " + " ".join(f"o{rng.randrange(9000)}" for _ in range(120 + i))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(near_dedup.groups(df, 2).collect(), rows, 2)


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    for size in (5, 9, 20, 45, 70, 120, 400):
        found = 0
        for _ in range(200):
            u = rng.integers(0, 2**63, size * 10 // 9 + 1).astype(np.uint64)
            common = u[:math.ceil(0.8 * len(u))]
            rest = u[len(common):]
            x = np.sort(np.append(common, rest[::2]))
            y = np.sort(np.append(common, rest[1::2]))
            hit = False
            if len(x) < near_dedup.SMALL * 5 // 4 + 1:
                hit |= bool(set(near_dedup.band_values(near_dedup.independent(x), 31).tolist())
                            & set(near_dedup.band_values(near_dedup.independent(y), 31).tolist()))
            if len(x) >= near_dedup.SMALL:
                hit |= bool(set(near_dedup.band_values(near_dedup.one_permutation(x), 32).tolist())
                            & set(near_dedup.band_values(near_dedup.one_permutation(y), 32).tolist()))
            found += hit
        assert found == 200, size


def test_posterior_bound():
    for n in (32, 128, 512):
        m = near_dedup.least_matches(n, 0.8, 1e-9)
        p = 0.8 + 0.2 / 256
        tail = lambda k: sum(math.comb(n + 1, i) * p**i * (1 - p)**(n + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-9 > tail(m - 1)


def test_shingle_sets():
    got = near_dedup.shingle_sets(pa.array(["a B a b", "A b", "b a", "a", "", " "]), 2)
    assert [len(s) for s in got] == [2, 1, 1, 1, 0, 0]
    assert got[1][0] in got[0] and got[2][0] in got[0] and got[3][0] != got[1][0]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + \
        [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["node"]: r["root"] for r in base.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_odd_rows(spark, odd, none):
    got = near_dedup.groups(odd, 2).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[7]["component_id"] == 1 and by[2]["component_id"] == 1 and not by[2]["kept"]
    assert by[3]["n_shingles"] == by[8]["n_shingles"] == 0 and by[3]["kept"] and by[8]["kept"]
    assert by[None]["kept"]
    assert near_dedup.groups(none, 2).collect() == []
    assert len(near_dedup.drop_near_copies(odd).columns) == len(odd.columns)


def templated(n, seed, shared=27, own=33, groups=9):
    """Documents on one template (about 45 % of their shingles), some of them near copies."""
    rng = random.Random(seed)
    template = " ".join(f"t{i}" for i in range(shared))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(own)) for _ in range(n)]
    for g in range(groups):
        k = rng.randrange(n)
        words = texts[k].split()
        words[3 + g % 5] = f"changed{g}"
        texts[rng.randrange(n)] = " ".join(words)
    return [(i, f"{template} {t}") for i, t in enumerate(texts)]


@pytest.mark.parametrize("chunk", [16, 512])
def test_templates_settle_in_a_fixed_number_of_rounds(spark, monkeypatch, chunk):
    rows = templated(500, chunk)
    rounds = []
    plain = near_dedup.stars
    monkeypatch.setattr(near_dedup, "stars", lambda m: (rounds.append(1), plain(m))[1])
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "ROUNDS", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.groups(df, 2).collect()
    check(got, rows, 2)
    assert len(rounds) <= 2 and sum(not r["kept"] for r in got) > 3


def test_block_joins_what_is_near_and_nothing_far():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (30, 30, 300, 300, 700, 700)]
    sets += [np.append(s[:-1], s[:1] + np.uint64(1)) for s in sets]         # a near copy of each
    sig = near_dedup._signatures(
        [near_dedup.own_signature(s).tobytes() if len(s) <= near_dedup.OWN else None for s in sets],
        [near_dedup.signature(s)[:near_dedup.EDGE_BYTES].tobytes() if len(s) >= near_dedup.PLAIN else None for s in sets])
    want = {(i, i + 6) for i in range(6)}
    assert set(near_dedup.near_in_block(sig, np.ones(12, bool), 0.8)) == want
    first = np.arange(12) < 6
    assert set(near_dedup.near_in_block(sig, first, 0.8)) == want
    assert near_dedup.near_in_block(sig, np.arange(12) % 6 < 3, 0.8) == []   # the copies are in one chunk


def _planned(monkeypatch, module, run):
    """(name, plan) of each table that ``run`` stores."""
    seen, stored = [], base.stored

    def noted(df, name="table"):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(module, "stored", noted)
    run()
    return seen


def test_a_round_of_components_deals_its_edges_once_for_the_small_star(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (7, 8)], "a long, b long")
    got = []
    seen = _planned(monkeypatch, base, lambda: got.extend(base.components(edges).collect()))
    assert {r["node"]: r["root"] for r in got} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7}
    for _, plan in seen[1:]:
        assert "REPARTITION_BY_COL" in plan
        pairs = [x for x in plan.splitlines() if "hashpartitioning(a#" in x and ", b#" in x]
        assert len(pairs) == 1, plan   # for the distinct edges at the end alone


def test_the_members_of_a_round_are_written_once(spark, monkeypatch):
    docs = spark.createDataFrame(templated(120, 5), "doc_id long, text string")
    sketch = base.stored(near_dedup.sketches(base.texts(docs), 2))
    seen = _planned(monkeypatch, near_dedup, lambda: near_dedup.candidate_edges(sketch, 0.8))
    names = [n for n, _ in seen]
    assert names.count("stars") > 1 and names.count("members") >= names.count("stars") - 1
    # what a later round sorts by ranges is a table, not the joins that made it
    assert all("Join" not in plan for n, plan in seen if n == "stars")

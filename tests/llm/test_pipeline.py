"""The pipeline against a plain version of every stage, on a whole small table."""

import base64
import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from foodgrid.llm import mixing, queries, toxicity

from .conftest import ODD, SF
from .test_near import LOWER, WORDS, brute


def test_pipeline_stage_by_stage(spark, docs):
    model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    want = {d for d, r in rows.items() if model.score(model.evidence(r["text"] or "")) < 0.7}
    assert len(want) < len(rows)
    got = stages["toxicity"](spark, docs, SF)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == want

    newest = {}
    for d in sorted(want):
        newest[(rows[d]["text"] or "").translate(LOWER)] = d
    got = stages["exact_dedup"](spark, got, SF)
    want = set(newest.values())
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == sorted(want)

    group = brute([(d, rows[d]["text"]) for d in want], 5)
    got = stages["near_dedup"](spark, got, SF)
    want = {d for d in want if group[d][1] == d}
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == sorted(want)

    size = {d: len(WORDS.findall(rows[d]["text"] or "")) for d in want}
    per = defaultdict(list)
    for d in want:
        per[rows[d]["source"]].append(d)
    got = stages["mixing"](spark, got, SF)
    mixed = Counter(r["doc_id"] for r in got.collect())
    assert got.columns == docs.columns and set(mixed) <= want and max(mixed.values()) <= 3
    order = sorted(per, key=lambda s: (s is None, s or ""))
    targets = mixing.share_targets([(s, sum(size[d] for d in per[s])) for s in order])
    for s, t in zip(order, targets, strict=True):
        assert abs(sum(mixed[d] * size[d] for d in per[s]) - t) <= 2 * max(size[d] for d in per[s])

    path = P.path(queries.BYTE_VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    done = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in done) == mixed
    for r in done:
        text = rows[r["doc_id"]]["text"] or ""
        assert r["ids"] == lib.encode_ordinary(text) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_repeated_rows_are_one(spark):
    hot = [(7, "the same row again and again and again", "a")] * 300
    rest = [(i, " ".join(f"w{i * 50 + k}" for k in range(5 + i % 9)), "ab"[i % 2]) for i in range(100, 400)]
    odd = [(1, "a text that is copied", "a"), (2, "A text that is copied", "a"), (2, "its own other text", "b"),
           (None, "no id", "b"), (None, "no id", "b")]
    df = spark.createDataFrame(hot + rest + odd, "doc_id long, text string, source string").repartition(5)
    stages = dict(corpus_pipeline.STAGES)
    got = [tuple(r) for r in stages["exact_dedup"](spark, df, SF).collect()]
    want = [hot[0], *rest, *odd[1:4]]
    assert Counter(got) == Counter(want)
    # two texts of one doc_id (and of one group) are one row as well
    near = " ".join(f"n{i}" for i in range(60))
    close = spark.createDataFrame([(3, near, "a"), (3, near + " end", "b"), (4, near + " e", "a")], df.schema)
    got = [tuple(r) for r in stages["near_dedup"](spark, df.unionByName(close), SF).collect()]
    count = Counter(r[0] for r in got)
    assert (count[7], count[3], count[4], count[1], count[2], count[None]) == (1, 1, 0, 1, 1, 1)
    assert len(got) == len(rest) + 5
    # nothing vanishes in the mix, and each source meets its target
    mixed = [tuple(r) for r in stages["mixing"](spark, df, SF).collect()]
    assert set(mixed) <= {*hot, *rest, *odd}
    per = defaultdict(int)
    for _, t, s in [*hot, *rest, *odd]:
        per[s] += len(WORDS.findall(t))
    for s, t in zip("ab", mixing.share_targets(sorted(per.items())), strict=True):
        assert abs(sum(len(WORDS.findall(r[1])) for r in mixed if r[2] == s) - t) <= 2 * 13


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, SF).collect()
    assert {r["doc_id"] for r in got} <= {r[0] for r in ODD}
    assert stage(spark, none, SF).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_with_internal_names(spark, odd, name):
    own = ["__rid", "__copies", "__keep", "__digest", "__part", "__copy", "__doc", "__n", "__row", "__order",
           "__id", "__key0", "kept_id", "kept_digest", "KEPT_RID", "mix_rid", "mix_copies", "node", "root", "group"]
    more = odd.selectExpr("*", *[f"concat('{c}', doc_id) as `{c}`" for c in own])
    stage = dict(corpus_pipeline.STAGES)[name]
    got, plain = stage(spark, more, SF), stage(spark, odd, SF)
    assert got.columns == more.columns
    assert Counter(got.select(odd.columns).collect()) == Counter(plain.collect())
    for r in got.collect():
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for c in own)

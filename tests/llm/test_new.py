"""Operators 11, 12 and 13 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from foodgrid.llm import fill_in_middle as fim, queries, source_divergence as div, url_rules
from foodgrid.llm.textarrays import utf8

from .conftest import ODD, SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- 11 -------------------------------------------------------------------------

def judged(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(LOWER)
    fit = [(len(a) + len(b), len(a), a + b, v) for a, b, v in rules
           if (host == a or host.endswith("." + a)) and path.startswith(b)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.mark.parametrize("ranges", [1, 3, 25])
def test_rules_nested_in_host_and_path(spark, ranges):
    rng = random.Random(ranges)
    labels = ["com", "net", "a", "b", "www", "é", ""]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "".join(rng.choice("ab/é") for _ in range(rng.randint(0, 5))) for _ in range(60)] + [""]
    rules = [(rng.choice(hosts), rng.choice(paths)[:rng.randint(0, 4)], rng.choice(["allow", "block"]))
             for _ in range(90)]
    urls = [f"{rng.choice(['http', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}"
            f"{rng.choice(['', '?q=://a/b', '#t', '?a#b'])}" for _ in range(500)]
    urls += [None, "", "nothing", "a:/b", "://", "http://WWW.a.Com/A", "http://x/y\nz?u", "h://" + "a." * 3000 + "com/",
             "h://a.com/" + "b" * 50_000]
    urls += ["https://www.a.com/ab"] * 700    # a hot url
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "'x' as key", "'y' as kind", "'z' as `range`", "1 as host", "2 as path", "3 as verdict").repartition(7)
    lost = [(None, "/", "block"), ("com", None, "block"), ("com", "/", None)]
    table = spark.createDataFrame(rules + lost, "host string, path string, verdict string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = url_rules.judge(df, table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(urls)
    assert {r[0]: tuple(r) for r in got} == {i: (i, *judged(u, rules)) for i, u in enumerate(urls)}


def test_op11_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: tuple(r) for r in queries.op11_url_rules(spark, SF).collect()}
    assert got == {p: (p, *judged(u, url_rules.RULES)) for p, u in pages}
    assert len({r[3] for r in got.values()}) > 3


def test_op11_without_rules_pages_or_ids(spark):
    none = url_rules.rule_table(spark, [])
    rows = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, None)],
                                 "page_id long, url string")
    got = url_rules.judge(rows, none, default="block").collect()
    assert Counter(map(tuple, got)) == {(1, "a.com", "/", None, "block"): 2, (None, "", "", None, "block"): 1}
    rules = url_rules.rule_table(spark, url_rules.RULES)
    assert url_rules.judge(rows.limit(0), rules).collect() == []


def test_op11_has_no_python_worker(spark):
    df = queries.op11_url_rules(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# --- 12 -------------------------------------------------------------------------

def middled(text, h):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def draws(doc_id):
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


@pytest.mark.parametrize("step", [3, 7, 1 << 20])
def test_scatter_and_gather_of_a_block(monkeypatch, step):
    monkeypatch.setattr(fim, "STEP", step)
    rng = random.Random(step)
    for _ in range(150):
        texts = ["".join(rng.choice(["a", "b", " ", "é", "漢", "🙂", "<", "P", ">", "S", "<P>", "<M", "\n"])
                         for _ in range(rng.choice([0, 0, 1, 2, 5, 30]))) for _ in range(rng.randint(1, 9))]
        h = [[rng.getrandbits(32) for _ in range(4)] for _ in texts]
        data, bounds = utf8(pa.array(texts))
        got = fim.cut(data, bounds, list(np.array(h, np.int64).T))
        out, out_bounds = fim.scatter(data, bounds, got["form"], got["c1"], got["c2"])
        want = [middled(t, x) for t, x in zip(texts, h, strict=True)]
        assert fim._strings(out, out_bounds).to_pylist() == [w[4] for w in want]
        assert got["n"].tolist() == [w[0] for w in want]
        assert fim._strings(*fim.gather(out, out_bounds, got["form"])).to_pylist() == texts


def test_op12_on_documents_and_odd_rows(spark, docs, odd):
    marks = spark.createDataFrame([(i, t, "en", "a", 0, "", "") for i, t in enumerate(
        ["a <P> in it", "<M>", "< P>", "<P", "a<S>b", "no marks in here at all"] * 30, 100)], odd.schema)
    for df in (docs, odd.unionByName(marks).selectExpr("*", "'x' as output", "1 as form", "2 as h1")):
        rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
        got = Counter(map(tuple, fim.digests(df).collect()))
        want = Counter()
        for d, t in rows:
            *w, out = middled(t, draws(d))
            want[(d, *w, sha(out), sha(t))] += 1
        assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_op12_restores_from_output_and_form_alone(spark, docs, none):
    rows = fim.transform(docs)
    back = fim.restore(rows.selectExpr("doc_id", "0L as n", "form", "0L as prefix_chars",
                                       "cast(null as long) as middle_chars", "output"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert {r["doc_id"]: r["restored"] for r in back.select("doc_id", "restored").collect()} == texts
    assert fim.digests(none).collect() == []
    torn = rows.limit(1).selectExpr("doc_id", "n", "'psm' as form", "prefix_chars", "middle_chars", "'a<P>' as output")
    with pytest.raises(Exception, match="marks of its form"):
        fim.restore(torn).collect()


# --- 13 -------------------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(rows, min_docs, top):
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERMS.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(terms[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(5)
    words = ["A", "b", "é", "Zß", "漢字", "x1y", "Ab", "don't", "q", *[f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) or None,
             rng.choice(["en", "fr", None, "", "de\0x"]), rng.choice(["s1", "s2", "é", None, "", "s3"]))
            for _ in range(150)]
    return rows + [("zzz", "one", "only"), ("", "two", "a"), (None, "two", "b"), *[("own own", "en", "hot")] * 100]


def as_docs(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], "doc_id long, text string, "
                                 "lang string, source string, term string, idx int")


@pytest.mark.parametrize("slices", [1, 3])
def test_divergence_matches_its_definition(spark, sources, monkeypatch, slices):
    monkeypatch.setattr(div, "BLOCK", 2)
    monkeypatch.setattr(div, "TERMS", 5)
    monkeypatch.setattr(div, "LIMIT", 40)
    got = div.audit(as_docs(spark, sources), min_docs=3, top=4, slices=slices).collect()
    assert sorted(map(tuple, got)) == divergence(sources, 3, 4)


def test_tokens_of_a_block(monkeypatch):
    monkeypatch.setattr(div, "LIMIT", 5)
    texts = ["Ab c", "", "..", "é漢x_y", "A", "[a]{b}\x7f", "x" * 30]
    data, bounds = utf8(pa.array([t + div.END for t in texts]))
    got, sampled = div.tokens_of(data, bounds, [b"en\0", b"", b"q\0", b"en\0", b"", b"\0", "é\0".encode()])
    want = [["en\0ab", "en\0c"], [], [], ["en\0é漢x", "en\0y"], ["a"], ["\0a", "\0b"], ["é\0" + "x" * 30]]
    assert got.to_pylist() == want and len(sampled) == 8


def test_divergence_without_kept_terms_or_rows(spark, none):
    few = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", None)]
    got = sorted(map(tuple, div.audit(as_docs(spark, few)).collect()))
    assert got == divergence(few, 30, 50) and len(got) == 6 and all(r[4] == 0 for r in got)
    assert div.audit(none).collect() == []


def test_shares_stay_exact_for_large_counts(spark):
    rows = [(10**13, 3 * 10**14, 10**6), (0, 10**15, 7), (5, 0, 0), (10**18, 10**18 + 1, 1)]
    df = spark.createDataFrame(rows, "count long, n long, v long")
    assert [r[0] for r in df.select(div._share("count")).collect()] == [
        1 + 10**9 * (c + 5) // (n + 5 * v) if v else 0 for c, n, v in rows]


def test_op13_on_documents(spark, docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    got = sorted(map(tuple, queries.op13_source_divergence(spark, SF).collect()))
    assert got == divergence(rows, 30, 50)

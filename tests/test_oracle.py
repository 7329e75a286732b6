"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver entry point."""

import os

import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    yield con
    con.close()


def test_every_listings_query_has_an_oracle():
    from foodgrid.plans import queries as Q
    assert set(Q.REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 22


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="sf0.01 tables not present")
def test_fact_shape_at_sf001(spark):
    """Per-type shape of the fact at sf0.01, as DuckDB counts it: the pick is
    exercised (265 ids are both dessert and cafe) and the county join both
    drops and multiplies rows."""
    from pyspark.sql import functions as F
    from foodgrid.operators import marts
    from foodgrid.plans import queries as Q
    d = "/root/testdata/sf0.01"
    raw = Q.raw(spark, d)
    count = lambda df: {r[0]: tuple(r[1:]) for r in df.collect()}
    assert count(marts.typed_from_raw(raw).groupBy("type").count()) == {
        "desserts": (680,), "cafe": (381,), "restaurants": (766,)}
    assert count(marts.pick_listings(raw).groupBy("type").count()) == {
        "desserts": (680,), "cafe": (116,), "restaurants": (766,)}
    fact = E.queries()["fact_all"](spark, d)
    assert count(fact.groupBy("type").agg(F.count(F.lit(1)), F.countDistinct("id"))) == {
        "desserts": (587, 454), "cafe": (90, 68), "restaurants": (669, 501)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="sf0.01 tables not present")
def test_every_rule_decides_rows_at_sf001(spark):
    """The derived inputs reach each rule: some rows change, some do not."""
    from pyspark.sql import functions as F
    from foodgrid.functions import columns as C
    from foodgrid.operators import keyterm as K, staging
    from foodgrid.plans import queries as Q
    from foodgrid.sources import adapter as A
    d = "/root/testdata/sf0.01"
    h = A.search_hits(spark, d).withColumn("text", K.category_titles_text("categories"))
    loc = F.col("location")
    built, lat, lon = C.build_address("location"), F.col("coordinates.latitude"), F.col("coordinates.longitude")
    flags = {
        "zip": ~F.coalesce(loc["zip_code"].startswith("9"), F.lit(False)),
        "city": C.normalize_city("location.city") != F.lower(loc["city"]),
        "none": built.contains("None"), "lstrip": C.lstrip_address(built) != built,
        "one_coordinate": lat.isNull() & lon.isNotNull(), "no_coordinates": lat.isNull() & lon.isNull()}
    flags |= {f"drop {p}": F.col("text").rlike(p) for p in K.KEYTERM_DROP}
    for i, (pats, name, _) in enumerate(K.KEYTERM_RULES):
        if pats == ["American (Traditional)"]:   # a regular expression that its own text never matches
            continue
        cond = F.lit(True)
        for p in pats:
            cond = cond & F.col("text").rlike(p)
        flags[f"keyterm {i}"] = cond & (F.col("name").rlike(name) if name else F.lit(True))
    seen = h.agg(*[F.count_if(c).alias(n) for n, c in flags.items()], F.count(F.lit(1)).alias("all")).first().asDict()
    total = seen.pop("all")
    assert {n: v for n, v in seen.items() if not 0 < v < total} == {}

    raw = Q.raw(spark, d)
    sweets, cafes = staging.stg_desserts(raw), staging.stg_cafes(raw)
    cats = F.col("categories")
    flags = {p: cats.like(p) for p in C.DESSERT_EXCLUDED_LIKE} | {
        "exact": cats == C.DESSERT_EXCLUDED_EXACT, "alias": F.col("alias").like(C.DESSERT_EXCLUDED_ALIAS_LIKE)}
    seen = sweets.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(flags.values())]).first()
    assert [p for p, n in zip(flags, seen) if n == 0] == []
    rules = []
    for pats, name, single in C.CAFE_RULES:
        cond = F.lower("name").like(name) if name else F.lit(True)
        for p in pats:
            cond = cond & cats.like(p)
        rules.append(cond & (F.size(F.split(cats, ",")) == 1) if single else cond)
    seen = cafes.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(rules)]).first()
    assert all(seen) and cafes.filter(~C.cafe_keep("categories", "name")).count() > 0
    ties = raw.groupBy("id", "review_count").agg(
        F.count_distinct("url").alias("u"), F.count_distinct(F.coalesce("price", F.lit(""))).alias("p"),
        F.count_distinct("address").alias("a")).agg(F.max("u"), F.max("p"), F.max("a")).first()
    assert min(ties) > 1

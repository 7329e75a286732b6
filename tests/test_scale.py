"""What keeps a task's memory and the bytes moved small: plans and files, on small inputs."""

import contextlib
import glob
import gzip
import json
import os
import re
import time

from pyspark.sql import functions as F

from foodgrid import session
from foodgrid.operators import clean, staging
from foodgrid.plans import queries as Q
from foodgrid.sinks import keyed, writers
from foodgrid.sinks.ledger import LedgeredTable, by_folder
from foodgrid.sources import adapter as A

SF = "/root/testdata/sf0.001"


def _wide_sorts(plan):
    """Sorts between the hits' join and the first aggregate above it."""
    lines = [x.strip(" :+-*()0123456789") for x in plan.splitlines()]
    join = next(i for i, x in enumerate(lines) if x.startswith("SortMergeJoin") and "l_width" in x)
    below = max(i for i, x in enumerate(lines[:join]) if "partial_min" in x)
    return [x for x in lines[below:join] if x.startswith("Sort [")]


def test_a_pick_by_id_does_not_sort_the_widened_hits(spark):
    for name in ("fact_all", "dedup_by_id", "insert_if_absent"):
        plan = Q.REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert _wide_sorts(plan) == [], name


def test_the_hits_of_a_hot_business_are_split(spark, tmp):
    for t in ("part", "lineitem"):
        rows = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "lineitem":
            rows = rows.crossJoin(spark.range(20).select(F.col("id").alias("copy"))).withColumn(
                "l_partkey", F.expr("if(copy % 3 = 0, 7L, l_partkey)")).drop("copy").repartition(8)
        rows.write.parquet(f"{tmp}/{t}.parquet")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        picked = staging.first_per_key(A.search_hits(spark, tmp).select("id", "name", "review_count", "url"), "id",
                                       [staging.desc("review_count"), staging.asc("url")])
        rows = picked.collect()
        plan = picked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan and len(rows) == len({r["id"] for r in rows})


def test_raw_rows_are_not_sorted_by_feed(spark, tmp):
    from foodgrid.schemas import RAW
    kinds = {f.name: f.dataType for f in RAW.fields}
    rows = spark.range(500).select(*[(F.concat(F.lit("f"), F.col("id") % 5) if c == "feed" else
                                      F.lit("x") if k.simpleString() == "string" else
                                      F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
    rows = rows.withColumns({c: F.lit(1).cast(kinds[c]) for c in writers.RAW_REQUIRED if c not in ("feed",)
                             and kinds[c].simpleString() != "string"})
    key, was = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    seen, writer = [], writers._raw_writer
    writers._raw_writer = lambda df: (seen.append(spark.conf.get(key)), writer(df))[1]
    try:
        writers.append_raw(rows, f"{tmp}/raw")
    finally:
        writers._raw_writer = writer
    assert int(seen[0]) > 5 and spark.conf.get(key) == was
    back = spark.read.schema(RAW).parquet(f"{tmp}/raw")
    assert back.groupBy("feed").count().filter("count = 100").count() == 5


HITS = ("id string, name string, n long, x double, tags array<struct<a:string,b:string>>, "
        "at struct<p:string,q:double>, term string, location_index int")


def test_landing_as_text_and_gzip_keeps_every_value(spark, tmp):
    hits = spark.createDataFrame(
        [("a", 'q"\\\né', 2**53 + 1, 0.1, [("1", None)], (None, -0.0), "Food", 1),
         ("b", None, None, float("nan"), [], None, "Food", 1), ("c", "", -1, 1e300, None, ("p", None), None, 2),
         ("c", "", -1, 1e300, None, ("p", None), None, 2)], HITS)
    writers.write_landing(hits, f"{tmp}/z", compression="gzip")
    writers.write_landing(hits, f"{tmp}/plain")
    found = glob.glob(f"{tmp}/z/**/part-*", recursive=True)
    assert found and all(f.endswith(".json.gz") for f in found)
    lines = sorted(x for f in found for x in gzip.open(f, "rt", encoding="utf-8").read().splitlines())
    plain = sorted(x for f in glob.glob(f"{tmp}/plain/**/part-*", recursive=True)
                   for x in open(f, encoding="utf-8").read().splitlines())
    want = sorted(r[0] for r in hits.select(F.to_json(F.struct(*hits.columns[:-2]))).collect())
    assert lines == plain == want and json.loads(want[0])["n"] == 2**53 + 1


def test_landing_keeps_types_that_json_text_does_not_tell(spark, tmp):
    hits = spark.sql("select map(1, 'x') as m, date'2024-01-02' as d, 'Food' as term, 1 as location_index")
    writers.write_landing(hits, tmp + "/m")
    file, = glob.glob(f"{tmp}/m/**/part-*.json", recursive=True)
    assert json.loads(open(file).read()) == {"m": {"1": "x"}, "d": "2024-01-02"}


def test_landing_queries_write_compressed_files(spark, monkeypatch):
    made = []
    shared = Q.shared_folder
    monkeypatch.setattr(Q, "shared_folder", lambda s, name: made.append(shared(s, name)) or made[-1])
    assert Q.REGISTRY["landing_overwrite"](spark, SF).count() > 0
    assert Q.REGISTRY["append_ledger"](spark, SF).count() > 0
    for folder in [f.removeprefix("file://") for f in made if os.path.basename(f).startswith("landing-")]:
        found = glob.glob(f"{folder}/**/part-*", recursive=True)
        assert found and all(f.endswith(".json.gz") for f in found)


FIRST, ADVISORY = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_shuffle_partitions_grow_with_the_input(spark, monkeypatch):
    def run(name):
        df = Q.REGISTRY[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        return {int(n) for n in re.findall(r"hashpartitioning\(l_id.*?, (\d+)\)", plan)}, \
            sorted(map(str, df.collect()))

    def unset():
        for c in (FIRST, ADVISORY):
            spark.conf.unset(c)

    names = ("fact_all", "listings_all", "restaurants_anti")
    unset()
    try:
        few = {n: run(n) for n in names}
        assert spark.conf.get(FIRST, None) is None   # nothing is set beside a small input
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
        for n in names:
            parts, rows = run(n)
            assert few[n][0] == {4} and min(parts) > 4 and rows == few[n][1], n
        assert spark.conf.get(ADVISORY) == "10000b"
    finally:
        unset()


def test_a_batch_is_not_sorted_to_be_written_by_what_the_filter_says(spark, tmp, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was, seen, read = spark.conf.get(key), [], keyed.seen
    monkeypatch.setattr(keyed, "seen", lambda k: (seen.append(spark.conf.get(key)), read(k))[1])
    table = keyed.KeyedTable(spark, f"{tmp}/keyed", "id string, n long", buckets=2)
    for ids in ("ab", "bc"):
        table.append(spark.createDataFrame([(i, 1) for i in ids], "id string, n long"), [staging.asc("n")])
    assert sorted(r["id"] for r in table.rows().collect()) == ["a", "b", "c"]
    assert [int(n) >= 2 for n in seen] == [True, True] and spark.conf.get(key) == was


SKEWED = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"


@contextlib.contextmanager
def _conf(spark, **values):
    """The settings, and those that ``sized_shuffles`` makes, as they were before."""
    keys = [FIRST, ADVISORY, SKEWED, *values]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_many_configured_partitions_are_not_coalesced_to_wide_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
    with _conf(spark, **{"spark.sql.shuffle.partitions": "200"}):
        Q.REGISTRY["fact_all"](spark, SF)
        assert spark.conf.get(FIRST, None) is None   # 200 are enough
        assert spark.conf.get(ADVISORY) == "10000b" and spark.conf.get(SKEWED) == "40000b"


def test_hits_are_not_sorted_by_city_beside_a_city_list_too_large_to_broadcast(spark):
    names = ("fact_city_join", "fact_county_join", "fact_stepwise", "listings_all", "listings_fused")

    def run(name):
        df = Q.REGISTRY[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString(), sorted(map(str, df.collect()))

    for name in names:
        rows = run(name)[1]
        with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1"}):
            plan, found = run(name)
        assert "Sort [_city" not in plan and "ShuffledHashJoin [_city" in plan, name
        assert rows and found == rows, name


def test_a_hot_city_of_the_hits_is_split(spark):
    cities = spark.range(400).selectExpr("concat('City ', id) as Name")
    hits = spark.range(0, 40_000, 1, 8).selectExpr(
        "id", "named_struct('state', 'CA', 'city', if(id % 3 = 0, 'Hot', concat('City ', id % 500))) as location",
        "sha2(cast(id as string), 512) as wide")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "1", SKEWED: "64k", ADVISORY: "64k", FIRST: "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for listed in (False, True):
        known = cities.unionByName(spark.sql("select 'Hot' as Name")) if listed else cities
        with _conf(spark, **conf):
            kept = clean.keep_known_cities(hits, known)
            n = kept.count()
            ids = kept.agg(F.sum("id"), F.max("wide"))
            ids.collect()
            plan = ids._jdf.queryExecution().executedPlan().toString()
        want = [i for i in range(40_000) if (listed if i % 3 == 0 else i % 500 < 400)]
        assert n == len(want) and ids.first()[0] == sum(want)
        assert "ShuffledHashJoin(skew=true)" in plan


def test_hits_are_not_sorted_by_address_and_a_hot_address_is_split(spark):
    known = spark.range(300).selectExpr("concat(id, ' Main St') as address", "cast(id as double) as latitude",
                                        "-cast(id as double) as longitude")
    known = known.unionByName(spark.sql("select 'Hot' as address, 7D as latitude, 8D as longitude"))
    hits = spark.range(0, 40_000, 1, 8).selectExpr(
        "id", "if(id % 7 = 1, 5D, null) as latitude", "cast(null as double) as longitude",
        "if(id % 7 = 2, null, if(id % 3 = 0, 'Hot', concat(id % 400, ' Main St'))) as address",
        "sha2(cast(id as string), 512) as wide")
    keys = ["id", "latitude", "longitude", "address"]
    want = clean.fill_coordinates(hits, known)
    assert "SortMergeJoin" not in want._jdf.queryExecution().executedPlan().toString()   # broadcast
    conf = {"spark.sql.autoBroadcastJoinThreshold": "1", SKEWED: "64k", ADVISORY: "64k", FIRST: "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    rows = sorted(map(str, want.select(*keys).collect()))
    with _conf(spark, **conf):
        filled = clean.fill_coordinates(hits, known)
        assert sorted(map(str, filled.select(*keys).collect())) == rows
        ids = filled.agg(F.sum("id"), F.max("wide"), F.sum("latitude"))
        assert ids.collect()[0][0] == sum(range(40_000))
        plan = ids._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    joins = [x for x in final.splitlines() if "LeftOuter" in x]
    assert joins and all("ShuffledHashJoin(skew=true) [address" in x for x in joins)


def test_hits_are_not_sorted_by_address_in_the_fact_queries(spark):
    for name in ("fact_county_join", "fact_stepwise", "listings_all"):
        rows = sorted(map(str, Q.REGISTRY[name](spark, SF).collect()))
        with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1"}):
            df = Q.REGISTRY[name](spark, SF)
            plan = df._jdf.queryExecution().executedPlan().toString()
            found = sorted(map(str, df.collect()))
        joins = [x for x in plan.splitlines() if "LeftOuter" in x]
        assert joins and all("ShuffledHashJoin [address" in x for x in joins), name
        assert rows and found == rows, name


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files made since ``before`` that are still there; their removal is not waited for by Spark."""
    for _ in range(40):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    return left


def test_shuffle_files_of_a_landing_and_a_load_do_not_stay(spark, tmp):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(key)
    hits = spark.range(0, 3000, 1, 8).selectExpr("concat(if(id % 2 = 0, 'a', 'b'), id) as id", "repeat('x', 50) as name",
                                                 "'Food' as term", "cast(id % 5 as int) as location_index")
    writers.write_landing(hits, f"{tmp}/land")
    assert _left(spark, before) == set()
    table = LedgeredTable(spark, f"{tmp}/raw", "id string, name string, feed string", by_folder, ("id",))
    read = lambda paths: spark.read.schema("id string, name string").json(paths).select(
        "*", F.col("_metadata.file_path").alias("file_path"))
    before = _shuffle_files(spark)
    assert table.load(f"{tmp}/land", read, lambda h: h.repartition(3, "id").withColumn("feed", F.substring("id", 1, 1))) == 5
    assert _left(spark, before) == set()
    assert table.rows().count() == 3000 and spark.conf.get(key) == was


def test_a_large_landing_is_dealt_in_rounds_of_whole_pairs(spark, tmp, monkeypatch):
    rows = [(f"{t}{i}", "é" if i % 7 else None, t, i % 6 or None) for t in ("Food", "Coffee & Tea", None) for i in range(300)]
    hits = spark.createDataFrame(rows, "id string, name string, term string, location_index int")
    writers.write_landing(hits, f"{tmp}/one")
    dealt, made, texts = [], [], {}
    deal, shared = writers._dealt, writers.shared_folder
    monkeypatch.setattr(writers, "_dealt", lambda h, *a: (dealt.append({tuple(r) for r in h.select(*writers.PAIR).collect()}),
                                                          deal(h, *a))[1])
    monkeypatch.setattr(writers, "shared_folder", lambda s, name: made.append(shared(s, name)) or made[-1])
    monkeypatch.setattr(writers, "ROUND_BYTES", 1000)
    writers.write_landing(spark.createDataFrame([("old", "o", "Food", 1)], hits.schema), f"{tmp}/rounds")
    dealt.clear()
    writers.write_landing(hits, f"{tmp}/rounds")
    for folder in ("one", "rounds"):
        texts[folder] = {os.path.dirname(f.removeprefix(f"{tmp}/{folder}/")): sorted(open(f, encoding="utf-8"))
                         for f in glob.glob(f"{tmp}/{folder}/**/part-*", recursive=True)}
    assert texts["one"] == texts["rounds"] and len(texts["one"]) == 18
    assert 1 < len(dealt) <= writers.ROUNDS and sum(map(len, dealt)) == len(set().union(*dealt)) == 18
    assert made and not any(os.path.exists(f.removeprefix("file://")) for f in made)


def test_stored_hits_are_not_shuffled_by_city(spark, monkeypatch):
    cities = spark.range(3000).selectExpr("if(id % 10 = 0, null, concat('City ', id % 1500)) as Name")
    hits = spark.range(0, 30_000, 1, 8).selectExpr(
        "id", "named_struct('state', if(id % 11 = 0, 'NV', 'CA'), 'city', case when id % 3 = 0 then 'City 7' "
        "when id % 17 = 0 then null when id % 13 = 0 then concat('city ', id % 1500) "
        "else concat('City ', id % 9000) end) as location", "sha2(cast(id as string), 512) as wide")
    want = sorted(r["id"] for r in clean.keep_known_cities(hits, cities).select("id").collect())
    assert 10_000 < len(want) < 30_000
    with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1"}):
        kept = clean.keep_known_cities(hits, cities, narrow=True)
        assert kept.columns == hits.columns and sorted(r["id"] for r in kept.select("id").collect()) == want
        wide = kept.agg(F.max("wide"))
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "wide" in plan and not [x for x in plan.splitlines() if "Exchange hashpartitioning(_city" in x]
        assert [x for x in plan.splitlines() if "BroadcastHashJoin [block" in x]
        for names, all_ in ((cities.filter("Name = 'none'"), []), (cities.limit(0), [])):
            assert clean.keep_known_cities(hits, names, narrow=True).collect() == all_
        monkeypatch.setattr(clean, "MOST_NAMES", 10)
        many = clean.keep_known_cities(hits, cities, narrow=True)
        assert "ShuffledHashJoin [_city" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["id"] for r in many.select("id").collect()) == want


def test_ledger_query_beside_a_city_list_too_large_to_broadcast(spark, monkeypatch):
    rows = sorted(map(str, Q.REGISTRY["append_ledger"](spark, SF).collect()))
    plans, raw_rows = [], Q.pipeline.raw_rows

    def kept(*a, **k):
        out = raw_rows(*a, **k)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(Q.pipeline, "raw_rows", kept)
    with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "1"}):
        found = sorted(map(str, Q.REGISTRY["append_ledger"](spark, SF).collect()))
    assert rows and found == rows and len(plans) == 2
    assert not [p for p in plans if "hashpartitioning(_city" in p]

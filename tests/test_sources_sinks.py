"""Sources and sinks on file fixtures."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foodgrid.operators.dedup import asc
from foodgrid.sinks import writers
from foodgrid.sources import files, search
from tests import fixtures as FX


def test_city_csv_positions_and_non_ascii(spark, tmp):
    p = FX.write(tmp, "cities.csv", FX.CITY_CSV)
    rows = files.read_city_locations(spark, p).orderBy("position").collect()
    assert [r["Name"] for r in rows][:3] == ["San Jose", "Torrance", "La Cañada Flintridge"]
    assert [r["position"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0]["Latitude"] == pytest.approx(37.3382082)
    sl = search.location_slice(files.read_city_locations(spark, p), 1, 3)
    assert sorted(r["Name"] for r in sl.collect()) == ["La Cañada Flintridge", "Torrance"]
    st = search.location_stride(files.read_city_locations(spark, p), 2)
    assert sorted(r["position"] for r in st.collect()) == [0, 2, 4]


def test_missing_csv_raises(spark, tmp):
    with pytest.raises(AnalysisException):
        files.read_city_locations(spark, os.path.join(tmp, "nope.csv"), position=False).count()


def test_county_csv_typed(spark, tmp):
    p = FX.write(tmp, "counties.csv", FX.COUNTY_CSV)
    df = files.read_county_cities(spark, p)
    types = dict(df.dtypes)
    assert types["Zip"] == "string" and types["Entity ID"] == "bigint"
    assert df.filter(F.col("City") == "Torrance").count() == 2


def test_landing_scan_names_and_missing_price(spark, tmp):
    FX.write_landing_file(tmp, "Coffee & Tea", "Carmel-By-the-Sea", 3,
                          [FX.biz("a", ["coffee"], with_price=False)])
    FX.write_landing_file(tmp, "Restaurants", "San Jose", 0,
                          [FX.biz("b", ["pizza"]), FX.biz("c", ["thai"])])
    FX.write_landing_file(tmp, "Desserts", "Torrance", 1, [])
    df = files.read_landing(spark, tmp)
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"]["term"] == "Coffee & Tea"
    assert rows["a"]["search_location"] == "Carmel-By-the-Sea"
    assert rows["a"]["location_index"] == 3
    assert rows["a"]["price"] is None and rows["b"]["price"] == "$$"


def test_write_landing_replaces_only_its_pair(spark, tmp):
    path = os.path.join(tmp, "landing")
    hits = spark.createDataFrame(
        [("a", "Food", 0), ("b", "Food", 1), ("c", "Desserts", 0)],
        "id string, term string, location_index int")
    writers.write_landing(hits, path)
    again = spark.createDataFrame([("z", "Food", 0)], "id string, term string, location_index int")
    writers.write_landing(again, path)
    back = spark.read.json(path).select("id", "term", "location_index")
    assert sorted((r[0], r[1], r[2]) for r in back.collect()) == [
        ("b", "Food", 1), ("c", "Desserts", 0), ("z", "Food", 0)]


def test_encode_ndjson_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, 1.5)], "id string, price string, rating double")
    line = writers.encode_ndjson(df).first()["value"]
    assert json.loads(line) == {"id": "a", "price": None, "rating": 1.5}


def test_request_plan_shape(spark):
    locs = spark.createDataFrame([("A", 1.0, 2.0, 0), ("B", 3.0, 4.0, 1)],
                                 "Name string, Latitude double, Longitude double, position long")
    plan = search.request_plan(locs, terms=["Food", "Desserts"])
    assert plan.count() == 2 * 2 * 20
    offs = sorted({r["offset"] for r in plan.collect()})
    assert offs[0] == 0 and offs[-1] == 950 and len(offs) == 20
    assert plan.first()["radius"] == 10000 and plan.first()["limit"] == 50


def test_page_assembly_rules(spark):
    b = lambda i: [FX.biz(f"{i}-{k}", ["pizza"]) for k in range(2)]
    pages = []
    # pair (Food, 0): empty page at offset 100 stops it though 150 has rows.
    pages += [("Food", 0, 0, b("f0")), ("Food", 0, 50, b("f50")), ("Food", 0, 100, []),
              ("Food", 0, 150, b("f150"))]
    # pair (Food, 1): 21 full pages; the page at offset 1000 is beyond the cap.
    pages += [("Food", 1, o, b(f"g{o}")) for o in range(0, 1050, 50)]
    from foodgrid.schemas import LANDED_PAGE
    df = spark.createDataFrame(pages, LANDED_PAGE)
    out = search.assemble_pages(df)
    by_pair = {}
    for r in out.collect():
        by_pair.setdefault((r["term"], r["location_index"]), []).append(r["offset"])
    assert sorted(set(by_pair[("Food", 0)])) == [0, 50]
    assert max(by_pair[("Food", 1)]) == 950 and len(by_pair[("Food", 1)]) == 40


def test_json_parse(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "not json")], "id int, props string")
    out = files.parse_json_columns(df, {"props": "struct<k:bigint>"}).orderBy("id").collect()
    assert out[0]["props"]["k"] == 5 and (out[1]["props"] is None or out[1]["props"]["k"] is None)


def test_insert_if_absent_first_arrival_wins(spark):
    target = spark.createDataFrame([("a", "old")], "id string, v string")
    batch = spark.createDataFrame([("a", "new", 1), ("b", "second", 2), ("b", "first", 1)],
                                  "id string, v string, arrival int")
    new = writers.insert_if_absent(target, batch, [asc("arrival")], columns=["id", "v"])
    assert sorted(tuple(r) for r in new.collect()) == [("b", "first")]


def test_append_if_absent_on_table(spark, tmp):
    path = os.path.join(tmp, "t")
    spark.createDataFrame([("a", "old", 0)], "id string, v string, arrival int") \
        .write.parquet(path)
    batch = spark.createDataFrame([("a", "x", 1), ("c", "y", 2)], "id string, v string, arrival int")
    writers.append_if_absent(path, batch, [asc("arrival")])
    writers.append_if_absent(path, batch, [asc("arrival")])   # rerun adds nothing
    rows = sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect())
    assert rows == [("a", "old"), ("c", "y")]


def test_required_columns_raise(spark, tmp):
    from foodgrid.schemas import RAW
    bad = spark.createDataFrame([(None, "a", "n")], "id string, alias string, name string")
    bad = bad.select(*[F.col(f.name) if f.name in bad.columns else
                       F.lit(None).cast(f.dataType).alias(f.name) for f in RAW.fields])
    with pytest.raises(Exception, match="NULL in required column id"):
        writers.append_raw(bad.withColumn("feed", F.lit("Food")), os.path.join(tmp, "raw"))


def test_page_assembly_flat_form_matches_nested(spark):
    from foodgrid.schemas import LANDED_PAGE
    b = lambda i, n: [FX.biz(f"{i}-{k}", ["pizza"]) for k in range(n)]
    pages = [("Food", 0, 0, b("a", 2)), ("Food", 0, 50, []), ("Food", 0, 100, b("c", 1)),
             ("Food", 1, 0, b("d", 3)), ("Food", 1, 1000, b("e", 1))]
    nested = spark.createDataFrame(pages, LANDED_PAGE)
    flat = nested.select("term", "location_index", "offset",
                         F.explode_outer("businesses").alias("b")).select(
        "term", "location_index", "offset", "b.*")
    want = sorted(r["id"] for r in search.assemble_pages(nested).collect())
    got = sorted(r["id"] for r in search.assemble_page_rows(flat).collect())
    assert got == want == ["a-0", "a-1", "d-0", "d-1", "d-2"]


def test_positions_exact_across_many_splits(spark, tmp):
    lines = ["Name,Latitude,Longitude"] + [f"City{i},{i / 10},{-i / 10}" for i in range(3000)]
    p = FX.write(tmp, "many.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.read_city_locations(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r["position"] for r in rows) == list(range(3000))
    assert all(r["Name"] == f"City{r['position']}" for r in rows)

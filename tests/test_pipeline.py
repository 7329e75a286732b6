"""End to end on a landing fixture, plus the invariants of the models."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foodgrid.operators import keyterm, marts, quality, staging
from foodgrid.operators.dedup import first_per_key
from foodgrid.plans import pipeline
from foodgrid.sinks import writers
from foodgrid.sources import files
from tests import fixtures as FX

B = FX.biz


def landing(tmp):
    d = os.path.join(tmp, "landing")
    FX.write_landing_file(d, "Restaurants", "San Jose", 0, [
        B("r1", ["pizza", "italian"], review_count=5),
        B("r2", ["pizza", "grocery"]),                      # allowed + denied
        B("r3", ["gyms"]),                                  # not food
        B("r4", ["thai", "mexican"], city="San  Jose"),     # raw city not in list
        B("r5", ["burgers"], state="NV"),
        B("r6", ["tacos"], lat=None, lon=None, address1="9 Elm St"),
        B("r7", ["tacos"], lat=None, address1="8 Elm St"),  # only one missing
        B("r8", ["restaurants"], address1=None),
        B("r9", ["thai"], city="Torrance", address2="Ste 5", zip_code="90501"),
        B("r10", ["thai"], city="Fresno"),
    ])
    FX.write_landing_file(d, "Food", "Torrance", 1, [
        B("r1", ["pizza", "italian"], review_count=50),    # same id, more reviews
        B("f1", ["coffee"], city="Torrance", with_price=False),
    ])
    FX.write_landing_file(d, "Coffee & Tea", "Oakland", 4, [
        B("c1", ["coffee"], name="Blue Cafe", city="La Cañada Flintridge"),
        B("c2", ["pizza", "tea"], city="Oakland"),          # no county row
        B("r1", ["coffee", "desserts"]),                    # also a cafe
    ])
    FX.write_landing_file(d, "Desserts", "La Cañada Flintridge", 2, [
        B("d1", ["desserts", "icecream"], city="La Cañada Flintridge"),
        B("d2", ["coffee"], alias="x"),                     # exactly 'coffee'
        B("d3", ["desserts"], alias="pho"),
        B("c1", ["desserts", "coffee"], city="La Cañada Flintridge"),
    ])
    FX.write_landing_file(d, "Bakeries", "Torrance", 1, [])
    return d


@pytest.fixture()
def world(spark, tmp):
    cities = files.read_city_locations(spark, FX.write(tmp, "cities.csv", FX.CITY_CSV))
    counties = files.read_county_cities(spark, FX.write(tmp, "counties.csv", FX.COUNTY_CSV))
    gaz = spark.createDataFrame([("9 Elm St, San Jose CA 95112", 37.1, -121.1),
                                 ("8 Elm St, San Jose CA 95112", 30.0, -100.0)],
                                "address string, latitude double, longitude double")
    hits = files.read_landing(spark, landing(tmp))
    raw = pipeline.raw_rows(hits, cities, gazetteer=gaz, passthrough=["location_index"])
    return dict(cities=cities, counties=counties, gaz=gaz, hits=hits, raw=raw, tmp=tmp)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_cleaning_cases(world):
    raw = {r["id"]: r for r in world["raw"].filter(F.col("feed") == "Restaurants").collect()}
    assert set(raw) == {"r1", "r6", "r7", "r8", "r9"}
    assert raw["r1"]["ethnic_category"] == ["italian"] and raw["r8"]["ethnic_category"] == ["Not Specified"]
    assert (raw["r6"]["latitude"], raw["r6"]["longitude"]) == (37.1, -121.1)   # filled
    assert raw["r7"]["latitude"] is None and raw["r7"]["longitude"] == -121.9  # untouched
    assert raw["r8"]["address"] == "None, San Jose CA 95112"
    assert raw["r9"]["address"] == "1 Main St Ste 5, Torrance CA 90501"
    assert raw["r1"]["city"] == "san jose"
    food = {r["id"]: r for r in world["raw"].filter(F.col("feed") == "Food").collect()}
    assert food["f1"]["price"] is None


def test_fact_end_to_end(world):
    fact = pipeline.build_fact(world["raw"], world["cities"], world["counties"])
    assert fact.columns == marts.FACT_COLUMNS
    got = rows(fact, "id", "type", "county_zipcode")
    assert got == sorted([
        ("c1", "desserts", "91011"),        # dessert beats cafe
        ("d1", "desserts", "91011"),
        ("f1", "restaurants", "90501"), ("f1", "restaurants", "90503"),   # Torrance twice
        ("r1", "cafe", "95112"),            # cafe row excludes the restaurant row
        ("r6", "restaurants", "95112"), ("r7", "restaurants", "95112"),
        ("r8", "restaurants", "95112"),
        ("r9", "restaurants", "90501"), ("r9", "restaurants", "90503"),
    ])
    r1 = fact.filter("id = 'r1'").first()
    assert r1["categories"] == "coffee, desserts" and r1["city_city"] == "san jose"
    assert str(r1["rating"]) == "4.500000000"
    assert r1["shop_coordinate"] == "37.3,-121.9"


def test_fused_equals_stepwise(world):
    raw, cities, counties = world["raw"], world["cities"], world["counties"]
    fused = pipeline.build_fact(raw, cities, counties)
    step = marts.fact_stepwise(staging.stg_restaurants(raw), staging.stg_cafes(raw),
                               staging.stg_desserts(raw), marts.dim_coordinates(cities),
                               marts.dim_counties(counties))
    assert rows(fused, *marts.FACT_COLUMNS) == rows(step, *marts.FACT_COLUMNS)


def test_staging_dedup_picks_most_reviews(world):
    r = staging.stg_restaurants(world["raw"])
    r1 = r.filter("id = 'r1'").collect()
    assert len(r1) == 1 and r1[0]["review_count"] == 50
    assert r.groupBy("id").count().filter("count > 1").count() == 0


def test_append_twice_then_stage_equals_once(spark, world):
    p1, p2 = os.path.join(world["tmp"], "raw1"), os.path.join(world["tmp"], "raw2")
    out = world["raw"].drop("location_index")
    writers.append_raw(out, p1)
    writers.append_raw(out, p2)
    writers.append_raw(out, p2)
    once, twice = files.read_raw(spark, p1), files.read_raw(spark, p2)
    assert twice.count() == 2 * once.count()
    cols = staging.STAGING_COLUMNS
    for fn in (staging.stg_restaurants, staging.stg_cafes, staging.stg_desserts):
        assert rows(fn(once), *cols) == rows(fn(twice), *cols)
    pruned = files.read_raw(spark, p1, feeds=["Coffee"])
    assert {r["feed"] for r in pruned.collect()} == {"Coffee"}


def test_restaurants_disjoint_from_exclusion(world):
    raw = world["raw"]
    d = marts.desserts_filtered(staging.stg_desserts(raw))
    c = marts.cafes_filtered(staging.stg_cafes(raw))
    r = marts.restaurants_anti(staging.stg_restaurants(raw), marts.exclusion_ids(d, c))
    assert r.join(marts.exclusion_ids(d, c), "id").count() == 0
    assert {x["id"] for x in d.collect()} == {"c1", "d1"}      # d2 'coffee', d3 'pho' excluded


def test_dedup_idempotent_and_window_agrees(world):
    typed = world["raw"].select(*staging.staged_columns(world["raw"]))
    once = first_per_key(typed, "id", staging.STAGING_ORDER)
    twice = first_per_key(once, "id", staging.STAGING_ORDER)
    sort = [F.col("review_count").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in staging.STAGING_COLUMNS if c not in ("id", "review_count")]
    win = typed.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(*sort))).filter("n = 1")
    cols = staging.STAGING_COLUMNS
    assert rows(once, *cols) == rows(twice, *cols) == rows(win, *cols)


def test_data_tests_severity(world):
    raw = world["raw"]
    assert quality.assert_unique(raw, "id", "warn").count() > 0
    with pytest.raises(AssertionError):
        quality.assert_unique(raw, "id", "error")
    assert quality.assert_not_null(staging.stg_cafes(raw), "id", "error").count() == 0


def test_load_counts_running_total(world):
    h = world["hits"]
    out = quality.load_counts(h, ["Restaurants", "Food", "Coffee & Tea", "Desserts", "Bakeries"])
    got = rows(out, "term", "location_index", "row_count", "total_rows")
    order = {"Restaurants": 0, "Food": 1, "Coffee & Tea": 2, "Desserts": 3}
    got.sort(key=lambda t: order[t[0]])
    assert [g[2] for g in got] == [10, 2, 3, 4]
    assert [g[3] for g in got] == [10, 12, 15, 19]


def test_keyterm_rules(spark):
    data = [("Bars, Juice Bars", "x"), ("Vietnamese, Juice Bars, Bubble Tea", "x"),
            ("Vietnamese", "Pho 1"), ("American (Traditional)", "x"),
            ("Wineries, Burgers", "x"), ("Grocery, Bakeries", "x"), ("Bakeries", "x")]
    df = spark.createDataFrame(data, "t string, n string")
    out = df.filter(keyterm.keyterm_keep("t")).select(
        "t", keyterm.keyterm_label("t", "n").alias("k"), keyterm.cat_len("t").alias("l")).collect()
    got = {r["t"]: (r["k"], r["l"]) for r in out}
    assert "Grocery, Bakeries" not in got
    assert got["Bars, Juice Bars"][0] == "Desserts/Teas/Cafes/Bakeries"    # later rule wins
    assert got["Vietnamese, Juice Bars, Bubble Tea"] == ("Desserts/Teas/Cafes/Bakeries", 3)
    assert got["Vietnamese"][0] == "Restaurants"
    assert got["American (Traditional)"][0] == "Desserts/Teas/Cafes/Bakeries"  # regex group
    assert got["Wineries, Burgers"][0] == "Attractions"
    assert got["Bakeries"] == ("Desserts/Teas/Cafes/Bakeries", 1)


def test_empty_inputs(spark, world):
    empty = world["hits"].limit(0)
    raw = pipeline.raw_rows(empty, world["cities"])
    assert raw.count() == 0
    assert pipeline.build_fact(raw, world["cities"], world["counties"]).count() == 0


def test_unnest_and_limit(world):
    r = staging.stg_restaurants(world["raw"])
    un = staging.unnest_categories(r)
    assert un.filter("id = 'r1'").count() == 2
    assert [x["id"] for x in staging.stg_restaurants(world["raw"], limit=2).collect()] == ["f1", "r1"]


def test_jobs_ingest_and_model(spark, tmp):
    from foodgrid.plans import jobs
    land = landing(tmp)
    cities = FX.write(tmp, "cities.csv", FX.CITY_CSV)
    counties = FX.write(tmp, "counties.csv", FX.COUNTY_CSV)
    raw = os.path.join(tmp, "raw")
    jobs.ingest(spark, land, cities, raw, counts=os.path.join(tmp, "counts"))
    counts = spark.read.parquet(os.path.join(tmp, "counts"))
    assert counts.agg(F.max("total_rows")).first()[0] == files.read_raw(spark, raw).count()
    from foodgrid.sources import search
    assert counts.count() == 5 * len(search.SEARCH_TERMS)       # the whole plan, by default
    out = jobs.model(spark, raw, cities, counties, os.path.join(tmp, "models"))
    fact = spark.read.parquet(out["fact_all"])
    assert fact.count() == 10 and spark.table("stg_cafes").count() > 0
    capped = jobs.model(spark, raw, cities, counties, os.path.join(tmp, "dev"), dev_limit=2)
    views = [spark.table(v).select("id") for v in ("stg_restaurants", "stg_cafes", "stg_desserts")]
    seen = {r["id"] for v in views for r in v.collect()}
    assert {r["id"] for r in spark.read.parquet(capped["fact_all"]).collect()} <= seen and len(seen) <= 6
    jobs.copy_reference_files(spark, cities, counties, os.path.join(tmp, "lake"))
    assert spark.read.option("header", True).csv(os.path.join(tmp, "lake", "city_locations")).count() == 5


def test_jobs_with_ledger_and_versions(spark, tmp):
    from foodgrid.plans import jobs
    from foodgrid.sinks.versions import VersionedTable
    land = landing(tmp)
    cities = FX.write(tmp, "cities.csv", FX.CITY_CSV)
    counties = FX.write(tmp, "counties.csv", FX.COUNTY_CSV)
    raw, plain = os.path.join(tmp, "ledgered"), os.path.join(tmp, "raw")
    n = jobs.ingest_new(spark, land, cities, raw)
    assert n == 5 and jobs.ingest_new(spark, land, cities, raw) == 0
    jobs.ingest(spark, land, cities, plain)
    text = lambda df: sorted(str(r) for r in df.collect())
    rows = jobs.raw_ledger(spark, raw).rows()
    assert text(rows.drop("batch")) == text(files.read_raw(spark, plain).select(rows.drop("batch").columns))
    out = jobs.model(spark, raw, cities, counties, os.path.join(tmp, "models"), ledger=True, versions=True)
    other = jobs.model(spark, plain, cities, counties, os.path.join(tmp, "plain"))
    for name in out:
        table = VersionedTable(spark, out[name])
        assert text(table.read()) == text(spark.read.parquet(other[name]))


def test_the_seven_category_sets(spark):
    from foodgrid.functions import taxonomy as TX
    nonfood = spark.createDataFrame([("grocery",), ("convenience",), ("drugstores",), ("gyms",)], "alias string")
    sets = {}
    for r in TX.taxonomy_table(spark, nonfood=nonfood).collect():
        sets.setdefault(r["set_name"], set()).add(r["alias"])
    assert set(sets) == set(TX.SETS)
    assert [len(sets[s]) for s in ("definitely_no", "food_and_bars", "food", "bars", "ethnicities")] == [3, 211, 192, 21, 104]
    assert sets["all"] == sets["food_and_bars"] | sets["nonfood"] and not sets["food_and_bars"] & sets["nonfood"]
    assert sets["definitely_no"] <= sets["nonfood"] and sets["ethnicities"] <= sets["food_and_bars"]
    assert sets["food"] | sets["bars"] == sets["food_and_bars"] | {"winebars"}
    assert sets["food"] & sets["bars"] == {"winebars"}
    df = spark.createDataFrame([(1, ["pubs", "gyms"]), (2, ["thai", "thai"]), (3, []), (4, None), (5, ["never seen"]),
                                (6, ["winebars", None])], "id int, categories array<string>")
    flagged = TX.with_class_mask(df, TX.taxonomy_table(spark, nonfood=nonfood))
    got = {r["id"]: {s for s in TX.SETS if r[s]} for r in flagged.select(
        "id", *[TX.meets("class_mask", s).alias(s) for s in TX.SETS]).collect()}
    assert got == {1: {"all", "nonfood", "food_and_bars", "bars"}, 2: {"all", "food_and_bars", "food", "ethnicities"},
                   3: set(), 4: set(), 5: set(), 6: {"food", "bars"}}


def test_ingest_counts_pairs_that_landed_nothing(spark, tmp, monkeypatch):
    from foodgrid import session
    from foodgrid.plans import jobs
    from foodgrid.sources import search
    land, cities = landing(tmp), FX.write(tmp, "cities.csv", FX.CITY_CSV)
    raw, path = os.path.join(tmp, "raw"), os.path.join(tmp, "counts")
    monkeypatch.setattr(session, "build_session", lambda *_: spark)
    jobs.main(["ingest", land, cities, raw, "--counts", path])
    got = {(r["term"], r["location_index"]): (r["row_count"], r["total_rows"])
           for r in spark.read.parquet(path).collect()}
    assert set(got) == {(t, i) for t in search.SEARCH_TERMS for i in range(5)}
    total = files.read_raw(spark, raw).count()
    assert got["Bakeries", 1] == (0, total)
    running = 0
    for t in search.SEARCH_TERMS:
        for i in range(5):
            running += got[t, i][0]
            assert got[t, i][1] == running
    assert running == total


def test_older_relational_path(spark, world):
    """Raw 15-column rows with JSON text -> path-backed table -> older clean
    (state + zip prefix, no ethnic column) -> insert-if-absent twice."""
    from foodgrid.operators import clean
    from foodgrid.operators.dedup import asc
    tmp = world["tmp"]
    legacy = writers.legacy_raw_rows(world["hits"])
    assert legacy.columns[:15] == list(writers.LEGACY_RAW_COLUMNS)
    raw_path, out_path = os.path.join(tmp, "legacy_raw"), os.path.join(tmp, "legacy_clean")
    first = writers.insert_if_absent(spark.createDataFrame([], "id string"), legacy,
                                     [asc("term"), asc("location_index")],
                                     columns=list(writers.LEGACY_RAW_COLUMNS))
    first.write.parquet(raw_path)
    stored = files.read_table(spark, raw_path)
    assert stored.count() == stored.select("id").distinct().count()
    cleaned = clean.clean_legacy(stored)
    assert cleaned.columns == list(clean.LEGACY_CLEAN_COLUMNS)
    got = {r["id"]: r for r in cleaned.collect()}
    assert "r5" not in got and "r10" in got          # NV dropped; zip prefix, not city list
    assert got["r1"]["categories"] == '["coffee","desserts"]'   # first arrival: 'Coffee & Tea'
    cleaned.limit(0).write.parquet(out_path)
    for _ in range(2):
        writers.append_if_absent(out_path, clean.clean_legacy(stored), [asc("id")])
    final = spark.read.parquet(out_path)
    assert final.count() == cleaned.count() == final.select("id").distinct().count()


def test_fact_unique_per_id_and_zip(world):
    fact = pipeline.build_fact(world["raw"], world["cities"], world["counties"])
    assert fact.groupBy("id", "county", "county_zipcode").count().filter("count > 1").count() == 0


def test_per_key_picks_are_combined_before_the_shuffle(world):
    """Every per-key pick aggregates map-side (partial) before its exchange,
    so a hot id ships at most one row per map task."""
    import contextlib
    import io
    for df in (staging.stg_restaurants(world["raw"]), marts.pick_listings(world["raw"])):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        ex = plan.index("Exchange hashpartitioning(id")
        assert "partial_min" in plan[ex:], plan          # partial aggregate below the exchange


def test_hot_id_dedup(spark):
    """One id holding a third of all rows: the pick is exact."""
    from foodgrid.operators.dedup import desc
    n = 30000
    rows = [("hot" if i % 3 == 0 else f"id{i}", i % 1000, f"a{i % 7}") for i in range(n)]
    df = spark.createDataFrame(rows, "id string, review_count long, alias string").repartition(8)
    out = {r["id"]: r for r in first_per_key(df, "id", [desc("review_count"), asc_("alias")]).collect()}
    assert out["hot"]["review_count"] == 999 and out["hot"]["alias"] == "a0"
    assert len(out) == 1 + (n - n // 3)


def asc_(c):
    from foodgrid.operators.dedup import asc
    return asc(c)


def test_raw_catalog_table(spark, world):
    out = world["raw"].drop("location_index")
    writers.append_raw_table(out, "raw_t")
    writers.append_raw_table(out, "raw_t")   # rerun duplicates rows
    stored = files.read_raw_table(spark, "raw_t")
    assert stored.count() == 2 * out.count()
    cols = marts.FACT_COLUMNS
    assert rows(pipeline.build_fact(stored, world["cities"], world["counties"]), *cols) == \
        rows(pipeline.build_fact(world["raw"], world["cities"], world["counties"]), *cols)
    pruned = files.read_raw_table(spark, "raw_t", feeds=["Coffee"])
    assert {r["feed"] for r in pruned.collect()} == {"Coffee"}


def test_jobs_with_catalog_table(spark, tmp):
    from foodgrid.plans import jobs
    land = landing(tmp)
    cities = FX.write(tmp, "cities.csv", FX.CITY_CSV)
    counties = FX.write(tmp, "counties.csv", FX.COUNTY_CSV)
    jobs.ingest(spark, land, cities, "raw_jobs_t")
    out = jobs.model(spark, "raw_jobs_t", cities, counties, os.path.join(tmp, "models_t"))
    assert spark.read.parquet(out["fact_all"]).count() == 10


def test_typed_rows_in_one_scan_equal_the_steps(world):
    r = world["raw"]
    d, c = marts.desserts_filtered(staging.stg_desserts(r)), marts.cafes_filtered(staging.stg_cafes(r))
    left = marts.restaurants_anti(staging.stg_restaurants(r), marts.exclusion_ids(d, c))
    steps = marts.typed_union(left, d, c)
    assert rows(marts.typed_from_raw(r), *steps.columns) == rows(steps, *steps.columns)


def test_id_report_of_several_models(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,), (None,)], "id string")
    b = spark.createDataFrame([("x",), ("y",)], "id string")
    got = {r[0]: tuple(r[1:]) for r in quality.id_report({"a": a, "b": b}).collect()}
    assert got == {"a": (1, 2), "b": (0, 0)}
    with pytest.raises(AssertionError):
        quality.assert_ids({"a": a, "b": b}, severity="error")


def test_running_total_across_location_blocks(spark):
    df = spark.createDataFrame([(t, i * 1500) for t in ("B", "A") for i in range(9)],
                               "term string, location_index int")
    out = quality.load_counts(df, ["B", "A"]).collect()
    got = sorted(out, key=lambda r: r["total_rows"])
    assert [(r["term"], r["location_index"]) for r in got] == \
        [(t, i * 1500) for t in ("B", "A") for i in range(9)]
    assert [r["total_rows"] for r in got] == list(range(1, 19))


def test_loaded_if_absent_equals_target_and_new_rows(spark):
    from foodgrid.operators.dedup import asc
    df = spark.createDataFrame([("a", True, 5), ("a", False, 1), ("b", False, 3), ("b", False, 2)],
                               "id string, kept boolean, arrival int")
    got = writers.loaded_if_absent(df, F.col("kept"), [asc("arrival")], columns=["id", "arrival"])
    assert rows(got, "id", "arrival") == [("a", 5), ("b", 2)]


def test_two_phase_pick_equals_the_pick_with_a_hot_id(spark):
    """One id holds a third of the rows; some have no review count at all, some all the same."""
    from foodgrid.schemas import RAW
    rows = []
    for i in range(3000):
        id_ = "hot" if i % 3 == 0 else f"b{i % 40}" if i % 7 else None
        count = None if id_ in ("b1", "b2") or i % 11 == 0 else 5 if id_ == "b3" else i % 9
        rows.append((id_, "a", "n", f"u{i % 13}", count, ["coffee", None][:1 + i % 2], ["x"], 4.5, None if i % 5 else "$",
                     None if i % 17 == 0 else 37.0, -120.0, "sf", "addr", ["Food", "Coffee", "Desserts", "Other"][i % 4]))
    raw = spark.createDataFrame([r for r in rows], T.StructType([T.StructField(f.name, f.dataType) for f in RAW]))
    text = lambda df: sorted(str(r) for r in df.collect())
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            assert text(staging.stage(raw, narrow=True)) == text(staging.stage(raw))
            assert text(marts.pick_listings(raw, narrow=True)) == text(marts.pick_listings(raw))
            assert text(marts.pick_listings(raw.limit(0), narrow=True)) == []
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fill_beside_a_large_gazetteer_shuffles_the_missing_rows_only(spark):
    from foodgrid.operators import clean
    rows = [(i, f"a{i % 50}" if i % 9 else None, None if i % 4 == 0 else 1.0, None if i % 8 == 0 else 2.0) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, address string, latitude double, longitude double")
    gaz = spark.createDataFrame([(f"a{i}", float(i), -float(i)) for i in range(0, 60, 2)] + [("a2", 0.5, 0.5), (None, 9.0, 9.0)]
                                + [("a4", None, 3.0)], "address string, latitude double, longitude double")
    wide = clean.fill_coordinates(df, gaz)
    small = sorted(map(tuple, wide.collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        narrow = clean.fill_coordinates(df, gaz)
        plan = narrow._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, narrow.collect()), key=str) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in plan and "BroadcastExchange" not in plan
    passing = plan[plan.index("Union"):plan.index("SortMergeJoin")]     # the branch of all other rows
    assert "Exchange" not in passing and "Filter" in passing
    want = {}
    for a, x, y in [(f"a{i}", float(i), -float(i)) for i in range(0, 60, 2)]:
        want[a] = (x, y)
    want["a2"], want["a4"] = (0.5, 0.5), (None, 3.0)
    assert small == sorted([(i, a, *(want.get(a, (None, None)) if x is None and y is None else (x, y)))
                            for i, a, x, y in rows], key=str)

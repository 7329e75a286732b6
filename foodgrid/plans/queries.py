"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

All read the benchmark tables through the adapter, so their work grows with
the tables.  Array results are rendered with ``to_json`` so that the
independent SQL oracle can be compared value by value.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import taxonomy as TX
from ..operators import clean, marts, quality, staging
from ..operators import keyterm as K
from ..operators.dedup import asc
from ..schemas import BUSINESS, CITY_LOCATIONS, RAW
from ..session import shared_folder
from ..sinks import writers
from ..sinks.keyed import KeyedTable
from ..sinks.ledger import LedgeredTable, by_folder
from ..sinks.versions import VersionedTable
from ..sources import adapter as A
from ..sources import files, search
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- shared inputs: plans, built anew by every query -------------------------

hits, cities, counties, gazetteer = A.search_hits, A.city_locations, A.county_cities, A.gazetteer


def raw(spark, d):
    """The raw table as the loader would append it (cleaned, with ``feed``),
    coordinates filled from the gazetteer."""
    return pipeline.raw_rows(hits(spark, d), cities(spark, d), gazetteer=gazetteer(spark, d))


def _json_arrays(df: DataFrame) -> DataFrame:
    return df.select(*[F.to_json(F.col(c)).alias(c) if t.startswith("array") else F.col(c)
                       for c, t in df.dtypes])


# --- flagship ---------------------------------------------------------------------

@query("fact_all")
def q_fact_all(spark, d):
    return pipeline.build_fact(raw(spark, d), cities(spark, d), counties(spark, d))


@query("fact_stepwise")
def q_fact_stepwise(spark, d):
    """The typed branches, their pick, then the dimension joins."""
    return marts.fact_from_listings(marts.listings_all(marts.typed_from_raw(raw(spark, d))),
                                    marts.dim_coordinates(cities(spark, d)),
                                    marts.dim_counties(counties(spark, d)))


# --- staging ------------------------------------------------------------------------

@query("stg_restaurants")
def q_stg_restaurants(spark, d):
    return staging.stg_restaurants(raw(spark, d))


@query("stg_cafes")
def q_stg_cafes(spark, d):
    return staging.stg_cafes(raw(spark, d))


@query("stg_desserts")
def q_stg_desserts(spark, d):
    return staging.stg_desserts(raw(spark, d))


@query("dim_coordinates")
def q_dim_coordinates(spark, d):
    """O27."""
    return marts.dim_coordinates(cities(spark, d))


@query("dim_counties")
def q_dim_counties(spark, d):
    """O28."""
    return marts.dim_counties(counties(spark, d))


@query("clean_all")
def q_clean_all(spark, d):
    return _json_arrays(raw(spark, d))


# --- sources ------------------------------------------------------------------------

DECLARED_FEEDS = staging.RESTAURANT_FEEDS + staging.CAFE_FEEDS + staging.DESSERT_FEEDS


@query("raw_scan")
def q_raw_scan(spark, d):
    """The four declared sources of the raw table."""
    return _json_arrays(staging.select_feeds(raw(spark, d), DECLARED_FEEDS))


@query("json_parse")
def q_json_parse(spark, d):
    """JSON text -> typed struct (events.props)."""
    ev = A.table(spark, d, "events").select("event_id", "event_type", "props")
    parsed = files.parse_json_columns(ev, {"props": "struct<k:bigint>"})
    return parsed.select("event_id", "event_type", F.col("props.k").alias("k"))


@query("request_plan")
def q_request_plan(spark, d):
    """S8 over the full location list."""
    return search.request_plan(A.search_locations(spark, d))


@query("location_slice")
def q_location_slice(spark, d):
    """O1 with the slice [0, 459)."""
    return search.location_slice(A.search_locations(spark, d), *search.LOCATION_SLICE)


@query("location_stride")
def q_location_stride(spark, d):
    """O2: every 48th location."""
    return search.location_stride(A.search_locations(spark, d))


def _page(order_key) -> list:
    """Page keys of order ``k``: page ``k % 22`` (offset 50 * (k % 22), so
    offsets run past the 1000 cap) of location ``k div 22``."""
    terms = F.array(*[F.lit(t) for t in search.SEARCH_TERMS])
    loc = F.floor(order_key / 22).cast("long")
    return [F.element_at(terms, (loc % len(search.SEARCH_TERMS) + 1).cast("int")).alias("term"),
            loc.cast("int").alias("location_index"),
            ((order_key % 22) * search.PAGE_SIZE).cast("int").alias("offset")]


@query("page_assembly")
def q_page_assembly(spark, d):
    """S9 on pages landed per (term, location): an order is a page, its hits
    the page's businesses; orders with ``k % 7 = 3`` or without line items
    land empty.  Empty pages are found from the keys alone (a line item's part
    exists, by the benchmark's definition)."""
    k = F.col("o_orderkey")
    filled = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")) \
              .filter(k % 7 != 3).distinct()
    empty = (A.table(spark, d, "orders").select("o_orderkey")
              .join(filled, "o_orderkey", "left_anti").select(*_page(k)))
    h = hits(spark, d).filter(F.col("l_orderkey") % 7 != 3)
    rows = h.select(*_page(F.col("l_orderkey")), "id", "name", "review_count", "price")
    return search.stop_at_empty(rows, empty)


@query("term_routing")
def q_term_routing(spark, d):
    """Rows per (term, feed)."""
    h = hits(spark, d)
    return (h.select("term", C.first_word("term").alias("feed"))
             .groupBy("term", "feed").agg(F.count(F.lit(1)).alias("n_rows")))


def _legacy_hits(spark, d):
    return writers.legacy_raw_rows(hits(spark, d))


ARRIVAL = [asc("l_orderkey"), asc("distance"), asc("review_count")]


@query("insert_if_absent")
def q_insert_if_absent(spark, d):
    """The legacy raw table after loading every non-Restaurants hit into
    a table that already holds the Restaurants hits (one row per id), first
    arrival (order key, line number) winning."""
    return writers.loaded_if_absent(_legacy_hits(spark, d), F.col("term") == "Restaurants",
                                    ARRIVAL, columns=writers.LEGACY_RAW_COLUMNS)


@query("insert_if_absent_clean")
def q_insert_if_absent_clean(spark, d):
    """The same load for the cleaned 12-column table of the older version."""
    leg = clean.clean_legacy(_legacy_hits(spark, d), passthrough=["term", "l_orderkey", "distance"])
    return writers.loaded_if_absent(leg, F.col("term") == "Restaurants", ARRIVAL,
                                    columns=list(clean.LEGACY_CLEAN_COLUMNS))


# --- cleaning operators ---------------------------------------------------------------

def _aliased(spark, d):
    return clean.with_aliases(hits(spark, d))


@query("category_aliases")
def q_category_aliases(spark, d):
    return _aliased(spark, d).select("id", "term", F.to_json("categories").alias("categories"))


@query("category_allow")
def q_category_allow(spark, d):
    return clean.keep_food_and_bars(_aliased(spark, d)).select("id", "term")


@query("category_deny")
def q_category_deny(spark, d):
    return clean.drop_denied(_aliased(spark, d)).select("id", "term")


@query("ethnic_category")
def q_ethnic_category(spark, d):
    return (clean.with_ethnic_category(_aliased(spark, d))
            .select("id", "term", F.to_json("ethnic_category").alias("ethnic_category")))


@query("category_class")
def q_category_class(spark, d):
    """Every alias seen in the hits with its taxonomy membership."""
    ex = hits(spark, d).select(F.explode("categories.alias").alias("alias"))
    return (ex.groupBy("alias").agg(F.count(F.lit(1)).alias("n_hits"))
              .select("alias", "n_hits", TX.classify_alias(F.col("alias")).alias("c"))
              .select("alias", "n_hits", "c.*"))


@query("coord_flatten")
def q_coord_flatten(spark, d):
    return clean.with_flat_coordinates(hits(spark, d)).select("id", "latitude", "longitude")


@query("geo_filter")
def q_geo_filter(spark, d):
    kept = clean.keep_known_cities(hits(spark, d), cities(spark, d))
    return kept.select("id", "term", F.col("location.city").alias("city"))


@query("geo_filter_zip")
def q_geo_filter_zip(spark, d):
    kept = clean.keep_zip_prefix(hits(spark, d))
    return kept.select("id", "term", F.col("location.zip_code").alias("zip_code"))


@query("city_normalize")
def q_city_normalize(spark, d):
    return hits(spark, d).select("id", C.normalize_city("location.city").alias("city"))


@query("address_build")
def q_address_build(spark, d):
    return hits(spark, d).select("id", C.build_address("location").alias("address"))


@query("address_lstrip")
def q_address_lstrip(spark, d):
    return hits(spark, d).select(
        "id", C.lstrip_address(C.build_address("location")).alias("address"))


@query("geo_fill")
def q_geo_fill(spark, d):
    """Cleaned rows whose coordinates were both missing, after the
    gazetteer fill (a miss stays NULL)."""
    rows = clean.with_address(clean.with_flat_coordinates(hits(spark, d)))
    rows = rows.filter(F.col("latitude").isNull() & F.col("longitude").isNull())
    filled = clean.fill_coordinates(rows.select("id", "address", "latitude", "longitude"),
                                    gazetteer(spark, d))
    return filled


# --- staging operators ----------------------------------------------------------------

@query("dedup_by_id")
def q_dedup_by_id(spark, d):
    """O20 over every feed of the raw table."""
    return staging.stage(raw(spark, d))


@query("stg_casts")
def q_stg_casts(spark, d):
    """O21-O23 without the de-duplication (one row per raw row)."""
    r = raw(spark, d)
    return r.select(*staging.staged_columns(r), "feed")


@query("array_to_string")
def q_array_to_string(spark, d):
    r = raw(spark, d)
    return r.select("id", C.array_to_string("categories").alias("categories"),
                    C.array_to_string("ethnic_category").alias("ethnic_category"))


@query("coordinate_key")
def q_coordinate_key(spark, d):
    return raw(spark, d).select("id", C.coordinate_key("latitude", "longitude").alias("coordinate"))


@query("stg_limited")
def q_stg_limited(spark, d):
    """O3: the dev-run cap (100 rows, ordered by id)."""
    return staging.stg_restaurants(raw(spark, d), limit=100)


@query("category_unnest")
def q_category_unnest(spark, d):
    """Staged restaurants, one row per category."""
    return staging.unnest_categories(staging.stg_restaurants(raw(spark, d))).select("id", "category")


# --- marts operators ------------------------------------------------------------------

@query("desserts_filtered")
def q_desserts_filtered(spark, d):
    return marts.desserts_filtered(staging.stg_desserts(raw(spark, d)))


@query("cafes_filtered")
def q_cafes_filtered(spark, d):
    return marts.cafes_filtered(staging.stg_cafes(raw(spark, d)))


@query("restaurants_anti")
def q_restaurants_anti(spark, d):
    return (marts.typed_from_raw(raw(spark, d)).filter(F.col("type") == "restaurants").drop("type"))


@query("typed_union")
def q_typed_union(spark, d):
    return marts.typed_from_raw(raw(spark, d))


@query("listings_all")
def q_listings_all(spark, d):
    return marts.listings_all(marts.typed_from_raw(raw(spark, d)))


@query("listings_fused")
def q_listings_fused(spark, d):
    """O29-O35 fused into one aggregation (the fact's plan)."""
    return marts.pick_listings(raw(spark, d))


@query("fact_city_join")
def q_fact_city_join(spark, d):
    """O36 alone."""
    facts = marts.fact_columns(marts.pick_listings(raw(spark, d)))
    return marts.join_city_dim(facts, marts.dim_coordinates(cities(spark, d)))


@query("fact_county_join")
def q_fact_county_join(spark, d):
    """O37 alone (multiplies on a city with two zips, drops unmatched)."""
    facts = marts.fact_columns(marts.pick_listings(raw(spark, d)))
    return marts.join_county_dim(facts, marts.dim_counties(counties(spark, d)))


# --- quality and counters -------------------------------------------------------------

@query("dq_unique")
def q_dq_unique(spark, d):
    """O31 unique(id) on the raw table: the repeated ids and their counts."""
    return quality.unique_violations(raw(spark, d), "id")


@query("dq_not_null")
def q_dq_not_null(spark, d):
    """O31 not_null on the raw table's price column (warn)."""
    v = quality.not_null_violations(raw(spark, d), "price")
    return v.select("id", "feed", "review_count")


@query("load_counts")
def q_load_counts(spark, d):
    """Rows loaded per requested (term, location), 0 included, and the running total."""
    r = pipeline.raw_rows(hits(spark, d), cities(spark, d), passthrough=["term", "location_index"])
    return quality.load_counts(r, search.SEARCH_TERMS,
                               pairs=search.request_pairs(A.search_locations(spark, d)))


# --- keyterm (older analysis) ---------------------------------------------------------

@query("cat_len")
def q_cat_len(spark, d):
    h = hits(spark, d).withColumn("categories_text", K.category_titles_text("categories"))
    return h.select("id", "categories_text", K.cat_len("categories_text").alias("cat_len"))


@query("keyterm_drop")
def q_keyterm_drop(spark, d):
    h = hits(spark, d).withColumn("categories_text", K.category_titles_text("categories"))
    return h.filter(K.keyterm_keep("categories_text")).select("id", "categories_text")


@query("keyterm_label")
def q_keyterm_label(spark, d):
    return K.keyterms(hits(spark, d)).select("id", "name", "categories_text", "cat_len", "keyterm")


# --- loads without files --------------------------------------------------------------

@query("price_backfill")
def q_price_backfill(spark, d):
    """Records without a price column get a NULL one."""
    return clean.with_price(hits(spark, d).select("id", "name")).select("id", "name", "price")


@query("empty_input")
def q_empty_input(spark, d):
    """The fact after a load in which the Coffee and Desserts searches
    landed nothing."""
    landed = hits(spark, d).filter(F.col("term").isin("Restaurants", "Food"))
    rows = pipeline.raw_rows(landed, cities(spark, d), gazetteer=gazetteer(spark, d))
    return pipeline.build_fact(rows, cities(spark, d), counties(spark, d)) \
                   .groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"))


@query("ndjson_encode")
def q_ndjson_encode(spark, d):
    """One line of JSON per hit, NULLs written out."""
    return writers.encode_ndjson(hits(spark, d).select("id", "name", "price", "review_count"))


@query("landing_name")
def q_landing_name(spark, d):
    """Term, city and index out of landing file names; cities have hyphens."""
    names = search.request_pairs(A.search_locations(spark, d)).select(
        F.concat("term", F.lit("-Carmel-By-the-Sea "), "location_index", F.lit("-"),
                 "location_index", F.lit(".json")).alias("file_name"))
    return names.select("file_name", *files.landing_name_parts("file_name"))


@query("view_read")
def q_view_read(spark, d):
    """The cafe model registered as a view, then read by SQL."""
    writers.as_view(staging.stg_cafes(raw(spark, d)), "stg_cafes_view")
    return spark.sql("select id, name, city, review_count from stg_cafes_view where price is not null")


# --- loads with files, below the session's shared folder --------------------------------

LEGACY_KINDS = {"is_closed": "boolean", "review_count": "bigint", "rating": "double"}
LEGACY_DDL = ", ".join(f"{c} {LEGACY_KINDS.get(c, 'string')}" for c in writers.LEGACY_RAW_COLUMNS)
LANDED = "*.json.gz"
RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW.fields)


@query("append_if_absent")
def q_append_if_absent(spark, d):
    """S17/S18 with the key index: the Restaurants hits as they are, then twice the
    same load of the first arrivals of all other ids; the second adds nothing."""
    rows = _legacy_hits(spark, d)
    target = KeyedTable(spark, shared_folder(spark, "keyed"), LEGACY_DDL)
    target.append_all(rows.filter(F.col("term") == "Restaurants"))
    for _ in range(2):
        target.append(rows.filter(F.col("term") != "Restaurants"), ARRIVAL)
    return target.rows().select(*writers.LEGACY_RAW_COLUMNS, "load")


def _landed(spark, d):
    """The hits with one pair of (term, location) for every 20th location."""
    fields = [f.name for f in BUSINESS.fields]
    return hits(spark, d).withColumn("location_index", F.col("location_index") % 20) \
        .select(*fields, "term", "location_index", "l_orderkey")


@query("append_ledger")
def q_append_ledger(spark, d):
    """S13 with the ledger: two thirds of the hits land and are loaded, twice;
    then every tenth location lands anew, whole, and only those pairs are read."""
    folder, order = shared_folder(spark, "landing"), F.col("l_orderkey")
    table = LedgeredTable(spark, shared_folder(spark, "raw"), RAW_DDL, by_folder, tuple(writers.RAW_REQUIRED))
    read = lambda paths: files.read_landing_partitioned(spark, folder, paths).select(
        "*", F.col("_metadata.file_path").alias("file_path"))
    clean_ = lambda h: pipeline.raw_rows(h, cities(spark, d), gazetteer=gazetteer(spark, d),
                                         passthrough=["file_path"], narrow=True)
    land = lambda h: writers.write_landing(h.drop("l_orderkey"), folder, compression="gzip")
    land(_landed(spark, d).filter(order % 3 != 0))
    table.load(folder, read, clean_, LANDED)
    table.load(folder, read, clean_, LANDED)
    land(_landed(spark, d).filter(F.col("location_index") % 10 == 0))
    table.load(folder, read, clean_, LANDED)
    return _json_arrays(table.rows())


@query("landing_overwrite")
def q_landing_overwrite(spark, d):
    """Every pair lands, then every tenth location again with half of its hits."""
    folder, landed = shared_folder(spark, "landing"), _landed(spark, d)
    again = landed.filter((F.col("location_index") % 10 == 0) & (F.col("l_orderkey") % 2 == 0))
    for rows in (landed, again):
        writers.write_landing(rows.drop("l_orderkey"), folder, compression="gzip")
    return files.read_landing_partitioned(spark, folder).select("id", "url", "price", "term", "location_index")


@query("table_rebuild")
def q_table_rebuild(spark, d):
    """The city dimension built from half of the list, rebuilt from all of it,
    and then a build that fails on its way: the rows of the second stay."""
    table = VersionedTable(spark, shared_folder(spark, "dim_coordinates"))
    table.rebuild(marts.dim_coordinates(cities(spark, d).filter("position % 2 = 0")))
    table.rebuild(marts.dim_coordinates(cities(spark, d)))
    torn = marts.dim_coordinates(cities(spark, d)).withColumn(
        "latitude", F.coalesce("latitude", F.lit(0.0)) + F.raise_error(F.lit("a build that fails")).cast("double"))
    with contextlib.suppress(PySparkException):
        table.rebuild(torn)
    return table.read()


@query("file_positions")
def q_file_positions(spark, d):
    """The location list as five CSV files, read back with file positions."""
    folder = shared_folder(spark, "cities")
    listed = A.search_locations(spark, d).repartitionByRange(5, "position").sortWithinPartitions("position")
    listed.drop("position").write.option("header", True).csv(folder)
    return files.read_city_locations(spark, folder)


@query("list_quarantine")
def q_list_quarantine(spark, d):
    """A list with rows that cannot be typed; good and rejected rows from one scan."""
    folder, k = shared_folder(spark, "list"), F.col("position")
    lat = F.when(k % 50 == 0, F.lit("abc")).otherwise((k % 90).cast("string"))
    line = F.when(k % 70 == 0, F.concat_ws(",", "Name", lat)).otherwise(
        F.concat_ws(",", "Name", lat, (-k % 180).cast("string")))
    A.search_locations(spark, d).select(line.alias("value")).write.text(f"{folder}/in")
    good, bad, _ = files.load_checked(spark, f"{folder}/in", CITY_LOCATIONS, f"{folder}/out", header=False)
    none = F.lit(None).cast("string")
    return good.withColumns({"line": none, "reason": none}).unionByName(bad)


@query("range_fetch")
def q_range_fetch(spark, d):
    """S6 on a Parquet stand-in: a third of the orders share one key, some have
    none; each range is a read of its own, and every row comes exactly once."""
    k = F.col("o_orderkey")
    key = F.when(k % 3 == 0, F.lit(7)).when(k % 50 == 1, F.lit(None)).otherwise(F.col("o_custkey")).alias("fetch_key")
    orders = lambda: A.table(spark, d, "orders").select("o_orderkey", key)
    conditions = files.key_ranges(orders(), "fetch_key", 8)
    return files.fetch_ranges(lambda c: orders().filter(c), conditions)


@query("category_flags")
def q_category_flags(spark, d):
    """Which of the seven sets each hit's categories meet.  The table of the
    non-food set is derived: the aliases seen that are not food or bars."""
    h = _aliased(spark, d)
    seen = h.select(F.explode("categories").alias("alias")).distinct()
    nonfood = seen.filter(~F.col("alias").isin(list(TX.DEFAULT_TAXONOMY.allow)))
    flagged = TX.with_class_mask(h, TX.taxonomy_table(spark, nonfood=nonfood))
    return flagged.select("id", "term", *[TX.meets("class_mask", s).alias(f"meets_{s}") for s in TX.SETS])


@query("price_batches")
def q_price_batches(spark, d):
    """A batch whose records have no price, and one whose records do."""
    h = hits(spark, d).select("id", "term", "price", "l_orderkey")
    odd = F.col("l_orderkey") % 2 == 1
    both = clean.with_price(h.filter(~odd).drop("price")).unionByName(clean.with_price(h.filter(odd)))
    return both.select("id", "term", "price")


@query("anti_join_steps")
def q_anti_join_steps(spark, d):
    """O32-O34 as they are modelled: the raw table is written, three views are
    staged from it, then exclusion set, anti join and typed union."""
    folder = shared_folder(spark, "raw")
    writers.append_raw(raw(spark, d), folder)
    table = files.read_raw(spark, folder)
    sweets = marts.desserts_filtered(staging.stg_desserts(table))
    coffee = marts.cafes_filtered(staging.stg_cafes(table))
    rest = marts.restaurants_anti(staging.stg_restaurants(table), marts.exclusion_ids(sweets, coffee))
    return marts.typed_union(rest, sweets, coffee)


@query("dedup_two_phase")
def q_dedup_two_phase(spark, d):
    """O20 on a stored raw table: first the greatest review count of each id from two
    columns, then the pick among the rows that have it."""
    folder = shared_folder(spark, "raw")
    writers.append_raw(raw(spark, d), folder)
    return staging.stage(files.read_raw(spark, folder), narrow=True)

"""Dimensions and the listings fact.

Two ways to the same fact:

* the composable operators (``desserts_filtered``, ``cafes_filtered``,
  ``restaurants_anti``, ``typed_union``, ``listings_all``, the two dimension
  joins) mirror the modelling steps one by one;
* :func:`fact_from_raw` fuses staging and the cross-type pick into ONE
  aggregation keyed by id.  Per id it keeps the best restaurant, cafe and
  dessert row (three conditional ``min(struct)``), applies the dessert and
  cafe rules to those winners and picks desserts > cafe > restaurants.  The
  anti join is implied: a restaurant row only survives when no dessert or
  cafe row of the same id passed its rule.  One shuffle instead of five, and
  the aggregate is combined map-side, so a hot id is never gathered whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import FACT_COLUMNS, STAGING_COLUMNS
from .dedup import asc, first_per_key, leading_rows, ranked_struct, restored
from .staging import (CAFE_FEEDS, DESSERT_FEEDS, RESTAURANT_FEEDS, STAGING_ORDER,
                      non_null_ids, staged_columns)

# Priority of the cross-type pick (lower wins).
TYPE_PRIORITY = {"desserts": 0, "cafe": 1, "restaurants": 2}


def dim_coordinates(cities: DataFrame) -> DataFrame:
    """Lower-cased city name, coordinates and coordinate key."""
    return cities.select(
        F.lower("Name").alias("city"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        C.coordinate_key("Latitude", "Longitude").alias("coordinate"))


def dim_counties(counties: DataFrame) -> DataFrame:
    """Lower-cased city and county, state, zip."""
    return counties.select(
        F.lower(F.col("City")).alias("city"),
        F.lower(F.col("`County Name`")).alias("county"),
        F.col("State").alias("state"),
        F.col("Zip").alias("zipcode"))


def desserts_filtered(stg_desserts: DataFrame) -> DataFrame:
    """O29."""
    return stg_desserts.filter(C.dessert_keep("categories", "alias"))


def cafes_filtered(stg_cafes: DataFrame) -> DataFrame:
    """O30."""
    return stg_cafes.filter(C.cafe_keep("categories", "name"))


def exclusion_ids(desserts: DataFrame, cafes: DataFrame) -> DataFrame:
    """Ids of the dessert and cafe branches (only ``id`` is needed)."""
    return desserts.select("id").unionByName(cafes.select("id"))


def restaurants_anti(restaurants: DataFrame, excluded: DataFrame) -> DataFrame:
    """Restaurants whose id is not excluded, as a real anti join
    (duplicate ids on the right cannot multiply rows)."""
    return restaurants.join(excluded.select("id"), "id", "left_anti")


def typed_union(restaurants: DataFrame, desserts: DataFrame, cafes: DataFrame) -> DataFrame:
    """Tag each branch with its type and union by name."""
    return (restaurants.withColumn("type", F.lit("restaurants"))
            .unionByName(desserts.withColumn("type", F.lit("desserts")))
            .unionByName(cafes.withColumn("type", F.lit("cafe"))))


def _priority(type_col) -> F.Column:
    expr = None
    for name, rank in TYPE_PRIORITY.items():
        expr = (F.when(type_col == F.lit(name), F.lit(rank)) if expr is None
                else expr.when(type_col == F.lit(name), F.lit(rank)))
    return expr.otherwise(F.lit(len(TYPE_PRIORITY)))


def listings_all(typed: DataFrame) -> DataFrame:
    """One row per id across types: desserts, then cafe, then
    restaurants; ties (not produced by the staged inputs) fall back to the
    staging order."""
    ranked = typed.withColumn("_prio", _priority(F.col("type")))
    order = [asc("_prio")] + STAGING_ORDER + [asc("type")]
    return first_per_key(ranked, "id", order, payload=typed.columns)


def fact_columns(listings: DataFrame) -> DataFrame:
    """Listing part of the fact projection (renames, LOWER on name,
    ethnic category and type)."""
    return listings.select(
        F.col("id"), F.col("alias"), F.lower("name").alias("name"), F.col("url"),
        F.col("review_count"), F.col("rating"), F.col("price"), F.col("categories"),
        F.lower("ethnic_category").alias("ethnic_categories"), F.lower("type").alias("type"),
        F.col("latitude").alias("shop_latitude"), F.col("longitude").alias("shop_longitude"),
        F.col("coordinate").alias("shop_coordinate"), F.col("address").alias("shop_address"),
        F.col("city").alias("shop_city"))


def join_city_dim(facts: DataFrame, dim_coords: DataFrame) -> DataFrame:
    """Inner equi-join on city with the coordinate dimension (the
    planner broadcasts it while its measured size allows)."""
    d = dim_coords.select(F.col("city").alias("city_city"),
                          F.col("latitude").alias("city_latitude"),
                          F.col("longitude").alias("city_longitude"),
                          F.col("coordinate").alias("city_coordinate"))
    return facts.join(d, facts["shop_city"] == d["city_city"], "inner")


def join_county_dim(facts: DataFrame, dim_cnty: DataFrame) -> DataFrame:
    """Inner equi-join on city with the county dimension.  Several rows
    per city multiply the fact, no row drops it (as modelled)."""
    d = dim_cnty.select(F.col("city").alias("county_city"), F.col("county"),
                        F.col("zipcode").alias("county_zipcode"))
    return facts.join(d, facts["shop_city"] == d["county_city"], "inner")


def fact_from_listings(listings: DataFrame, dim_coords: DataFrame, dim_cnty: DataFrame) -> DataFrame:
    """O36-O38 on de-duplicated typed listings."""
    out = join_county_dim(join_city_dim(fact_columns(listings), dim_coords), dim_cnty)
    return out.select(*FACT_COLUMNS)


def fact_stepwise(stg_r: DataFrame, stg_c: DataFrame, stg_d: DataFrame,
                  dim_coords: DataFrame, dim_cnty: DataFrame) -> DataFrame:
    """The fact built step by step from the three staging views."""
    d = desserts_filtered(stg_d)
    c = cafes_filtered(stg_c)
    r = restaurants_anti(stg_r, exclusion_ids(d, c))
    return fact_from_listings(listings_all(typed_union(r, d, c)), dim_coords, dim_cnty)


def branches_by_id(raw: DataFrame, narrow: bool = False) -> DataFrame:
    """Per id the staged restaurant, cafe and dessert rows ``r``, ``c``, ``d``
    (NULL where there is none or its rule drops it): one scan of the raw
    table and one aggregation (see module doc).  ``narrow``, for a stored raw
    table, aggregates the rows that can win alone (see ``leading_rows``)."""
    rows = non_null_ids(raw.filter(F.col("feed").isin(list(RESTAURANT_FEEDS + CAFE_FEEDS + DESSERT_FEEDS))))
    if narrow:
        branch = F.when(F.col("feed").isin(list(CAFE_FEEDS)), 1).when(F.col("feed").isin(list(DESSERT_FEEDS)), 2) \
            .otherwise(0)
        rows = leading_rows(rows.withColumn("_branch", branch), ["id", "_branch"], STAGING_ORDER[0].column)
    typed = rows.select(F.col("feed"), *staged_columns(raw))
    best = ranked_struct(typed, STAGING_ORDER, STAGING_COLUMNS)
    feed = F.col("feed")
    per_id = typed.groupBy("id").agg(
        F.min(F.when(feed.isin(list(RESTAURANT_FEEDS)), best)).alias("r"),
        F.min(F.when(feed.isin(list(CAFE_FEEDS)), best)).alias("c"),
        F.min(F.when(feed.isin(list(DESSERT_FEEDS)), best)).alias("d"))
    row = lambda c: f"if({c} is not null, {restored(c, STAGING_ORDER, STAGING_COLUMNS)}, null) as {c}"
    return per_id.selectExpr(*[row(c) for c in "rcd"]).select(
        "r", F.when(C.cafe_keep(F.col("c.categories"), F.col("c.name")), F.col("c")).alias("c"),
        F.when(C.dessert_keep(F.col("d.categories"), F.col("d.alias")), F.col("d")).alias("d"))


def _typed(row: str, type_: str) -> F.Column:
    return F.struct(F.col(row).alias("row"), F.lit(type_).alias("type"))


def _unpacked(picks: DataFrame) -> DataFrame:
    return picks.select("_pick.row.*", "_pick.type")


def typed_from_raw(raw: DataFrame) -> DataFrame:
    """O32-O34 in one scan: every dessert and cafe row that passed its rule,
    and the restaurant rows of ids without either."""
    alone = F.col("c").isNull() & F.col("d").isNull()
    rows = F.array(_typed("d", "desserts"), _typed("c", "cafe"),
                   F.when(alone, _typed("r", "restaurants")))
    return _unpacked(branches_by_id(raw).select(F.explode(rows).alias("_pick"))
                     .filter(F.col("_pick.row").isNotNull()))


def pick_listings(raw: DataFrame, narrow: bool = False) -> DataFrame:
    """Staging + O29-O35 fused into one aggregation by id (see module doc)."""
    chosen = (F.when(F.col("d").isNotNull(), _typed("d", "desserts"))
               .when(F.col("c").isNotNull(), _typed("c", "cafe"))
               .when(F.col("r").isNotNull(), _typed("r", "restaurants")))
    return _unpacked(branches_by_id(raw, narrow).select(chosen.alias("_pick")).filter(F.col("_pick").isNotNull()))


def fact_from_raw(raw: DataFrame, cities: DataFrame, counties: DataFrame, narrow: bool = False) -> DataFrame:
    """O38 flagship: raw table + city list + county list -> 22-column fact."""
    return fact_from_listings(pick_listings(raw, narrow), dim_coordinates(cities), dim_counties(counties))

"""Explicit schemas for every table the pipeline reads or writes.

Reads never infer: a landing file where no business has a ``price`` simply
yields NULL for it, and column types are stable across files.
"""

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()

# Staging numerics: NUMERIC of the warehouse = decimal(38, 9).
NUMERIC = T.DecimalType(38, 9)

# City locations, CSV with header; file position is meaningful.
CITY_LOCATIONS = T.StructType([
    T.StructField("Name", S),
    T.StructField("Latitude", D),
    T.StructField("Longitude", D),
])

# County / city list (column names carry spaces).
COUNTY_CITIES = T.StructType([
    T.StructField("Entity Name", S),
    T.StructField("Entity ID", L),
    T.StructField("Entity Type", S),
    T.StructField("County Name", S),
    T.StructField("City", S),
    T.StructField("State", S),
    T.StructField("Zip", S),
    T.StructField("Estimated Population", L),
    T.StructField("Class Data", S),
    T.StructField("Fiscal Year End", L),
    T.StructField("Paper Report Due Date", L),
    T.StructField("Electronic Report Due Date", L),
])

CATEGORY = T.StructType([T.StructField("alias", S), T.StructField("title", S)])
COORDINATES = T.StructType([T.StructField("latitude", D), T.StructField("longitude", D)])
LOCATION = T.StructType([
    T.StructField("address1", S),
    T.StructField("address2", S),
    T.StructField("city", S),
    T.StructField("state", S),
    T.StructField("zip_code", S),
])

# D3: one business record as returned by the search API.
BUSINESS = T.StructType([
    T.StructField("id", S),
    T.StructField("alias", S),
    T.StructField("name", S),
    T.StructField("image_url", S),
    T.StructField("is_closed", B),
    T.StructField("url", S),
    T.StructField("review_count", L),
    T.StructField("categories", T.ArrayType(CATEGORY)),
    T.StructField("rating", D),
    T.StructField("coordinates", COORDINATES),
    T.StructField("transactions", T.ArrayType(S)),
    T.StructField("price", S),
    T.StructField("location", LOCATION),
    T.StructField("phone", S),
    T.StructField("display_phone", S),
    T.StructField("distance", D),
])

# one landed page of a paginated search.
LANDED_PAGE = T.StructType([
    T.StructField("term", S),
    T.StructField("location_index", I),
    T.StructField("offset", I),
    T.StructField("businesses", T.ArrayType(BUSINESS)),
])

# Raw table (one table for all feeds, partitioned by ``feed``).
RAW_COLUMNS = ["id", "alias", "name", "url", "review_count", "categories",
               "ethnic_category", "rating", "price", "latitude", "longitude",
               "city", "address"]
RAW = T.StructType([
    T.StructField("id", S, False),
    T.StructField("alias", S, False),
    T.StructField("name", S, False),
    T.StructField("url", S),
    T.StructField("review_count", L),
    T.StructField("categories", T.ArrayType(S)),
    T.StructField("ethnic_category", T.ArrayType(S)),
    T.StructField("rating", D),
    T.StructField("price", S),
    T.StructField("latitude", D),
    T.StructField("longitude", D),
    T.StructField("city", S),
    T.StructField("address", S),
    T.StructField("feed", S),
])
RAW_REQUIRED = ["id", "alias", "name"]

# Staging view columns (all scalar).
STAGING_COLUMNS = ["id", "alias", "name", "url", "review_count", "categories",
                   "ethnic_category", "rating", "price", "latitude", "longitude",
                   "coordinate", "city", "address"]

# Fact columns.
FACT_COLUMNS = ["id", "alias", "name", "url", "review_count", "rating", "price",
                "categories", "ethnic_categories", "type", "shop_latitude",
                "shop_longitude", "shop_coordinate", "shop_address", "shop_city",
                "city_city", "city_latitude", "city_longitude", "city_coordinate",
                "county_city", "county", "county_zipcode"]

# Relational store of the older version (nested fields as JSON text).
LEGACY_RAW_COLUMNS = ["id", "alias", "name", "image_url", "is_closed", "url",
                      "review_count", "categories", "rating", "coordinates",
                      "transactions", "price", "location", "phone", "display_phone"]
LEGACY_CLEAN_COLUMNS = ["id", "alias", "name", "url", "review_count", "categories",
                        "rating", "price", "latitude", "longitude", "city", "address"]

# F8: gazetteer used in place of live geocoding.
GAZETTEER = T.StructType([
    T.StructField("address", S),
    T.StructField("latitude", D),
    T.StructField("longitude", D),
])

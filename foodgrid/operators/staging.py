"""Staging views over the raw table.

``stage(raw, feeds)`` is the one parametrised form of the three staging
views: union of feeds -> non-NULL ids -> typed projection -> one row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import NUMERIC, STAGING_COLUMNS
from .dedup import Order, asc, desc, first_per_key, leading_rows

# Feeds (first word of the search term) read by each staging view.
RESTAURANT_FEEDS = ("Restaurants", "Food")
CAFE_FEEDS = ("Coffee",)
DESSERT_FEEDS = ("Desserts",)

# Deterministic pick for the per-id de-duplication: most reviews first, then
# every other output column ascending with NULLs first, so a tie means the
# two rows are identical in the output.
STAGING_ORDER: list[Order] = [desc("review_count", nulls_last=True)] + [
    asc(c) for c in STAGING_COLUMNS if c not in ("id", "review_count")]


def non_null_ids(df: DataFrame) -> DataFrame:
    """O4."""
    return df.filter(F.col("id").isNotNull())


def staged_columns(df: DataFrame) -> list:
    """Casts, arrays to text, coordinate key (from the FLOAT
    columns, before the NUMERIC cast)."""
    return [
        F.col("id").cast("string").alias("id"),
        F.col("alias").cast("string").alias("alias"),
        F.col("name").cast("string").alias("name"),
        F.col("url").cast("string").alias("url"),
        F.col("review_count").cast("bigint").alias("review_count"),
        C.array_to_string("categories").alias("categories"),
        C.array_to_string("ethnic_category").alias("ethnic_category"),
        F.col("rating").cast(NUMERIC).alias("rating"),
        F.col("price").cast("string").alias("price"),
        F.col("latitude").cast(NUMERIC).alias("latitude"),
        F.col("longitude").cast(NUMERIC).alias("longitude"),
        C.coordinate_key("latitude", "longitude").alias("coordinate"),
        F.col("city").cast("string").alias("city"),
        F.col("address").cast("string").alias("address"),
    ]


def select_feeds(raw: DataFrame, feeds) -> DataFrame:
    """The union of the feeds' raw rows.  The raw table is one table
    partitioned by ``feed``, so this is a partition-pruned scan."""
    return raw.filter(F.col("feed").isin(list(feeds)))


def stage(raw: DataFrame, feeds=None, limit: int | None = None, narrow: bool = False) -> DataFrame:
    """One staging view, over all feeds by default.  ``limit`` is the dev-run row cap (O3), off by
    default; when on, rows are ordered by id so the cap is deterministic.  ``narrow``, for a
    stored raw table, first finds the rows that can win from ids and review counts alone."""
    rows = non_null_ids(raw if feeds is None else select_feeds(raw, feeds))
    if narrow:
        rows = leading_rows(rows, ["id"], STAGING_ORDER[0].column)
    typed = rows.select(*staged_columns(raw))
    out = first_per_key(typed, "id", STAGING_ORDER)
    if limit is not None:
        out = out.orderBy("id").limit(limit)
    return out


def stg_restaurants(raw: DataFrame, limit: int | None = None, narrow: bool = False) -> DataFrame:
    return stage(raw, RESTAURANT_FEEDS, limit, narrow)


def stg_cafes(raw: DataFrame, limit: int | None = None, narrow: bool = False) -> DataFrame:
    return stage(raw, CAFE_FEEDS, limit, narrow)


def stg_desserts(raw: DataFrame, limit: int | None = None, narrow: bool = False) -> DataFrame:
    return stage(raw, DESSERT_FEEDS, limit, narrow)


def unnest_categories(df: DataFrame, column: str = "categories", sep: str = ", ") -> DataFrame:
    """One row per category (``explode_outer`` keeps rows without any).

    Accepts the raw array form or the staged text form."""
    dtype = dict(df.dtypes)[column]
    arr = F.col(column) if dtype.startswith("array") else F.split(F.col(column), sep)
    return df.withColumn("category", F.explode_outer(arr))

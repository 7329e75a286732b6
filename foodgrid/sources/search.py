"""Search planning and page assembly.

The live API client is out of scope; what it did is expressed on data:

* :func:`request_plan` lists every request the ingest would send:
  terms x locations[start:end] x page offsets;
* :func:`assemble_pages` turns landed pages into business rows with the
  client's stopping rules (first empty page, 1000-row cap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# FIXED VALUES of the search client.
PAGE_SIZE = 50          # rows per call; the offset advances by this
RESULT_CAP = 1000       # the endpoint returns at most this many rows
RADIUS_METERS = 10000   # 25000 in the older single-machine version
LOCATION_SLICE = (0, 459)
LEGACY_STRIDE = 48
SEARCH_TERMS = ["Restaurants", "Food", "Coffee & Tea", "Juice Bars & Smoothies", "Desserts",
                "Bakeries", "Bubble Tea"]


def location_slice(locations: DataFrame, start: int = 0, end: int | None = None,
                   position: str = "position") -> DataFrame:
    """O1: ``locations[start:end]`` by stored file position; by default to the list's end."""
    out = locations.filter(F.col(position) >= start)
    return out if end is None else out.filter(F.col(position) < end)


def location_stride(locations: DataFrame, step: int = LEGACY_STRIDE,
                    position: str = "position") -> DataFrame:
    """O2: ``locations[::step]`` by stored file position."""
    return locations.filter(F.col(position) % step == 0)


def request_pairs(locations: DataFrame, terms=SEARCH_TERMS, position: str = "position") -> DataFrame:
    """Every (term, location_index) a run asks for."""
    return locations.select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"),
                            F.col(position).cast("int").alias("location_index"))


def request_plan(locations: DataFrame, terms=SEARCH_TERMS, radius: int = RADIUS_METERS,
                 page_size: int = PAGE_SIZE, cap: int = RESULT_CAP,
                 position: str = "position") -> DataFrame:
    """One row per request.  Terms and offsets are generated per location
    row (``explode``), so the plan is a narrow transformation of the location
    list: no join and no shuffle."""
    term_arr = F.array(*[F.lit(t) for t in terms])
    offsets = F.sequence(F.lit(0), F.lit(cap - page_size), F.lit(page_size))
    return (locations
            .select(F.explode(term_arr).alias("term"),
                    F.col(position).alias("location_index"),
                    F.col("Name").alias("location"),
                    F.col("Latitude").alias("latitude"),
                    F.col("Longitude").alias("longitude"))
            .select("*", F.explode(offsets).alias("offset"))
            .select("term", "location_index", "location", "latitude", "longitude",
                    F.lit(radius).alias("radius"), F.lit(page_size).alias("limit"),
                    "offset", F.lit(False).alias("is_closed")))


def assemble_pages(pages: DataFrame, cap: int = RESULT_CAP,
                   keys=("term", "location_index")) -> DataFrame:
    """Landed pages ``(term, location_index, offset, businesses)`` ->
    one row per business, keeping pages before the first empty page and
    below the cap.

    The first empty offset per (term, location) comes from a map-side
    combined aggregate with one row per pair.  Its size is only known once
    it has run, so the join back is left to AQE, which broadcasts it from the
    measured size (a probe here would cost a second pass over all pages).
    """
    keys = list(keys)
    first_empty = (pages.filter(F.coalesce(F.size("businesses"), F.lit(0)) <= 0)
                        .groupBy(*keys).agg(F.min("offset").alias("_first_empty")))
    stop = F.least(F.coalesce(F.col("_first_empty"), F.lit(cap)), F.lit(cap))
    kept = (pages.join(first_empty, keys, "left")
                 .filter(F.col("offset") < stop))
    return kept.select(*keys, "offset", F.explode("businesses").alias("b")).select(
        *keys, "offset", "b.*")


def assemble_page_rows(rows: DataFrame, cap: int = RESULT_CAP, keys=("term", "location_index"),
                       present: str = "id") -> DataFrame:
    """S9 on flat landed pages: one row per (page, business), an empty page
    being one row whose ``present`` column is NULL.

    Nothing is gathered per page: page sizes and the first empty offset are
    map-side combined counts and minima, so a page or (term, location) that
    holds a third of all rows is never collected into one task.  As above,
    AQE decides from the measured size whether the per-pair table is
    broadcast; a hot pair on a shuffled join is split by AQE's skew handling.
    """
    empty = (rows.groupBy(*keys, "offset").agg(F.count(F.col(present)).alias("_n"))
                 .filter(F.col("_n") == 0))
    return stop_at_empty(rows.filter(F.col(present).isNotNull()), empty, cap, keys)


def stop_at_empty(rows: DataFrame, empty: DataFrame, cap: int = RESULT_CAP,
                  keys=("term", "location_index")) -> DataFrame:
    """Business rows before the first page listed in ``empty`` and below the cap."""
    keys = list(keys)
    first = empty.groupBy(*keys).agg(F.min("offset").alias("_first_empty"))
    stop = F.least(F.coalesce(F.col("_first_empty"), F.lit(cap)), F.lit(cap))
    return (rows.filter(F.col("offset") < cap).join(first, keys, "left")
                .filter(F.col("offset") < stop).drop("_first_empty"))

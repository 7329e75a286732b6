"""Cleaning of nested business records into raw-table rows.

Input: D3 records (``categories`` array of structs, ``coordinates`` and
``location`` structs), plus any passthrough columns such as ``term``.
Output: the 13 raw columns (plus passthrough).  Every step is a built-in
column expression; the city list and gazetteer are joins, never driver-side
sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.taxonomy import DEFAULT_TAXONOMY, Taxonomy
from ..schemas import LEGACY_CLEAN_COLUMNS, RAW_COLUMNS
from ..session import fits_broadcast, fits_partitions, released_shuffles, shared_folder, sized_shuffles
from ..sinks.keyed import BITS_PER_KEY, BLOCK_BITS, _block, bloom_of, seen


def with_price(df: DataFrame) -> DataFrame:
    """Add a NULL ``price`` when the input has none."""
    if "price" in df.columns:
        return df
    return df.withColumn("price", F.lit(None).cast("string"))


def with_aliases(df: DataFrame, source: str = "categories", target: str = "categories") -> DataFrame:
    """Categories become their aliases."""
    return df.withColumn(target, C.category_aliases(source))


def keep_food_and_bars(df: DataFrame, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
                       aliases: str = "categories") -> DataFrame:
    """Allow-list filter."""
    return df.filter(C.allowed(aliases, taxonomy))


def drop_denied(df: DataFrame, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
                aliases: str = "categories") -> DataFrame:
    """Deny-list filter."""
    return df.filter(C.not_denied(aliases, taxonomy))


def with_ethnic_category(df: DataFrame, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
                         aliases: str = "categories") -> DataFrame:
    """O10."""
    return df.withColumn("ethnic_category", C.ethnic_subset(aliases, taxonomy))


def with_flat_coordinates(df: DataFrame) -> DataFrame:
    """``coordinates`` struct -> ``latitude``, ``longitude``."""
    return (df.withColumn("latitude", F.col("coordinates.latitude"))
              .withColumn("longitude", F.col("coordinates.longitude")))


#: Names, listed or not, that a filter of the listed ones is made for (20 MB at most).
MOST_NAMES = 1 << 24


def keep_known_cities(df: DataFrame, cities: DataFrame, state: str = "CA", city_col: str = "location.city",
                      name_col: str = "Name", narrow: bool = False) -> DataFrame:
    """State matches and the raw city (before normalisation, case
    sensitive) is in the city list.  A semi join; the planner sizes the list.

    A list too large to broadcast is hashed in each partition and the rows pass it: a
    merge would sort them by city at their full width.  It is shuffled as it is, since
    AQE does not split a city that many rows name beside an aggregate.  ``narrow``, for
    stored rows: such a list is looked up first (:func:`_keep_by_filter`), no row is shuffled.
    """
    names = cities.select(F.col(name_col).alias("_city")).filter(F.col("_city").isNotNull())
    keyed = df.filter(F.col("location.state") == F.lit(state)).withColumn("_city", F.col(city_col))
    if narrow and not fits_broadcast(names):
        return _keep_by_filter(keyed, sized_shuffles(names)).drop("_city")
    names = names.distinct() if fits_broadcast(names) else sized_shuffles(names).hint("shuffle_hash")
    return keyed.join(names, "_city", "left_semi").drop("_city")


def _keep_by_filter(keyed: DataFrame, names: DataFrame) -> DataFrame:
    """The rows whose ``_city`` is listed, without a shuffle of the rows.

    The distinct cities of the rows meet the list once and are stored, each with whether it is
    listed.  The listed ones make a Bloom filter of ``BITS_PER_KEY`` bits a name, which is
    broadcast; of the others the few that it lets pass are known by name, so the result is
    exact.  The rows are read once more for their cities.  More names than ``MOST_NAMES`` are
    not broadcast in any form: the rows are then joined by city after all.
    """
    spark = keyed.sparkSession
    folder = shared_folder(spark, "cities")
    keyed = keyed.filter(F.col("_city").isNotNull())
    listed = names.select("_city", F.lit(True).alias("_listed")).distinct()
    named = keyed.select("_city").distinct().join(listed, "_city", "left") \
        .select("_city", F.coalesce("_listed", F.lit(False)).alias("_listed"))
    with released_shuffles(spark):
        named.write.parquet(folder)
    named = spark.read.schema(named.schema).parquet(folder)
    n = {r["_listed"]: r["count"] for r in named.groupBy("_listed").count().collect()}
    known, others = named.filter("_listed").select("_city"), named.filter("not _listed").select("_city")
    if max([0, *n.values()]) > MOST_NAMES:
        return keyed.join(known.hint("shuffle_hash"), "_city", "left_semi")
    blocks = max(1, -(-n.get(True, 0) * BITS_PER_KEY // BLOCK_BITS))
    bits = F.broadcast(bloom_of(known, "_city", blocks))

    def passed(df: DataFrame) -> DataFrame:
        return df.withColumn("block", _block("_city", blocks)).join(bits, "block").filter(seen("_city")) \
            .drop("block", "bits")
    return passed(keyed).join(F.broadcast(passed(others)), "_city", "left_anti")


def keep_zip_prefix(df: DataFrame, state: str = "CA", prefix: str = "9") -> DataFrame:
    """O13 (older rule): state matches and zip code starts with ``prefix``."""
    return df.filter((F.col("location.state") == F.lit(state))
                     & F.col("location.zip_code").startswith(prefix))


def with_city(df: DataFrame) -> DataFrame:
    """O14."""
    return df.withColumn("city", C.normalize_city("location.city"))


def with_address(df: DataFrame, null_text: str | None = "None") -> DataFrame:
    """O15 (address text before the left strip of O16)."""
    return df.withColumn("address", C.build_address("location", null_text))


def strip_address(df: DataFrame) -> DataFrame:
    """O16."""
    return df.withColumn("address", C.lstrip_address("address"))


def fill_coordinates(df: DataFrame, gazetteer: DataFrame | None) -> DataFrame:
    """Fill latitude/longitude from a gazetteer by address.

    Only rows with *both* coordinates NULL are filled (a row with one missing
    is untouched), and a miss keeps them NULL.  The gazetteer is first reduced
    to one row per address (map-side combined), so a duplicate address can
    never multiply a business.

    Beside a gazetteer that the planner's own estimate says can be broadcast, it is
    one left join without a shuffle of ``df``: rows that need no fill carry a key
    that no address has, spread like their addresses.  Beside a larger one
    only the rows that need a fill take part in a join (:func:`_fill_narrow`).
    """
    if gazetteer is None:
        return df
    wanted = F.col("latitude").isNull() & F.col("longitude").isNull() & F.col("address").isNotNull()
    known = gazetteer.filter(F.col("address").isNotNull())
    if not fits_broadcast(known):
        return _fill_narrow(df, known, wanted)
    key = F.when(wanted, F.col("address")).otherwise(F.concat(F.lit("\u0000"), F.coalesce("address", F.lit(""))))
    return _filled(df.withColumn("_key", key), _one_each(known), "_key").select(*df.columns)


def _one_each(gazetteer: DataFrame) -> DataFrame:
    return gazetteer.groupBy("address").agg(F.min(F.struct("latitude", "longitude")).alias("_g")) \
        .select(F.col("address").alias("_gaddr"), "_g")


def _filled(df: DataFrame, found: DataFrame, key: str, *also: F.Column) -> DataFrame:
    """``df`` with the coordinates of ``found`` where ``key`` (and ``also``) is there."""
    hit = F.col("_gaddr").isNotNull()
    return df.join(found, [F.col(key) == F.col("_gaddr"), *also], "left").withColumns(
        {c: F.when(hit, F.col("_g")[c]).otherwise(F.col(c)) for c in ("latitude", "longitude")})


def _fill_narrow(df: DataFrame, gazetteer: DataFrame, wanted: F.Column) -> DataFrame:
    """The fill beside a gazetteer too large to broadcast: the addresses that
    are wanted meet it, and only the rows that want one are shuffled to the
    result; all others pass.  The input is read once more for each of the two.

    The result has one narrow row per address and is hashed; the rows pass it, where a
    merge would sort them at their full width.  A hash cannot spill, so a gazetteer of
    unknown or too large size is merged after all.  The address's length is a second
    join column: hashed by both, the result is not taken for gathered already, and
    AQE may split the rows of an address that many share.
    """
    need = df.filter(wanted)
    found = _one_each(gazetteer.join(need.select("address").distinct(), "address", "left_semi"))
    found = found.withColumn("_gwidth", F.length("_gaddr"))
    if fits_partitions(gazetteer):
        found = found.hint("shuffle_hash")
    filled = _filled(need.withColumn("_width", F.length("address")), found, "address",
                     F.col("_width") == F.col("_gwidth")).select(*df.columns)
    return df.filter(~wanted).unionByName(filled)


def clean_businesses(df: DataFrame, cities: DataFrame, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
                     gazetteer: DataFrame | None = None, passthrough: list[str] | None = None,
                     null_text: str | None = "None", columns: list[str] | None = None,
                     narrow: bool = False) -> DataFrame:
    """O6-O19 end to end: nested API records -> raw rows.

    ``passthrough`` columns (e.g. ``term``, ``location_index``) are carried
    next to the 13 raw columns.  Filters come first in the text, and Catalyst
    pushes the cheap ones to the scan anyway.  ``narrow``: see :func:`keep_known_cities`.
    """
    passthrough = passthrough or []
    out = with_price(df)
    out = with_aliases(out)
    out = keep_food_and_bars(out, taxonomy)
    out = drop_denied(out, taxonomy)
    out = with_ethnic_category(out, taxonomy)
    out = with_flat_coordinates(out)
    out = keep_known_cities(out, cities, narrow=narrow)
    out = with_city(out)
    out = with_address(out, null_text)
    out = fill_coordinates(out, gazetteer)
    out = strip_address(out)
    return out.select(*(columns or RAW_COLUMNS), *passthrough)


def clean_legacy(df: DataFrame, passthrough: list[str] | None = None,
                 gazetteer: DataFrame | None = None,
                 taxonomy: Taxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """Older variant (12 columns): the nested fields arrive as JSON text, the
    geography rule is state + zip prefix, and there is no ethnic column."""
    from ..schemas import CATEGORY, COORDINATES, LOCATION
    from pyspark.sql import types as T
    out = (df.withColumn("categories", F.from_json("categories", T.ArrayType(CATEGORY)))
             .withColumn("coordinates", F.from_json("coordinates", COORDINATES))
             .withColumn("location", F.from_json("location", LOCATION)))
    out = with_price(out)
    out = with_aliases(out)
    out = keep_food_and_bars(out, taxonomy)
    out = drop_denied(out, taxonomy)
    out = with_flat_coordinates(out)
    out = keep_zip_prefix(out)
    out = with_city(out)
    out = with_address(out)
    out = strip_address(out)
    out = fill_coordinates(out, gazetteer)
    # The older store keeps the alias list as JSON text.
    out = out.withColumn("categories", F.to_json("categories"))
    return out.select(*LEGACY_CLEAN_COLUMNS, *(passthrough or []))

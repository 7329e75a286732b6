"""Adapter from the benchmark tables to listings inputs.

The benchmark data has no business listings, so they are derived (every
query's work grows with the tables):

* search hits (D3 records)  <- ``lineitem`` join ``part`` (a part is a
  business, each of its line items one search hit, so an id repeats ~30x and
  its hits differ in price, url, address and review count);
* city list (D1)            <- ``customer``, some names with odd spelling;
* county list (D2)          <- ``customer`` with its nation's region, some
  cities left out (the inner join drops them), some listed twice with two zip
  codes (the join multiplies them);
* gazetteer (F8)            <- half of the parts whose hits lack coordinates;
* search locations          <- ``customer`` (a long location list for the
  request plan and the slices).

Every cleaning and labelling rule decides some rows: addresses have missing
and empty parts, cities double spaces, commas and trailing blanks, zip codes
other first digits, and the category lists reach every rule.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import sized_shuffles


#: Columns read of each benchmark table; with them no read infers a schema.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double",
    "events": "event_id bigint, event_type string, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


# FIXED VALUES of the adapter: category lists by p_partkey % 37, titles of the
# aliases used, and the search term by line number.
CATEGORY_LISTS = [
    "restaurants", "mexican,tacos", "coffee", "coffee,desserts", "cafes,breakfast_brunch",
    "bubbletea", "desserts,icecream", "pizza,italian", "grocery,food", "gyms",
    "desserts,burgers", "japanese,sushi,bars", "steak", "coffee,coffeeroasteries",
    "desserts,wine_bars", "hotdogs,icecream", "desserts,breweries", "brewpubs",
    "coffee,sandwiches", "foodtrucks,desserts", "sandwiches,coffee", "farmersmarket,bakeries",
    "poke", "pretzels,desserts", "chicken_wings", "desserts,juicebars,coffee",
    "vietnamese,juicebars,bubbletea", "vietnamese,juicebars,desserts", "vietnamese",
    "meats,bakeries", "wineries", "winetastingroom", "drugstores,tea", "convenience,coffee",
    "cafes", "juicebars", "italian,italian,thai",
]
CATEGORY_TITLES = {
    "bakeries": "Bakeries", "bars": "Bars", "breakfast_brunch": "Breakfast & Brunch",
    "breweries": "Breweries", "brewpubs": "Brewpubs", "bubbletea": "Bubble Tea",
    "burgers": "Burgers", "cafes": "Cafes", "chicken_wings": "Chicken Wings",
    "coffee": "Coffee & Tea", "coffeeroasteries": "Coffee Roasteries",
    "convenience": "Convenience Stores", "desserts": "Desserts", "drugstores": "Drug Stores",
    "farmersmarket": "Farmers Market", "food": "Food", "foodtrucks": "Food Trucks",
    "grocery": "Grocery", "gyms": "Gyms", "hotdogs": "Fast Food",
    "icecream": "Ice Cream & Frozen Yogurt", "italian": "Italian", "japanese": "Japanese",
    "juicebars": "Juice Bars & Smoothies", "meats": "Meat Shops", "mexican": "Mexican",
    "pizza": "Pizza", "poke": "Poke", "pretzels": "Pretzels", "restaurants": "Restaurants",
    "sandwiches": "Sandwiches", "steak": "Steakhouses", "sushi": "Sushi Bars", "tacos": "Tacos",
    "tea": "Tea Rooms", "thai": "Thai", "vietnamese": "Vietnamese", "wine_bars": "Wine Bars",
    "wineries": "Wineries", "winetastingroom": "Wine Tasting Room",
}
TERMS_BY_LINE = [(2, "Restaurants"), (3, "Food"), (5, "Coffee & Tea"), (6, "Desserts")]
OTHER_TERMS = ["Bakeries", "Juice Bars & Smoothies", "Bubble Tea"]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _by_mod(key: str, values: list) -> str:
    """``values[key % len(values)]`` (None: null)."""
    whens = " ".join(f"when {i} then {'null' if v is None else _quoted(v)}" for i, v in enumerate(values))
    return f"case {key} % {len(values)} {whens} end"


def _term(line: str, order: str) -> str:
    whens = " ".join(f"when {line} <= {upto} then {_quoted(term)}" for upto, term in TERMS_BY_LINE)
    return f"case {whens} else {_by_mod(order, OTHER_TERMS)} end"


def city_name(k: str) -> str:
    """City ``k`` as landed: one in ten of the cities used is spelled with two
    spaces, one with a comma, one with a trailing blank."""
    n = f"cast({k} as string)"
    return (f"case {k} % 100 when 10 then concat('City  ', {n}) when 20 then concat('City ', {n}, ',') "
            f"when 30 then concat('City ', {n}, ' ') else concat('City ', {n}) end")


#: Location of part ``p_partkey`` (shared by hits and gazetteer).  Three parts
#: stand for four customers, so city keys stay inside ``customer``.
LOCATION_SQL = f"""named_struct(
    'address1', case when p_partkey % 19 = 0 then null when p_partkey % 29 = 0 then ''
                     else concat(cast(p_partkey % 900 + 1 as string), ' Main St') end,
    'address2', case p_partkey % 3 when 0 then null when 1 then '' else concat('Ste ', cast(p_partkey % 7 as string)) end,
    'city', case when p_partkey % 27 = 0 then 'Nowhere'
                 else {city_name("(cast(floor(p_partkey * 3 / 40) as bigint) * 10)")} end,
    'state', if(p_partkey % 11 = 0, 'NV', 'CA'),
    'zip_code', case when p_partkey % 23 = 0 then null
                     when p_partkey % 17 = 0 then concat('8', cast(p_partkey % 27 + 1000 as string))
                     else concat('9', cast(p_partkey % 27 + 1000 as string)) end)"""


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: every attribute of the business that does not depend
    on the individual search hit, computed once per business.

    The ``id`` has the part key as text, ``b_width`` its length.  Joined by them,
    a filter on an attribute stays on this side: with the number itself as the
    key, the optimizer would rewrite every such filter in terms of ``l_partkey``
    and evaluate it once per line item as well (30x the rows).  The columns are
    SQL text: one call to the JVM each, and not one for every operator in them.
    """
    key = "cast(p_partkey as string)"
    alias = (f"if(p_partkey % 10 = 4 and p_partkey % 3 = 0, 'pho', "
             f"concat(replace(p_name, ' ', '-'), '-', {key}))")
    phone = "lpad(cast(p_partkey % 10000000 as string), 7, '0')"
    return table(spark, sf_dir, "part").selectExpr(
        f"length({key}) as b_width",
        f"concat('b', {key}) as id",
        f"{alias} as alias",
        "case p_partkey % 10 when 3 then concat('Cafe ', p_name) when 4 then concat('Pho ', p_name) "
        "when 5 then concat('Coffee ', p_name) else p_name end as name",
        f"concat('img/b', {key}, '.jpg') as image_url",
        "false as is_closed",
        f"concat('biz/', {alias}) as url",
        f"{_categories('p_partkey')} as categories",
        "1D + cast(p_size % 9 as double) / 2D as rating",
        "named_struct('latitude', if(p_partkey % 25 = 0, null, 33D + cast(p_partkey % 997 as double) / 1000D), "
        "'longitude', if(p_partkey % 50 = 0, null, -118D - cast(p_partkey % 991 as double) / 1000D)) as coordinates",
        "if(p_partkey % 2 = 0, array('pickup', 'delivery'), cast(array() as array<string>)) as transactions",
        f"{_by_mod('p_partkey', [None, '$', '$$', '$$$'])} as price",
        f"{LOCATION_SQL} as location",
        f"concat('+1555', {phone}) as phone",
        f"concat('(555) ', {phone}) as display_phone")


def _categories(key: str) -> str:
    """``array<struct<alias,title>>`` by ``key % 37``: each branch is a literal
    array, so the optimizer folds any function of it (aliases, set tests)
    branch by branch instead of evaluating it per row."""
    branches = []
    for i, cats in enumerate(CATEGORY_LISTS):
        items = ", ".join(f"named_struct('alias', {_quoted(a)}, 'title', {_quoted(CATEGORY_TITLES[a])})"
                          for a in cats.split(","))
        branches.append(f"when {key} % {len(CATEGORY_LISTS)} = {i} then array({items})")
    return f"case {' '.join(branches)} end"


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 records with ``term`` and ``location_index`` (the searched city).

    Business attributes come from :func:`businesses` and only the per-hit
    fields from ``lineitem``: the review count (often tied, sometimes NULL),
    and changes of url, price and address, so hits of one id differ.

    ``part`` grows with the data (one row per 30 hits), so it is joined the
    way it must be at scale: a sort-merge join on the business id, whose skewed
    keys AQE splits.  Hashing the hits over the shuffle partitions also
    spreads the cleaning work evenly whatever the scan's file layout (a
    single large row group would otherwise feed one task).

    The hits leave the join some 50 times as wide as they came, in its order by
    id, so a pick by id combines them as they pass; a sort of them by another
    column holds gigabytes in a task.  The key's length is a second join column:
    hashed by both, the hits of one id are not taken for gathered already, and a
    skewed id may still be split.  The line items' size sets the number of shuffle
    partitions (see ``sized_shuffles``).
    """
    li = sized_shuffles(table(spark, sf_dir, "lineitem")).selectExpr(
        "l_orderkey", "concat('b', cast(l_partkey as string)) as l_id", "l_suppkey", "l_linenumber", "l_quantity",
        "length(cast(l_partkey as string)) as l_width")
    biz = businesses(spark, sf_dir)
    hit = {
        "url": "concat(url, '?v=', cast(l_orderkey % 3 as string)) as url",
        "price": "if(l_linenumber % 2 = 1, price, null) as price",
        "location": "named_struct('address1', if(l_orderkey % 4 = 1, concat(location.address1, ' #2'), "
                    "location.address1), 'address2', location.address2, 'city', location.city, "
                    "'state', location.state, 'zip_code', location.zip_code) as location",
    }
    cols = [hit.get(c, c) for c in biz.columns if c != "b_width"]
    return li.join(biz.hint("merge"), (li["l_id"] == biz["id"]) & (li["l_width"] == biz["b_width"])).selectExpr(
        *cols[:6],
        "if(l_quantity > 1, cast(floor(l_quantity / 10) as bigint), null) as review_count",
        *cols[6:],
        "cast(l_linenumber as double) * 250D as distance",
        f"{_term('l_linenumber', 'l_orderkey')} as term",
        "cast(l_suppkey as int) as location_index",
        "l_orderkey")


def city_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, one city per customer with its position; half of the oddly spelled
    names are listed in their plain spelling too."""
    plain, listed = "concat('City ', cast(c_custkey as string))", city_name("c_custkey")
    return table(spark, sf_dir, "customer").selectExpr(
        f"explode(if({listed} <> {plain} and c_custkey % 200 < 100, array({listed}, {plain}), array({listed}))) as Name",
        "32.5D + cast(c_custkey % 997 as double) / 1000D as Latitude",
        "-124D + cast(c_custkey % 991 as double) / 1000D as Longitude",
        "c_custkey as position")


def county_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2, one entity per customer, county = its region; keys ``k % 40 = 0``
    are left out and ``k % 40 = 10`` have two zip codes.  ``nation`` and
    ``region`` have 25 and 5 rows by the benchmark's definition."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").filter("c_custkey % 40 <> 0")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region")
    geo = F.broadcast(n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]))
    j = c.join(geo, c["c_nationkey"] == geo["n_nationkey"])
    zips = "if(c_custkey % 40 = 10, array(c_custkey % 10000, (c_custkey + 5000) % 10000), array(c_custkey % 10000))"
    city = "concat('City ', cast(c_custkey as string))"
    return j.selectExpr("*", f"explode({zips}) as zip").selectExpr(
        f"concat('City of ', {city}) as `Entity Name`", "c_custkey as `Entity ID`", "'City' as `Entity Type`",
        "r_name as `County Name`", f"{city} as City", "'CA' as State",
        "concat('9', lpad(cast(zip as string), 4, '0')) as Zip", "c_custkey * 10 as `Estimated Population`",
        "'General Law' as `Class Data`", "630L as `Fiscal Year End`", "20240131L as `Paper Report Due Date`",
        "20240131L as `Electronic Report Due Date`")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: address -> coordinates for half of the parts whose hits have none
    (p_partkey % 100 == 0); the other half stays unresolved."""
    part = table(spark, sf_dir, "part").filter("p_partkey % 100 = 0").selectExpr("p_partkey", f"{LOCATION_SQL} as location")
    return part.withColumn("address", C.build_address("location")).selectExpr(
        "address", "36D + cast(p_partkey % 89 as double) / 100D as latitude",
        "-120D - cast(p_partkey % 83 as double) / 100D as longitude")


def search_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location list that grows with the data: one per customer, with its
    stored position (the customer key)."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name as Name", "32.5D + cast(c_custkey % 997 as double) / 1000D as Latitude",
        "-124D + cast(c_custkey % 991 as double) / 1000D as Longitude", "c_custkey as position")

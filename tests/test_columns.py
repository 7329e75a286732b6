"""Column rules: the quirks of the source pipeline's Python and SQL rules."""

from pyspark.sql import functions as F

from foodgrid.functions import columns as C
from foodgrid.functions import taxonomy as T


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_normalize_city_python_semantics(spark):
    data = [("San  Jose",), ("San   Jose",), ("San    Jose",), ("Los Angeles,",),
            ("Torrance\t",), ("Torrance 　",), (None,)]
    got = one(spark, C.normalize_city("c"), data, "c string")
    # Single left-to-right pass: 3 spaces -> 2, 4 spaces -> 2.
    assert got == ["san jose", "san  jose", "san  jose", "los angeles", "torrance", "torrance", None]


def test_build_address_branches_and_none_text(spark):
    schema = "l struct<address1:string,address2:string,city:string,state:string,zip_code:string>"
    data = [(("1 Main St", None, "San  Jose ", "CA", "95112"),),
            (("1 Main St", "", "San Jose", "CA", "95112"),),
            (("1 Main St", "Ste 2", "San  Jose,", "CA", "95112"),),
            ((None, None, "San Jose", "CA", None),)]
    got = one(spark, C.build_address("l"), data, schema)
    assert got == ["1 Main St, San  Jose CA 95112",        # short form: city only right-stripped
                   "1 Main St, San Jose CA 95112",
                   "1 Main St Ste 2, San Jose CA 95112",   # long form: squeezed, comma dropped
                   "None, San Jose CA None"]               # str(None) parity
    clean = one(spark, C.build_address("l", null_text=""), data[3:], schema)
    assert clean == [", San Jose CA "]


def test_lstrip_address(spark):
    got = one(spark, C.lstrip_address("a"), [(", San Jose CA 95112",), (" ,, x",), ("x, y",)],
              "a string")
    assert got == ["San Jose CA 95112", "x", "x, y"]


def test_any_in_treats_null_element_as_absent(spark):
    data = [(["coffee", None],), ([None],), (["gyms"],), ([],), (None,)]
    got = one(spark, C.any_in("a", T.FOOD_AND_BAR_ALIASES), data, "a array<string>")
    assert got == [True, False, False, False, False]
    kept = one(spark, C.not_denied("a"), [(["grocery", None],), (["pizza", None],)], "a array<string>")
    assert kept == [False, True]


def test_ethnic_subset_order_duplicates_default(spark):
    data = [(["thai", "pizza", "mexican", "thai"],), (["pizza"],), ([],)]
    got = one(spark, C.ethnic_subset("a"), data, "a array<string>")
    assert got == [["thai", "mexican", "thai"], ["Not Specified"], ["Not Specified"]]


def test_array_to_string(spark):
    data = [(["a", None, "b"],), ([],), (None,)]
    assert one(spark, C.array_to_string("a"), data, "a array<string>") == ["a, b", "", ""]


def test_coordinate_key(spark):
    data = [(37.0, -121.5), (None, 1.0)]
    assert one(spark, C.coordinate_key("x", "y"), data, "x double, y double") == ["37.0,-121.5", None]


def test_first_word(spark):
    data = [("Juice Bars & Smoothies",), ("Bubble Tea",), ("Bakeries",), (" Lead",)]
    assert one(spark, C.first_word("t"), data, "t string") == ["Juice", "Bubble", "Bakeries", ""]


def test_dessert_rules(spark):
    data = [("coffee", "a"), ("coffee, desserts", "b"), ("desserts, pizza", "c"),
            ("desserts", "pho"), ("desserts", "pho-house"), ("coffee, sandwiches", "d"),
            ("wine_bars, desserts", "e"), (None, "f"), ("desserts", None)]
    got = one(spark, C.dessert_keep("c", "a"), data, "c string, a string")
    assert got == [False, True, False, False, True, False, False, None, None]


def test_cafe_rules(spark):
    data = [("coffee", "x"), ("coffee, pizza", "x"), ("steak", "x"), ("themedcafes", "x"),
            (None, "x"), ("desserts, juicebars, coffee", "x"), ("pizza", "Cafe X")]
    got = one(spark, C.cafe_keep("c", "n"), data, "c string, n string")
    # '%tea%' matches steak; '%cafes%' matches themedcafes (kept as modelled).
    assert got[:4] == [True, False, True, True]
    assert got[4] is None and got[5] is True and got[6] is False


def test_taxonomy_facts():
    assert len(T.DENY_ALIASES) == 3 and len(T.ETHNIC_ALIASES) == 104
    assert len(T.FOOD_AND_BAR_ALIASES) == 211
    assert set(T.ETHNIC_ALIASES) <= set(T.FOOD_AND_BAR_ALIASES)
    assert not set(T.DENY_ALIASES) & set(T.FOOD_AND_BAR_ALIASES)


def test_classify_alias(spark):
    flags = spark.createDataFrame([("thai",), ("grocery",), ("gyms",)], "a string") \
        .select(T.classify_alias(F.col("a")).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in flags] == [(True, False, True), (False, True, False),
                                         (False, False, False)]

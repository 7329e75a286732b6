"""Property tests: the Spark column rules agree with plain Python statements
of the same rules on random text (odd whitespace, commas, NULLs)."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from foodgrid.functions import columns as C
from foodgrid.functions import taxonomy as T

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


CITIES = [  # city as landed, city as stored
    ("San  Jose", "san jose"), ("San   Jose", "san  jose"), ("San    Jose", "san  jose"),
    ("Los Angeles,", "los angeles"), ("LA\t", "la"), ("Ñuñoa \u3000", "ñuñoa"), (", ,", ""), ("", ""),
]
ADDRESSES = [  # address1, address2, city, state, zip, address as stored
    ("1 Ave", None, "San Jose ", "CA", "95002", "1 Ave, San Jose CA 95002"),
    ("1 Ave", "", "San  Jose,", "CA", "95002", "1 Ave, San  Jose, CA 95002"),
    ("1 Ave", "Ste 2", "San  Jose, ", "CA", "95002", "1 Ave Ste 2, San Jose CA 95002"),
    (None, None, "LA", None, None, "None, LA None None"),
    ("", "", "LA", "CA", "9", "LA CA 9"),
    (", 5 St", None, "LA", "CA", "9", "5 St, LA CA 9"),
]


def test_city_as_stored(spark):
    df = spark.createDataFrame(CITIES, "c string, want string")
    assert [r for r in df.select("c", "want", C.normalize_city("c").alias("got")).collect()
            if r["got"] != r["want"]] == []


def test_address_as_stored(spark):
    schema = ("l struct<address1:string,address2:string,city:string,state:string,zip_code:string>, "
              "want string")
    df = spark.createDataFrame([(x[:5], x[5]) for x in ADDRESSES], schema)
    got = df.select("want", C.lstrip_address(C.build_address("l")).alias("got")).collect()
    assert [r for r in got if r["got"] != r["want"]] == []


alias = st.one_of(st.none(), st.sampled_from(
    ["thai", "pizza", "grocery", "gyms", "mexican", "coffee", "drugstores", "zzz"]))


@settings(**SETTINGS)
@given(st.lists(st.lists(alias, max_size=5), min_size=1, max_size=30))
def test_category_rules_match_python(spark, lists):
    allow, deny, eth = set(T.FOOD_AND_BAR_ALIASES), set(T.DENY_ALIASES), set(T.ETHNIC_ALIASES)
    df = spark.createDataFrame([(x,) for x in lists], "a array<string>")
    got = df.select(C.allowed("a"), C.not_denied("a"), C.ethnic_subset("a")).collect()
    for x, r in zip(lists, got):
        sub = [c for c in x if c in eth]
        assert r[0] == any(c in allow for c in x)
        assert r[1] == (not any(c in deny for c in x))
        assert list(r[2]) == (sub if sub else ["Not Specified"])


@settings(**SETTINGS)
@given(st.lists(st.lists(st.sampled_from(["a", "b c", " d"]), min_size=1, max_size=4)
                .map(" ".join), min_size=1, max_size=20))
def test_first_word_matches_python(spark, terms):
    import re
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    got = [r[0] for r in df.select(C.first_word("t")).collect()]
    assert got == [re.split(r"\s+", t)[0] for t in terms]

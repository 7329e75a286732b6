"""Column -> Column building blocks, all JVM-side built-ins (no UDFs).

Each function reproduces one cleaning or modelling rule of the source
pipeline; quirks that change results are kept on purpose and noted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .taxonomy import DEFAULT_TAXONOMY, NO_ETHNIC_LABEL, Taxonomy

# Characters Python's str.rstrip() removes (the str.isspace set; all lie
# below U+3001).  Java's \s covers only the ASCII subset, so the set is built
# from Python's own rule and used with rtrim(str, chars).
_PY_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- categories -------------------------------------------------------------

def category_aliases(categories) -> Column:
    """``array<struct<alias,title>>`` -> ``array<string>`` of aliases
    (field extraction over the array; code-generated, no lambda)."""
    return _c(categories).getField("alias")


def _in(members) -> str:
    """``IN`` list of a set, as SQL text: one call to the JVM, not one for each member."""
    return "in (" + ", ".join("'" + m.replace("\\", "\\\\").replace("'", "\\'") + "'" for m in members) + ")"


def any_in(values: str, members) -> Column:
    """True when any element of the column ``values`` is in ``members`` (a list).

    ``x IN (literals)`` becomes a hash-set lookup (InSet) in the optimizer.
    A NULL element is "not in the set", as in the Python rule, so the NULL
    that ``exists`` yields for it collapses to false.
    """
    return F.expr(f"coalesce(exists({values}, x -> x {_in(members)}), false)")


def allowed(aliases: str, taxonomy: Taxonomy = DEFAULT_TAXONOMY) -> Column:
    """Keep when any alias is a food or bar category."""
    return any_in(aliases, taxonomy.allow)


def not_denied(aliases: str, taxonomy: Taxonomy = DEFAULT_TAXONOMY) -> Column:
    """Drop when any alias is on the deny-list."""
    return ~any_in(aliases, taxonomy.deny)


def ethnic_subset(aliases: str, taxonomy: Taxonomy = DEFAULT_TAXONOMY) -> Column:
    """Ethnic aliases in original order, duplicates kept, or the label.

    ``filter`` (not ``array_intersect``, which de-duplicates).
    """
    sub = f"filter({aliases}, x -> coalesce(x {_in(taxonomy.ethnic)}, false))"
    return F.expr(f"if(size({sub}) > 0, {sub}, array('{NO_ETHNIC_LABEL}'))")


def array_to_string(arr, sep: str = ", ") -> Column:
    """Join skipping NULL elements; an empty or NULL array gives ''."""
    return F.coalesce(F.array_join(_c(arr), sep), F.lit(""))


# --- location text ------------------------------------------------------------

def rstrip_space(s) -> Column:
    """Python ``str.rstrip()``: drop trailing whitespace of any kind."""
    return F.rtrim(_c(s), F.lit(_PY_SPACE))


def squeeze_city(s) -> Column:
    """Double space -> one (single left-to-right pass, so four become two),
    then commas removed.  Case is kept."""
    return F.replace(F.replace(_c(s), F.lit("  "), F.lit(" ")), F.lit(","), F.lit(""))


def normalize_city(city) -> Column:
    """Squeeze, lower-case, right-strip whitespace."""
    return rstrip_space(F.lower(squeeze_city(city)))


def build_address(location, null_text: str | None = "None") -> Column:
    """``address1[ address2], city state zip``.

    Without ``address2`` (NULL or '') the city is only right-stripped; with it
    the city is also squeezed.  A NULL part prints as ``null_text`` ('None',
    as Python's ``str(None)`` does); pass ``null_text=''`` for clean text.
    """
    loc = _c(location)

    def txt(c: Column) -> Column:
        return c if null_text is None else F.coalesce(c, F.lit(null_text))

    a1, a2 = loc["address1"], loc["address2"]
    city, state, zipc = loc["city"], loc["state"], loc["zip_code"]
    tail = [F.lit(" "), txt(state), F.lit(" "), txt(zipc)]
    short = F.concat(txt(a1), F.lit(", "), txt(rstrip_space(city)), *tail)
    long = F.concat(txt(a1), F.lit(" "), a2, F.lit(", "),
                    txt(rstrip_space(squeeze_city(city))), *tail)
    return F.when(a2.isNull() | (a2 == F.lit("")), short).otherwise(long)


def lstrip_address(address) -> Column:
    """Strip any leading run of commas and spaces."""
    return F.regexp_replace(_c(address), r"^[, ]+", "")


def coordinate_key(lat, lon) -> Column:
    """``'lat,lon'`` text of the FLOAT columns; NULL if either is NULL."""
    return F.concat(_c(lat).cast("string"), F.lit(","), _c(lon).cast("string"))


def first_word(term) -> Column:
    """First whitespace-separated word of a search term (table routing)."""
    return F.split(_c(term), r"\s+").getItem(0)


# --- fact rules -----------------------------------------------------------------

# FIXED VALUES: dessert exclusion.  A dessert shop is dropped when its joined
# categories equal EXACT, or match any LIKE pattern (the repeated pattern is
# kept as given), or its alias matches the alias pattern.
DESSERT_EXCLUDED_EXACT = "coffee"
DESSERT_EXCLUDED_LIKE = [
    "%coffeeroasteries%", "%wine%", "%burgers%", "%hotdogs%", "%breakfast_brunch%",
    "%breweries%", "%brewpubs%", "%pizza%", "%coffee, sandwiches%", "%foodtrucks%",
    "%sandwiches, coffee%", "%coffee, sandwiches%", "%market%", "%poke%", "%pretzel%",
    "%chicken%",
]
DESSERT_EXCLUDED_ALIAS_LIKE = "pho"

# FIXED VALUES: cafe inclusion.  A cafe is kept when any rule holds; a rule is
# (LIKE patterns all on categories, LIKE pattern on lower(name) or None,
# whether categories must be a single comma piece).
CAFE_RULES = [
    (["%desserts%", "%juicebars%", "%coffee%"], None, False),
    (["%cafes%"], None, False),
    (["%cafes%"], "%cafe%", False),
    (["%cafes%"], "%coffee%", False),
    (["%coffee%", "%desserts%"], None, False),
    (["%coffee%"], None, True),
    (["%tea%"], None, False),
]


def dessert_keep(categories, alias) -> Column:
    """Every exclusion conjunct must be true; NULL drops the row."""
    cats = _c(categories)
    cond = cats != F.lit(DESSERT_EXCLUDED_EXACT)
    for p in DESSERT_EXCLUDED_LIKE:
        cond = cond & ~cats.like(p)
    return cond & ~_c(alias).like(DESSERT_EXCLUDED_ALIAS_LIKE)


def cafe_keep(categories, name) -> Column:
    """Any inclusion rule holds (``%tea%`` also matches steak etc.)."""
    cats, lname = _c(categories), F.lower(_c(name))
    out = None
    for pats, name_pat, single in CAFE_RULES:
        term = None
        for p in pats:
            t = cats.like(p)
            term = t if term is None else term & t
        if name_pat is not None:
            term = lname.like(name_pat) & term
        if single:
            term = term & (F.size(F.split(cats, ",")) == 1)
        out = term if out is None else out | term
    return out

"""Keyterm labelling of the older analysis.

Works on category *titles* joined with ', '.  Patterns are regular
expressions (searched, not anchored), so ``American (Traditional)`` is a
group and never matches the literal text with parentheses, as in the
original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import array_to_string

# FIXED VALUES: default label, titles that drop a row, and the override rules
# in the order they are applied (the last matching rule wins).  A rule is
# (patterns that must all match the categories, pattern on the name or None,
# label).
KEYTERM_DEFAULT = "Desserts/Teas/Cafes/Bakeries"
KEYTERM_DROP = ["Grocery", "Drug Store", "Convenience Store"]
KEYTERM_RULES = [
    (["Breweries"], None, "Restaurants"),
    (["Food Trucks"], None, "Restaurants"),
    (["Burgers"], None, "Restaurants"),
    (["Bars"], None, "Restaurants"),
    (["Juice Bars"], None, "Desserts/Teas/Cafes/Bakeries"),
    (["Breakfast & Brunch"], None, "Restaurants"),
    (["Chicken"], None, "Restaurants"),
    (["American (Traditional)"], None, "Restaurants"),
    (["Vietnamese"], None, "Restaurants"),
    (["Vietnamese", "Juice Bars", "Bubble Tea"], None, "Desserts/Teas/Cafes/Bakeries"),
    (["Vietnamese", "Juice Bars", "Desserts"], None, "Desserts/Teas/Cafes/Bakeries"),
    (["Vietnamese"], "Pho", "Restaurants"),
    (["Meat"], None, "Restaurants"),
    (["Wineries"], None, "Attractions"),
    (["Wine Tasting"], None, "Attractions"),
]


def category_titles_text(categories) -> Column:
    """Titles of ``array<struct<alias,title>>`` joined with ', ' (O40)."""
    c = F.col(categories) if isinstance(categories, str) else categories
    return array_to_string(F.transform(c, lambda x: x["title"]))


def cat_len(text) -> Column:
    """Number of comma-separated pieces."""
    t = F.col(text) if isinstance(text, str) else text
    return F.size(F.split(t, ","))


def keyterm_keep(text) -> Column:
    """False when the categories mention a dropped title."""
    t = F.col(text) if isinstance(text, str) else text
    cond = None
    for p in KEYTERM_DROP:
        c = ~t.rlike(p)
        cond = c if cond is None else cond & c
    return cond


def keyterm_label(text, name) -> Column:
    """One CASE over the rules in reverse order, so the last matching
    rule wins."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.col(name) if isinstance(name, str) else name
    expr = None
    for pats, name_pat, label in reversed(KEYTERM_RULES):
        cond = None
        for p in pats:
            c = t.rlike(p)
            cond = c if cond is None else cond & c
        if name_pat is not None:
            cond = cond & n.rlike(name_pat)
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(KEYTERM_DEFAULT))


def keyterms(df: DataFrame, categories: str = "categories", name: str = "name") -> DataFrame:
    """O40-O42 together: text, cat_len, drop rule, label."""
    out = df.withColumn("categories_text", category_titles_text(categories))
    out = out.withColumn("cat_len", cat_len("categories_text"))
    out = out.filter(keyterm_keep("categories_text"))
    return out.withColumn("keyterm", keyterm_label("categories_text", name))

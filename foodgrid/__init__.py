"""foodgrid: Spark-native listings analytics.

A library of DataFrame operators (cleaning, staging, marts, data-quality)
and a batch pipeline that composes them: plan searches over terms and
cities, assemble landed pages, clean nested business records, append to a
raw table, stage typed views with a deterministic de-duplication, and
build one fact table of restaurants, cafes and dessert shops joined to
city and county dimensions.
"""

__all__ = ["session", "schemas"]

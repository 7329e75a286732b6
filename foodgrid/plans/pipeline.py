"""The batch pipeline as plain function composition (no DAG runner).

    request plan -> (external landing) -> page assembly -> landing files
    landing files -> clean -> raw table (append, partitioned by feed)
    raw table -> staging views -> fact table (+ dimensions)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import columns as C
from ..functions.taxonomy import DEFAULT_TAXONOMY, Taxonomy
from ..operators import clean, marts
from ..schemas import RAW_COLUMNS


def raw_rows(hits: DataFrame, cities: DataFrame, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
             gazetteer: DataFrame | None = None, passthrough: list[str] | None = None,
             narrow: bool = False) -> DataFrame:
    """Nested hits (with ``term``) -> raw rows with the routing column
    ``feed`` (first word of the term, S14).  ``narrow``: for stored hits, see
    :func:`foodgrid.operators.clean.keep_known_cities`."""
    keep = list(passthrough or [])
    extra = ["term"] + [c for c in keep if c != "term"]
    out = clean.clean_businesses(hits, cities, taxonomy, gazetteer, passthrough=extra, narrow=narrow)
    return out.withColumn("feed", C.first_word("term")).select(*RAW_COLUMNS, "feed", *keep)


def build_fact(raw: DataFrame, cities: DataFrame, counties: DataFrame) -> DataFrame:
    """Raw table -> fact table (fused single-shuffle plan)."""
    return marts.fact_from_raw(raw, cities, counties)

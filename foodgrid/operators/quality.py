"""Data-quality checks and load counters."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _enforce(violations: DataFrame, what: str, severity: str) -> DataFrame:
    if severity not in ("warn", "error"):
        raise ValueError("severity must be 'warn' or 'error'")
    if violations.limit(1).count() > 0:
        if severity == "error":
            raise AssertionError(f"data test failed: {what}")
        log.warning("data test failed (warn): %s", what)
    return violations


def unique_violations(df: DataFrame, column: str = "id") -> DataFrame:
    """Values of ``column`` occurring more than once, with their count
    (partial aggregation: hot values are combined before the shuffle)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def not_null_violations(df: DataFrame, column: str = "id") -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def assert_unique(df: DataFrame, column: str = "id", severity: str = "warn") -> DataFrame:
    """O31 unique test; ``warn`` logs, ``error`` raises.  Returns violations."""
    return _enforce(unique_violations(df, column), f"unique({column})", severity)


def assert_not_null(df: DataFrame, column: str = "id", severity: str = "warn") -> DataFrame:
    """O31 not_null test; ``warn`` logs, ``error`` raises.  Returns violations."""
    return _enforce(not_null_violations(df, column), f"not_null({column})", severity)


def id_report(tables: dict[str, DataFrame], column: str = "id") -> DataFrame:
    """Per table the repeated values and the NULLs of ``column``: the O31
    tests of several models in one job."""
    rows = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("table"), F.col(column).cast("string").alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    per_value = rows.groupBy("table", "value").agg(F.count(F.lit(1)).alias("n"))
    null = F.col("value").isNull()
    return per_value.groupBy("table").agg(
        F.count_if((F.col("n") > 1) & ~null).alias("repeated"),
        F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("nulls"))


def assert_ids(tables: dict[str, DataFrame], column: str = "id", severity: str = "warn") -> None:
    """O31 unique and not_null of ``column`` for several models at once."""
    _enforce(id_report(tables, column).filter("repeated > 0 or nulls > 0"),
             f"unique, not_null({column})", severity)


#: Locations whose running total is one task's work.
LOCATION_BLOCK = 4096


def load_counts(raw: DataFrame, terms: list[str] | None = None, term_col: str = "term",
                location_col: str = "location_index", pairs: DataFrame | None = None) -> DataFrame:
    """Rows loaded per (term, location) and the running total in load
    order (term order of the run, then location), reset per run only.
    Without ``terms`` the run order is the term name.  ``pairs`` are the pairs
    the run asked for: one that landed no row, or lost them all, counts 0.

    A two-level prefix sum: a running window per block of locations, plus
    the totals of the blocks before it (one row per term and block).  No
    window puts all pairs, or all of a term, into one task.
    """
    order = (F.array_position(F.array(*[F.lit(t) for t in terms]), F.col(term_col))
             if terms else F.lit(0)).cast("int")
    counts = raw.groupBy(term_col, location_col).agg(F.count(F.lit(1)).alias("row_count"))
    if pairs is not None:
        counts = (pairs.select(term_col, location_col).distinct()
                       .join(counts, [term_col, location_col], "left")
                       .withColumn("row_count", F.coalesce("row_count", F.lit(0))))
    block = F.floor(F.col(location_col) / LOCATION_BLOCK).alias("_block")
    counts = counts.select("*", order.alias("_term_order"), block)
    keys = ["_term_order", term_col, "_block"]
    per_block = counts.groupBy(*keys).agg(F.sum("row_count").alias("_rows"))
    earlier = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(*keys, F.coalesce(
        F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys).orderBy(location_col).rowsBetween(Window.unboundedPreceding, 0)
    return (counts.join(offsets, keys)
                  .withColumn("total_rows", F.col("_before") + F.sum("row_count").over(within))
                  .select(term_col, location_col, "row_count", "total_rows"))

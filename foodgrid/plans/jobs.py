"""Pipeline jobs: what a scheduled run executes.

    ingest(...)  landing files -> cleaned rows -> raw table (append)
    model(...)   raw table -> staging views, dimension and fact tables

Every path is a parameter and must name shared storage on a cluster (object
store or distributed file system); nothing is written to machine-local
folders.  Run as ``python -m foodgrid.plans.jobs ingest|model ...``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import marts, quality, staging
from ..schemas import RAW, RAW_REQUIRED
from ..sinks import writers
from ..sinks.ledger import LedgeredTable
from ..sinks.versions import VersionedTable
from ..sources import files, search
from . import pipeline


def _is_path(raw: str) -> bool:
    return "/" in raw or ":" in raw


def ingest(spark: SparkSession, landing_dir: str, cities_csv: str, raw: str,
           gazetteer_path: str | None = None, counts: str | None = None,
           terms: list[str] | None = None) -> None:
    """Clean every landing file in one scan and append to the raw table.

    ``raw`` is a path or a catalog table name, partitioned by feed.  The
    required columns are checked inside the write.  With ``counts``, a path,
    the load counts of every (term, location) with the running total are
    written there as a table; that is a second pass over the landing data, so
    it is off by default.  ``terms`` are the terms the run searched, in run
    order, by default all of them: every one counts at every location of the
    list, 0 where nothing landed.
    """
    cities = files.read_city_locations(spark, cities_csv, position=False)
    gaz = spark.read.parquet(gazetteer_path) if gazetteer_path else None
    hits = files.read_landing(spark, landing_dir)
    rows = pipeline.raw_rows(hits, cities, gazetteer=gaz, passthrough=["term", "location_index"])
    if _is_path(raw):
        writers.append_raw(rows, raw)
    else:
        writers.append_raw_table(rows, raw)
    if counts:
        terms = list(terms or search.SEARCH_TERMS)
        plan = search.request_pairs(files.read_city_locations(spark, cities_csv), terms)
        pairs = plan.unionByName(hits.select("term", "location_index"))
        writers.materialize(quality.load_counts(rows, terms, pairs=pairs), counts)


RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW.fields)


def raw_ledger(spark: SparkSession, path: str) -> LedgeredTable:
    """The raw table with a ledger at ``path``; its ``rows()`` are the raw rows to model."""
    return LedgeredTable(spark, path, RAW_DDL, required=tuple(RAW_REQUIRED))


def ingest_new(spark: SparkSession, landing_dir: str, cities_csv: str, path: str,
               gazetteer_path: str | None = None) -> int:
    """S13 that can be repeated: clean the landing files that the ledger of the raw
    table at ``path`` does not have yet, or has in another state, and append
    their rows; returns how many files that were."""
    cities = files.read_city_locations(spark, cities_csv, position=False)
    gaz = spark.read.parquet(gazetteer_path) if gazetteer_path else None
    read = lambda paths: files.read_landing(spark, paths).withColumn(
        "file_path", F.col("_metadata.file_path"))
    clean = lambda hits: pipeline.raw_rows(hits, cities, gazetteer=gaz, passthrough=["file_path"])
    return raw_ledger(spark, path).load(landing_dir, read, clean)


def model(spark: SparkSession, raw: str, cities_csv: str, counties_csv: str,
          out_dir: str, dev_limit: int | None = None, ledger: bool = False,
          versions: bool = False) -> dict[str, str]:
    """Build the staging views and the dimension and fact tables from the raw
    table (a path or a catalog table, see :func:`ingest`).

    The staging views are temporary views (no data moves); dimensions and
    the fact are rebuilt in full.  With ``dev_limit`` (O3) the fact is built
    from the capped views, so views and fact agree.  The id tests run with severity warn.
    With ``ledger`` the raw table is one of :func:`ingest_new`; with ``versions``
    each table is a :class:`VersionedTable`, so a build that fails leaves the old one.
    """
    if ledger:
        raw = raw_ledger(spark, raw).rows().drop("batch")
    else:
        raw = files.read_raw(spark, raw) if _is_path(raw) else files.read_raw_table(spark, raw)
    cities = files.read_city_locations(spark, cities_csv, position=False)
    counties = files.read_county_cities(spark, counties_csv)
    views = {"stg_restaurants": staging.stg_restaurants(raw, dev_limit),
             "stg_cafes": staging.stg_cafes(raw, dev_limit),
             "stg_desserts": staging.stg_desserts(raw, dev_limit)}
    for name, df in views.items():
        writers.as_view(df, name)
    quality.assert_ids(views, "id", "warn")
    tables = {"dim_coordinates": marts.dim_coordinates(cities),
              "dim_counties": marts.dim_counties(counties),
              "fact_all": pipeline.build_fact(raw, cities, counties) if dev_limit is None else
              marts.fact_stepwise(views["stg_restaurants"], views["stg_cafes"], views["stg_desserts"],
                                  marts.dim_coordinates(cities), marts.dim_counties(counties))}
    out = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        if versions:
            VersionedTable(spark, path).rebuild(df)
        else:
            writers.materialize(df, path)
        out[name] = path
    return out


def copy_reference_files(spark: SparkSession, cities_csv: str, counties_csv: str,
                         lake_dir: str) -> None:
    """Store the two reference lists in the lake next to the landing
    data (typed, as CSV with header)."""
    for name, df in (("city_locations", files.read_city_locations(spark, cities_csv, False)),
                     ("county_cities", files.read_county_cities(spark, counties_csv))):
        df.write.mode("overwrite").option("header", True).csv(os.path.join(lake_dir, name))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="foodgrid.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("landing_dir"), a.add_argument("cities_csv"), a.add_argument("raw")
    a.add_argument("--gazetteer"), a.add_argument("--counts")
    a.add_argument("--ledger", action="store_true", help="load new and changed files only")
    m = sub.add_parser("model")
    m.add_argument("raw"), m.add_argument("cities_csv"), m.add_argument("counties_csv")
    m.add_argument("out_dir"), m.add_argument("--dev-limit", type=int)
    m.add_argument("--ledger", action="store_true"), m.add_argument("--versions", action="store_true")
    args = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session("foodgrid-" + args.cmd)
    if args.cmd == "ingest" and args.ledger:
        print(ingest_new(spark, args.landing_dir, args.cities_csv, args.raw, args.gazetteer))
    elif args.cmd == "ingest":
        ingest(spark, args.landing_dir, args.cities_csv, args.raw, args.gazetteer,
               args.counts, search.SEARCH_TERMS)
    else:
        print(model(spark, args.raw, args.cities_csv, args.counties_csv, args.out_dir,
                    args.dev_limit, args.ledger, args.versions))


if __name__ == "__main__":
    main()

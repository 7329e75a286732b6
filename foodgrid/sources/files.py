"""File and table sources.

All readers take an explicit schema: no inference pass over the data, and
the same types whatever subset of files is present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.prefix import running_before
from ..schemas import BUSINESS, CITY_LOCATIONS, COUNTY_CITIES, RAW

# Landing file name: ``{term}-{location}-{index}.json``.  Terms hold no '-',
# city names may ("Carmel-By-the-Sea"), so the first group is not greedy
# and the index is anchored at the end.
LANDING_NAME = r"^([^-]*)-(.*)-(\d+)\.json$"


def with_position(df: DataFrame, name: str = "position", ranges: int | None = None) -> DataFrame:
    """Attach the 0-based row position in file order (files by path), JVM-side.

    ``df`` must be a file scan.  A row's place inside its split is its
    ``monotonically_increasing_id`` less the least one of the split (a split is
    read by one task, in order); the rows before its split are a running sum
    over (file, block start).  So neither the order in which splits are dealt to
    tasks nor how many share one matters.
    """
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_mid"))
    splits = tagged.groupBy("_file", "_block").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = running_before(splits, ["_file", "_block"], "_n", "_before", ranges)
    return (tagged.join(before.select("_file", "_block", "_first", "_before"), ["_file", "_block"])
                  .withColumn(name, F.col("_before") + F.col("_mid") - F.col("_first"))
                  .select(*df.columns, name))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV with header; a missing path raises (PATH_NOT_FOUND) and a
    malformed row fails the read instead of turning into NULLs."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("encoding", "UTF-8").csv(path))


def read_city_locations(spark: SparkSession, path: str, position: bool = True) -> DataFrame:
    """City list ``Name, Latitude, Longitude`` (+ file ``position``)."""
    df = read_csv(spark, path, CITY_LOCATIONS)
    return with_position(df) if position else df


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """A typed CSV whose bad rows are told, not fatal: the schema's columns,
    ``line`` (the text of a bad row, else null) and ``reason`` (null for a good row).

    One scan: every field is read as text and cast; a field that its type does
    not take, and a row with more or fewer fields, is a reason.  A bad row has
    its typed columns as far as they could be read.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] +
                        [T.StructField("line", T.StringType())])
    raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "line").option("encoding", "UTF-8").csv(path))
    quoted = lambda n: F.col("`" + n.replace("`", "``") + "`")
    typed = {f.name: quoted(f.name).try_cast(f.dataType) for f in schema}
    wrong = [F.when(quoted(f.name).isNotNull() & typed[f.name].isNull(), F.concat(
        F.lit(f"{f.name}: "), quoted(f.name), F.lit(f" is not {f.dataType.simpleString()}")))
        for f in schema if not isinstance(f.dataType, T.StringType)]
    reason = F.concat_ws("; ", F.when(F.col("line").isNotNull(), F.lit("number of fields")), *wrong)
    reason = F.when(reason != "", reason)
    line = F.when(reason.isNotNull(), F.coalesce("line", F.concat_ws(",", *[
        F.coalesce(quoted(f.name), F.lit("")) for f in schema])))
    return raw.select(*[c.alias(n) for n, c in typed.items()], line.alias("line"), reason.alias("reason"))


def load_checked(spark: SparkSession, path: str, schema: T.StructType, out: str,
                 header: bool = True) -> tuple[DataFrame, DataFrame, dict]:
    """The list at ``path`` stored at ``out``, good rows and rejected
    ones apart, from one scan.  Returns (good, rejected, rows of each)."""
    checked_csv(spark, path, schema, header).withColumn("accepted", F.col("reason").isNull()) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("accepted").parquet(out)
    ddl = T.StructType([*schema.fields, T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()),
                        T.StructField("accepted", T.BooleanType())])
    stored = spark.read.schema(ddl).parquet(out)
    counts = {r["accepted"]: r["count"] for r in stored.groupBy("accepted").count().collect()}
    return (stored.filter("accepted").drop("line", "reason", "accepted"), stored.filter("not accepted").drop("accepted"),
            {"accepted": counts.get(True, 0), "rejected": counts.get(False, 0)})


def read_county_cities(spark: SparkSession, path: str) -> DataFrame:
    """S3: county list; column names contain spaces (use backticks)."""
    return read_csv(spark, path, COUNTY_CITIES)


def read_landing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every landing file under ``path`` (or the files of a list) in one scan.

    Each file is one JSON array of D3 records (multi-line, so a file is one
    split; files hold at most 1000 records).  ``term``, ``search_location`` and
    ``location_index`` come from the file name.
    """
    df = (spark.read.schema(BUSINESS).option("multiLine", True)
          .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path))
    fname = F.url_decode(F.col("_metadata.file_name"))
    return df.select("*", *landing_name_parts(fname))


def landing_name_parts(name) -> list:
    """``term``, ``search_location`` and ``location_index`` of a landing file name."""
    return [F.regexp_extract(name, LANDING_NAME, 1).alias("term"),
            F.regexp_extract(name, LANDING_NAME, 2).alias("search_location"),
            F.regexp_extract(name, LANDING_NAME, 3).cast("int").alias("location_index")]


def read_landing_partitioned(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """S4 for landing written by :func:`foodgrid.sinks.writers.write_landing`
    (NDJSON, partitioned by term and location index); of ``files`` alone, if given."""
    schema = T.StructType(BUSINESS.fields + [T.StructField("term", T.StringType()),
                                             T.StructField("location_index", T.IntegerType())])
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.json(path if files is None else files)


def read_raw(spark: SparkSession, path: str, feeds=None) -> DataFrame:
    """The raw table (parquet partitioned by ``feed``); a feed filter
    prunes partitions at the scan."""
    df = spark.read.schema(RAW).parquet(path)
    return df.filter(F.col("feed").isin(list(feeds))) if feeds else df


def read_raw_table(spark: SparkSession, table: str, feeds=None) -> DataFrame:
    """S5 for the catalog table written by
    :func:`foodgrid.sinks.writers.append_raw_table`."""
    df = spark.table(table)
    return df.filter(F.col("feed").isin(list(feeds))) if feeds else df


def key_ranges(keys: DataFrame, column: str, ranges: int, accuracy: int = 10_000) -> list[str]:
    """Conditions that cut a table into at most ``ranges`` ranges of about
    equal rows by ``column``, and one for its nulls; every row meets exactly one.

    The bounds are approximate quantiles of ``keys``, a column or a sample
    of it, so a skewed key gives even ranges where equal strides would not; one
    value is never cut, so a value with many rows takes fewer ranges.
    """
    at = [i / ranges for i in range(1, ranges)]
    found = keys.agg(F.percentile_approx(column, at, accuracy).alias("q")).first()["q"] if at else None
    bounds = sorted(set(found or []))
    told = [str(b) for b in bounds]
    parts = [f"{column} <= {told[0]}"] if told else [f"{column} is not null"]
    parts += [f"{column} > {a} and {column} <= {b}" for a, b in zip(told[:-1], told[1:], strict=True)]
    parts += [f"{column} > {told[-1]}"] if told else []
    return [*parts, f"{column} is null"]


def fetch_ranges(fetch: Callable[[str], DataFrame], conditions: list[str]) -> DataFrame:
    """The rows that ``fetch`` returns for each condition, one read of its own each."""
    out = fetch(conditions[0])
    for c in conditions[1:]:
        out = out.unionByName(fetch(c))
    return out


def read_ranges(table: DataFrame, column: str, ranges: int) -> DataFrame:
    """S6 on any table: its rows by :func:`key_ranges`, with the number of their
    ``key_range``.  It stands for the fetch of a database, where each range is one query."""
    conditions = key_ranges(table.select(column), column, ranges)
    number = F.lit(None).cast("int")
    for i, c in enumerate(conditions):
        number = F.when(F.expr(c), F.lit(i)).otherwise(number)
    return table.withColumn("key_range", number)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int = 8,
              predicates: list[str] | None = None) -> DataFrame:
    """Full fetch of a relational table: one query for each of ``predicates``
    (see :func:`key_ranges`), or ``num_partitions`` range reads of equal stride
    when a numeric partition column is given (the driver jar must be on the
    cluster's classpath)."""
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties)


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """S6 without a database server: the full table from the catalog (a
    name) or from storage (a path); the scan is split like any file scan."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def parse_json_columns(df: DataFrame, schemas: dict) -> DataFrame:
    """JSON text columns -> typed columns (``from_json``); a malformed
    value gives NULL for that row."""
    out = df
    for col, schema in schemas.items():
        out = out.withColumn(col, F.from_json(F.col(col), schema))
    return out

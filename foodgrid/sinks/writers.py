"""Sinks (S10-S18): landing files, raw-table appends, model tables and the
insert-if-absent load of the older version.

Paths are parameters; on a cluster they must name shared storage.  Loads
raise on failure instead of printing and carrying on.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import Order, asc, first_per_key
from ..schemas import LEGACY_RAW_COLUMNS, RAW, RAW_REQUIRED
from ..session import estimated_bytes, read_in_splits, released_shuffles, shared_folder, unsorted_partitions
from .commits import remove


PAIR = ("term", "location_index")
TARGET_BYTES = 128 << 20
#: A landing of more text than this is dealt in so many rounds: a part of its text at a time, however large it is.
ROUND_BYTES, ROUNDS = 1 << 30, 4


def pair_files(hits: DataFrame, target_bytes: int = TARGET_BYTES, line: Column | None = None) -> DataFrame:
    """How many files each (term, location_index) takes, from the JSON text it holds
    (``line``: the text of a row, where it is there already)."""
    text = F.octet_length(F.to_json(F.struct(*hits.columns)) if line is None else line) + 1
    return hits.groupBy(*PAIR).agg(F.sum(text).alias("pair_bytes"), F.count(F.lit(1)).alias("pair_rows")).select(
        *PAIR, F.ceil(F.col("pair_bytes") / target_bytes).cast("int").alias("pair_files"), "pair_bytes", "pair_rows")


def _told_by_json(kind: T.DataType) -> bool:
    """Whether the JSON text of a value gives the value back."""
    if isinstance(kind, T.StructType):
        return all(_told_by_json(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _told_by_json(kind.elementType)
    return type(kind) in (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType)


def _round() -> Column:
    return F.pmod(F.xxhash64(*PAIR), F.lit(ROUNDS)).cast("int").alias("landing_round")


def write_landing(hits: DataFrame, path: str, target_bytes: int = TARGET_BYTES, compression: str = "none") -> None:
    """NDJSON per (term, location_index) in files of about ``target_bytes`` of text.

    The pairs' sizes are measured first, so a small pair is one file and a hot
    one is split over as many tasks as it has files, in proportion.  Dynamic
    partition overwrite: re-landing a pair replaces that pair's files only,
    as the 'w' mode of the original per-file writer did.

    Rows of plain JSON types are staged as their JSON text, so the hits are evaluated
    once.  More text than ``ROUND_BYTES`` is dealt in ``ROUNDS`` rounds of whole pairs, each a
    write of its own, and the disk holds the shuffle of one round at a time; a landing that
    dies has replaced the pairs of the rounds before, each in whole.  ``compression`` is
    the JSON writer's: with "gzip" the files are a tenth of the text (a file is not
    split by its reader).
    """
    spark = hits.sparkSession
    fields = T.StructType([f for f in hits.schema if f.name not in PAIR])
    folder, stage = shared_folder(spark, "pairs"), shared_folder(spark, "staged")
    as_text = _told_by_json(fields)
    line = F.col("landing_line") if as_text else F.to_json(F.struct(*fields.names))
    try:
        with released_shuffles(spark):
            if as_text:
                lines = hits.select(*PAIR, F.to_json(F.struct(*fields.names)).alias("landing_line"), _round())
                with unsorted_partitions(spark):
                    lines.write.partitionBy("landing_round").option("compression", "zstd").parquet(stage)
                hits = spark.read.schema(lines.schema).parquet(stage)
            measured = pair_files(hits, target_bytes, line if as_text else None)
            measured.write.parquet(folder)
            measured = spark.read.schema(measured.schema).parquet(folder)
            found = measured.groupBy(_round()).agg(F.sum("pair_files").alias("files"), F.sum("pair_bytes").alias("bytes"),
                                                   F.sum("pair_rows").alias("n")).collect()
            text, n = sum(r["bytes"] for r in found), sum(r["n"] for r in found)
            rounds = [(None, sum(r["files"] for r in found), text)] if found else []
            if as_text and text > ROUND_BYTES:
                rounds = [(r["landing_round"], r["files"], r["bytes"]) for r in found]
            # a task reads a file's share of the text, however well the staged text is compressed
            split = estimated_bytes(hits) * target_bytes // text if as_text and text else TARGET_BYTES
            for which, files, size in rounds:
                # no more tasks than files; no task has much more than a file's share
                tasks = max(1, min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                              size // target_bytes)))
                part = hits if which is None else hits.filter(F.col("landing_round") == which)
                with read_in_splits(spark, split) if as_text else contextlib.nullcontext():
                    (_dealt(part, measured, line, tasks, fields, as_text)
                     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     # files of one pair that meet in a task are cut apart again by their rows
                     .option("maxRecordsPerFile", max(1, target_bytes * n // text)).option("compression", compression)
                     .partitionBy(*PAIR).json(path))
                if which is not None:
                    remove(spark, f"{stage}/landing_round={which}")     # landed
    finally:
        remove(spark, folder)
        remove(spark, stage)


def _dealt(hits: DataFrame, measured: DataFrame, line: Column, tasks: int, fields: T.StructType,
           as_text: bool) -> DataFrame:
    """The hits, each in the task of its pair and file, as rows of ``fields`` and the pair."""
    on = F.lit(True)
    sizes = measured.select(*[F.col(c).alias(f"of_{c}") for c in PAIR], "pair_files")
    for c in PAIR:
        on = on & hits[c].eqNullSafe(sizes[f"of_{c}"])
    kept = [hits[c] for c in PAIR] + ([line] if as_text else [hits[c] for c in fields.names])
    dealt = hits.join(sizes, on).select(*kept, F.pmod(F.xxhash64(line), "pair_files").alias("landing_salt")) \
        .repartition(tasks, *PAIR, "landing_salt").drop("landing_salt")
    if as_text:
        dealt = dealt.select(*PAIR, F.from_json("landing_line", fields, {"mode": "FAILFAST"}).alias("landing_row")) \
            .select("landing_row.*", *PAIR)
    return dealt


def encode_ndjson(df: DataFrame) -> DataFrame:
    """One JSON text line per row (``to_json(struct(*))``); NULL fields
    are written out as null rather than dropped."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias("value"))


def with_required(df: DataFrame, required=RAW_REQUIRED) -> DataFrame:
    """REQUIRED columns: a NULL there fails the write that meets it (no pass
    of its own)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in required column {c}")))
                           for c in required})


def _raw_writer(df: DataFrame):
    out = with_required(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields]))
    return out.write.mode("append").format("parquet").partitionBy("feed")


def append_raw(df: DataFrame, path: str) -> None:
    """Append cleaned rows to the raw table with the fixed schema.

    Appends are not idempotent (a rerun duplicates rows, which staging
    de-duplicates), exactly like the warehouse load default."""
    with unsorted_partitions(df.sparkSession):
        _raw_writer(df).save(path)


def append_raw_table(df: DataFrame, table: str) -> None:
    """S13 into a catalog table partitioned by feed.  It is not bucketed by
    id: a bucket of a hot id would be one write task and later one read task."""
    with unsorted_partitions(df.sparkSession):
        _raw_writer(df).saveAsTable(table)


def materialize(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rebuild a model table in full."""
    df.write.mode("overwrite").format(fmt).save(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a model as a temporary view (no data moves)."""
    df.createOrReplaceTempView(name)
    return df


def legacy_raw_rows(hits: DataFrame) -> DataFrame:
    """S17 input shape: the 15 raw columns with nested fields as JSON text
    and a NULL price where the record has none."""
    nested = {"categories", "coordinates", "transactions", "location"}
    cols = []
    for c in LEGACY_RAW_COLUMNS:
        if c not in hits.columns:
            cols.append(F.lit(None).cast("string").alias(c))
        elif c in nested:
            cols.append(F.to_json(F.col(c), {"ignoreNullFields": "false"}).alias(c))
        else:
            cols.append(F.col(c))
    return hits.select(*cols, *[c for c in hits.columns if c not in LEGACY_RAW_COLUMNS])


def insert_if_absent(target: DataFrame, batch: DataFrame, arrival: list[Order],
                     key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, first
    arrival per key winning (an earlier insert is visible to later checks).

    One anti join instead of one lookup per row; the per-key pick is the
    map-side combined top-1.  Returns the rows to append.
    """
    columns = columns or [c for c in target.columns]
    first = first_per_key(batch, key, arrival, payload=batch.columns).select(*columns)
    return first.join(target.select(key), key, "left_anti")


def loaded_if_absent(rows: DataFrame, in_target: Column, arrival: list[Order],
                     key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """The table after such a load, where target and batch come from one
    input: rows flagged ``in_target`` come first, then arrival.  One
    aggregate over one scan."""
    flagged = rows.withColumn("_later", F.when(in_target, F.lit(0)).otherwise(F.lit(1)))
    return first_per_key(flagged, key, [asc("_later"), *arrival], payload=columns or rows.columns)


def append_if_absent(target_path: str, batch: DataFrame, arrival: list[Order],
                     key: str = "id", fmt: str = "parquet") -> None:
    """Append the new rows to a table.  The target's key set is read before
    the write, so reading and appending the same path is safe."""
    spark = batch.sparkSession
    target = spark.read.format(fmt).load(target_path)
    new = insert_if_absent(target, batch, arrival, key, columns=target.columns)
    new.write.mode("append").format(fmt).save(target_path)

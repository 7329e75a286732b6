"""Loading landing files once (S13): a raw table with a ledger of what it has read.

The ledger knows every landing unit, a file or a folder of files, by a stamp
over the names, sizes and times of its files.  A load lists the landing
folder without opening a file, anti-joins the ledger, reads only the units
that are new or changed, and appends their rows under its own batch.  So a
rerun of a folder adds nothing, and a changed unit replaces its own rows: the
batch that had them before is superseded for that unit.

    path/rows/batch=../feed=..   rows of a load     path/ledger/batch=..   unit, stamp, files, bytes
    path/commits                 one record per load

A reader prunes to the committed batches and drops superseded (batch, unit)
pairs by an anti join with a list that is empty until a unit changes.

Defined cases: a unit that vanished from the landing folder keeps its rows; a unit
whose rows are all cleaned away is in the ledger and is not read again; a load
that dies leaves nothing that is read; a file of no bytes is no unit, and a
folder without any is no load at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import released_shuffles, unsorted_partitions
from .commits import CommitLog, new_name, number_of, read_or_none
from .writers import with_required

LEDGER = "unit string, stamp long, files long, bytes long"


def by_file(path: Column) -> Column:
    return path


def by_folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


class LedgeredTable:
    """Raw rows of ``schema`` (DDL, with ``feed``) at ``path``, loaded from landing folders.

    ``unit`` names the landing unit of a file's path; of a landing folder that
    Spark writes, a pair's folder is the unit (:func:`by_folder`), since a rewritten
    pair gets files of other names.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, unit: Callable[[Column], Column] = by_file,
                 required: tuple = ()):
        self.spark, self.path, self.schema, self.unit, self.required = spark, path, schema, unit, required
        self.log = CommitLog(spark, f"{path}/commits", "batch string")

    def _batches(self) -> list[str]:
        return [e["batch"] for e in self.log.entries()]

    def listing(self, landing: str, glob: str = "*.json") -> DataFrame:
        """(path, unit, file_path, length, time) of the landed files; none is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True) \
            .option("pathGlobFilter", glob).load(landing)
        return files.select("path", self.unit(F.col("_metadata.file_path")).alias("unit"),
                            F.col("_metadata.file_path").alias("file_path"), "length",
                            F.col("modificationTime").alias("time"))

    def ledger(self) -> DataFrame:
        """Every unit of every committed load."""
        return read_or_none(self.spark, f"{self.path}/ledger", f"{LEDGER}, batch string") \
            .filter(F.col("batch").isin(self._batches()))

    def superseded(self) -> DataFrame:
        """(batch, unit) whose rows a later batch replaced."""
        led = self.ledger().select("batch", "unit")
        last = led.groupBy("unit").agg(F.max("batch").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        return led.join(last, "unit").filter("batch < last").select("batch", "unit")

    def rows(self) -> DataFrame:
        """The current rows, with the number of the ``batch`` that loaded them."""
        rows = read_or_none(self.spark, f"{self.path}/rows", f"{self.schema}, unit string, batch string") \
            .filter(F.col("batch").isin(self._batches()))
        return rows.join(self.superseded(), ["batch", "unit"], "left_anti") \
            .withColumn("batch", number_of("batch")).drop("unit")

    def pending(self, landing: str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
        """The units (unit, stamp, files, bytes) that are new or changed, and the listing."""
        files = self.listing(landing, glob)
        stamp = F.bit_xor(F.xxhash64("file_path", "length", "time"))
        units = files.groupBy("unit").agg(stamp.alias("stamp"), F.count(F.lit(1)).alias("files"),
                                          F.sum("length").alias("bytes"))
        known = self.ledger().join(self.superseded(), ["batch", "unit"], "left_anti").select("unit", "stamp")
        return units.join(known, ["unit", "stamp"], "left_anti"), files

    def load(self, landing: str, read: Callable[[list[str]], DataFrame],
             clean: Callable[[DataFrame], DataFrame], glob: str = "*.json") -> int:
        """Load what is new or changed below ``landing``; returns how many units.

        ``read`` gets file paths and returns hits with their ``file_path``;
        ``clean`` returns raw rows and passes ``file_path`` through.  The
        paths are listed on the driver, as the file index of any scan of them is.
        """
        todo, files = self.pending(landing, glob)
        batch = new_name(self.log.entries())
        ledger = f"{self.path}/ledger/batch={batch}"
        with released_shuffles(self.spark):
            todo.write.parquet(ledger)      # fixed before the files are read: no record names it yet
            todo = self.spark.read.schema(LEDGER).parquet(ledger)
            paths = [r["path"] for r in files.join(todo, "unit", "left_semi").select("path").collect()]
        if not paths:
            return 0
        rows = clean(read(paths)).withColumn("unit", self.unit(F.col("file_path"))).drop("file_path")
        fields = self.spark.createDataFrame([], self.schema).schema
        out = with_required(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], "unit"),
                            self.required)
        with unsorted_partitions(self.spark), released_shuffles(self.spark):
            out.write.partitionBy("feed").option("compression", "zstd").parquet(f"{self.path}/rows/batch={batch}")
            self.log.add(batch=batch)
            return todo.count()

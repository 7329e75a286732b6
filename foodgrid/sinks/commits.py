"""Commit records: what a reader of a table with versions or loads may trust.

A load first writes its files where no reader looks, then adds one record; a
load that dies leaves files that no record names.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and no record names any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_or_none(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The files at ``path``; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class CommitLog:
    """Numbered records of the columns ``fields``, one small file each, oldest first."""

    def __init__(self, spark: SparkSession, path: str, fields: str):
        self.spark, self.path, self.schema = spark, path, f"n long, {fields}"

    def entries(self) -> list[Row]:
        got = sorted(read_or_none(self.spark, self.path, self.schema, "json").collect(), key=lambda r: r["n"])
        if [r["n"] for r in got] != list(range(1, len(got) + 1)):
            raise RuntimeError(f"{self.path}: more than one writer")
        return got

    def add(self, **values) -> None:
        """One record more; it is there in whole or not at all (a single file, renamed when complete)."""
        n = len(self.entries()) + 1
        row = self.spark.range(1).select(F.lit(n).alias("n"), *[F.lit(v).alias(k) for k, v in values.items()])
        row.write.mode("append").json(self.path)


def new_name(entries: list[Row]) -> str:
    """A name for the next load, in order of the loads; a repeated attempt gets another."""
    return f"{len(entries) + 1:09d}-{uuid.uuid4().hex[:12]}"


def number_of(name) -> F.Column:
    """The number of a load, from its name."""
    return F.split(F.col(name), "-")[0].cast("long")

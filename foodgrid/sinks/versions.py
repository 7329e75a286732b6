"""Tables rebuilt in full without a moment in which they are missing.

A rebuild writes a folder of its own; one commit record then makes it the
current one.  A build that fails leaves the old rows in place, and a reader
that began before the switch finishes on the files it began with.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .commits import CommitLog, new_name, remove


class VersionedTable:
    """The table at ``path`` (shared storage); the last ``keep`` versions stay."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path, keep
        self.log = CommitLog(spark, f"{path}/commits", "version string, schema string")

    def rebuild(self, df: DataFrame) -> None:
        entries = self.log.entries()
        version = new_name(entries)
        df.write.parquet(f"{self.path}/{version}")
        self.log.add(version=version, schema=df.schema.json())
        for old in entries[:max(0, len(entries) + 1 - self.keep)][-1:]:
            remove(self.spark, f"{self.path}/{old['version']}")

    def read(self, back: int = 0) -> DataFrame:
        """The current version, or the one ``back`` rebuilds before it."""
        entries = self.log.entries()
        if back >= min(len(entries), self.keep):
            raise LookupError(f"{self.path} has no version {back} rebuilds back")
        entry = entries[-1 - back]
        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))) \
            .parquet(f"{self.path}/{entry['version']}")

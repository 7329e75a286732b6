"""Exact deduplication against a persistent digest index (operator 5).

The index is a catalog table, hash-bucketed and sorted by digest: (digest,
keep_id, group_size).  A batch of documents is reduced to one row per digest
by a map-side combined aggregation (a group of copies costs one row per map
task), sort-merge anti-joined to the index (which is read bucket by bucket,
without a shuffle), and what is new is appended.  Only digests and ids are
shuffled, never texts.  DataFrame functions only.

The index grows over many batches: a digest that it holds already gets one more
row per batch, with the batch's number of rows and no id, so ``group_size``
counts the rows of all batches so far and a digest that becomes hot later is seen.
A digest's rows share a bucket, and are added up there without a shuffle.

Defined cases: null text counts as empty; empty texts are one group; a null
doc_id is smaller than any other; rows equal in all columns are rows of one
group (``kept`` is then true for each row that carries the largest id);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import lower_ascii, one_each, scratch_dir, stored, unused

#: A digest with over 1/HOT_SHARE of all rows is hot: at most HOT_SHARE such exist.
HOT_SHARE = 1000
INDEX_COLUMNS = "digest BINARY, keep_id BIGINT, group_size BIGINT"


class DigestIndex:
    """A digest index at ``path`` (shared storage), bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or f"{scratch_dir(spark)}/digest_index"
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({INDEX_COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def groups(self) -> DataFrame:
        """(digest, keep_id, group_size), one row per digest."""
        return self.table().groupBy("digest").agg(F.max("keep_id").alias("keep_id"),
                                                  F.sum("group_size").alias("group_size"))

    def ingest(self, groups: DataFrame) -> None:
        """Append the groups (digest, keep_id, group_size) whose digest is new,
        and what the others add to their digests' sizes."""
        known = self.table().select("digest").hint("merge")
        new = groups.join(known, "digest", "left_anti").select("digest", "keep_id", "group_size")
        more = groups.join(known, "digest", "left_semi") \
            .select("digest", F.lit(None).cast("long").alias("keep_id"), "group_size")
        (new.unionByName(more).repartition(self.buckets, "digest")
            .write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))


def digest(docs: DataFrame):
    """SHA-256 of the text, A-Z lower-cased."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(docs["text"], F.lit(""))), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), digest(docs).alias("digest"))


def group_digests(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                      F.count(F.lit(1)).alias("group_size"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, buckets: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Against a given index, ``keep_id`` of a digest it already holds is the
    index's, no row with another id is kept, and ``group_size`` counts the
    digest's rows of all batches, this one included.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark, buckets=buckets)
    rows = stored(digests(docs), "digests")  # each text is digested once
    index.ingest(group_digests(rows))
    table = index.groups()
    # A digest with a third of all rows must not meet in one task: the hot
    # ones are HOT_SHARE rows at most, so they alone are broadcast.
    total = table.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") > F.lit(max(1, total // HOT_SHARE))
    few = F.broadcast(table.filter(hot))
    first = rows.join(few, "digest", "left")
    done = first.filter("group_size is not null")
    rest = first.filter("group_size is null").select("doc_id", "digest") \
        .join(table.filter(~hot).hint("merge"), "digest")
    return done.unionByName(rest).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, buckets: int = 64) -> DataFrame:
    """The documents that stay, with all their columns (one row per digest)."""
    index = DigestIndex(docs.sparkSession, buckets=buckets)
    rows = stored(digests(docs).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "digests")
    index.ingest(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")))
    if not rows.filter("n > 1").isEmpty():
        docs = one_each(docs, docs["doc_id"].cast("long"), digest(docs))
    kept, of = unused(docs, "kept_id", "kept_digest")
    keep = index.table().select(F.col("keep_id").alias(kept), F.col("digest").alias(of))
    return docs.join(keep, (digest(docs) == F.col(of))
                     & docs["doc_id"].cast("long").eqNullSafe(F.col(kept)), "left_semi")

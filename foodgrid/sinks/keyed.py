"""Insert-if-absent against a large target (S17, S18): a table with a
persistent index of its keys.

A load must not scan or shuffle what the target holds.  So the keys are kept
twice beside the rows: as a catalog table hashed into buckets and sorted by
key, which an anti join reads bucket by bucket without an exchange, and before
it as a Bloom filter in blocks: a key has ``BITS`` bits in one block of 4 KB, so
testing a batch is one equi-join with a table of ``BITS_PER_KEY`` bits per key.
Keys that the filter has not seen are new for certain; only the others, those
that are there and about 1 % that are not, meet the index, and where there is
none of them the index is not opened.

    path/rows/load=..   the rows, by load        path/keys    key, load (bucketed)
    path/bloom/..       block, bits              path/commits one record per load

Defined cases: the first arrival of a key wins; rows with a null key are left
out by :meth:`KeyedTable.append` and kept by :meth:`KeyedTable.append_all`, which
checks nothing, so a target may hold a key many times and keeps every row; a load
that dies changes nothing, and can be repeated; an empty batch is a load of no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import Order, first_per_key
from ..session import unsorted_partitions
from .commits import CommitLog, new_name, number_of, read_or_none, remove

BLOCK_BITS = 32_768     # of a block, as bitmap_construct_agg builds it
BITS, BITS_PER_KEY = 4, 10
FIELDS = "load string, rows long, keys long, blocks long, bloom string"


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(-1)), F.lit(blocks)).alias("block")


def _bit(key: str, i: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BLOCK_BITS))


def bloom_of(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, bits) of the keys; combined before the shuffle."""
    bits = keys.select(_block(key, blocks), F.explode(F.array(*[_bit(key, i) for i in range(BITS)])).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def seen(key: str) -> Column:
    """Whether all bits of ``key`` are set in ``bits`` (a null block has none)."""
    def one(i: int) -> Column:
        at = _bit(key, i)
        byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    out = one(0)
    for i in range(1, BITS):
        out = out & one(i)
    return F.coalesce(out, F.lit(False))


class KeyedTable:
    """The table at ``path`` (shared storage) with rows of ``schema``.

    ``capacity``: keys that the filter is made for at first; beyond it the
    filter is built anew from the index at twice the size.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "id", buckets: int = 64,
                 capacity: int = 1 << 20):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.buckets, self.capacity = buckets, capacity
        self.log = CommitLog(spark, f"{path}/commits", FIELDS)
        self.name = "keys_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (`{key}` STRING, load STRING) USING parquet "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}/keys'")

    def rows(self) -> DataFrame:
        """The rows of all committed loads, with the number of their ``load``."""
        loads = [e["load"] for e in self.log.entries()]
        return read_or_none(self.spark, f"{self.path}/rows", f"{self.schema}, load string") \
            .filter(F.col("load").isin(loads)).withColumn("load", number_of("load"))

    def keys(self) -> DataFrame:
        """The committed keys (one short name per load is compared)."""
        loads = [e["load"] for e in self.log.entries()]
        return self.spark.table(self.name).filter(F.col("load").isin(loads)).select(self.key)

    def absent(self, maybe: DataFrame) -> DataFrame:
        """The rows of ``maybe`` whose key the index does not have; the index is
        neither broadcast nor exchanged."""
        there = self.keys().hint("merge")
        return maybe.repartition(self.buckets, self.key).join(there, self.key, "left_anti")

    def append_all(self, rows: DataFrame) -> None:
        """A load without a check of the keys."""
        self._write(rows, new_name(self.log.entries()))

    def append(self, batch: DataFrame, arrival: list[Order]) -> None:
        """A load of the first row by ``arrival`` of every key the table does not have."""
        entries = self.log.entries()
        load = new_name(entries)
        columns = [f.name for f in self._empty().schema]
        first = first_per_key(batch.filter(F.col(self.key).isNotNull()), self.key, arrival, payload=batch.columns) \
            .select(*columns)
        blocks = entries[-1]["blocks"] if entries else 1
        bloom = read_or_none(self.spark, entries[-1]["bloom"], "block long, bits binary") if entries else \
            self.spark.createDataFrame([], "block long, bits binary")
        incoming = f"{self.path}/incoming/{load}"
        tested = first.withColumn("block", _block(self.key, blocks)).join(bloom, "block", "left")
        with unsorted_partitions(self.spark):
            tested.select(*columns, seen(self.key).alias("maybe")).write.partitionBy("maybe").parquet(incoming)
        staged = self.spark.read.schema(f"{self.schema}, maybe boolean").parquet(incoming)
        new, maybe = (staged.filter(c).drop("maybe") for c in (~F.col("maybe"), F.col("maybe")))
        if not maybe.isEmpty():
            new = new.unionByName(self.absent(maybe))
        self._write(new, load)
        remove(self.spark, incoming)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, load: str) -> None:
        entries = self.log.entries()
        last = entries[-1] if entries else None
        target = f"{self.path}/rows/load={load}"
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._empty().schema]) \
            .write.parquet(target)
        back = self.spark.read.schema(self.schema).parquet(target)
        own = back.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        own.withColumn("load", F.lit(load)).repartition(self.buckets, self.key).write.format("parquet") \
            .mode("append").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name)
        index = self.spark.table(self.name)
        count = index.filter(F.col("load") == load).count()
        keys = count + (last["keys"] if last else 0)
        room = self.capacity
        while room < keys:
            room *= 2
        blocks = -(-room * BITS_PER_KEY // BLOCK_BITS)
        bloom = f"{self.path}/bloom/{load}"
        if last and last["blocks"] == blocks:
            bits = bloom_of(index.filter(F.col("load") == load), self.key, blocks) \
                .unionByName(read_or_none(self.spark, last["bloom"], "block long, bits binary")) \
                .groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        else:
            bits = bloom_of(index.filter(F.col("load").isin([load, *[e["load"] for e in entries]])), self.key, blocks)
        bits.write.parquet(bloom)
        self.log.add(load=load, rows=back.count(), keys=keys, blocks=blocks, bloom=bloom)
        if last:
            remove(self.spark, last["bloom"])

"""Sharding by sampled splitters (operator 7), under the law ``bytes``.

Records are ordered by (xxhash64 of the text, doc_id, salt), so equal texts lie
together and a hot group can still be cut by id, and rows equal in both by
the salt, a number that each row gets when the records are written.  A sample, drawn with
probability in proportion to size, gives quantile boundaries; records are
range-partitioned by them, and a range that holds more than ``OVERFULL``
times its share is subdivided with a denser sample of its own until none is.
The ranges' byte and row counts (a few thousand numbers) then place every
record: a running sum inside its range plus the range's offset tells its
shard, whose sizes differ by about one record.

Only ids, sizes and hashes are shuffled.  Defined cases: null text has size 1
and the crc of the empty text; empty tables give no rows; repeated rows are
separate records, which may lie in several ranges and shards;
a null doc_id sorts first; other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import stored

#: Sampled keys wanted for each range: the sample has about SAMPLES * ranges rows.
SAMPLES = 16
OVERFULL = 2.0
#: The order of the records; boundaries have these three values.
ORDER = ["key", "doc_id", "salt"]


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(F.xxhash64(text).alias("key"), docs["doc_id"].cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("salt"))


def _draw(rows: DataFrame, wanted: int, total: int) -> list[tuple]:
    """Keys drawn with probability size * wanted / total, at most 1; the draw
    depends on the stored record alone, so a retried task draws the same.  About
    ``wanted`` rows come to the driver, whatever the input: equal rows are drawn
    one by one, by their salts."""
    chance = F.col("size") * F.lit(wanted / max(1, total))
    u = F.pmod(F.xxhash64(*ORDER, F.lit(11)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return sorted((x["key"], _low(x["doc_id"]), x["salt"]) for x in
                  rows.filter(u < chance).select(*ORDER).collect())


def _low(doc_id) -> int:
    return -(1 << 63) if doc_id is None else doc_id


def splitters(sample: list[tuple], parts: int) -> list[tuple]:
    """``parts - 1`` quantile boundaries of the sample, without repeats."""
    at = [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []
    return sorted(set(at))


def with_range(rows: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Adds ``range``: how many boundaries are at or below (key, doc_id, salt)."""
    edges = np.array(bounds, np.int64).reshape(-1, 3).T

    @F.pandas_udf("long")
    def place(key: pd.Series, doc_id: pd.Series, salt: pd.Series) -> pd.Series:
        row = [x.to_numpy(np.int64) for x in (key, doc_id, salt)]
        low = np.zeros(len(key), np.int64)
        high = np.full(len(key), edges.shape[1], np.int64)
        while (low < high).any():   # halves every row's interval
            at = np.minimum((low + high) // 2, edges.shape[1] - 1)
            below = np.ones(len(key), bool)
            for e, r in zip(edges[::-1], row[::-1], strict=True):
                below = (e[at] < r) | ((e[at] == r) & below)
            todo = low < high
            low = np.where(todo & below, at + 1, low)
            high = np.where(todo & ~below, at, high)
        return pd.Series(low)

    return rows.withColumn("range", place("key", F.coalesce("doc_id", F.lit(_low(None))), "salt"))


def shard_by_bytes(docs: DataFrame, shards: int = 16, ranges: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per record."""
    spark = docs.sparkSession
    rows = stored(records(docs), "records")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = ranges or max(4 * shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = max(1, total // ranges)
    bounds = splitters(_draw(rows, SAMPLES * ranges, total), ranges)
    while True:
        ranged = with_range(rows, bounds)
        held = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                                           F.max("size").alias("largest")).collect()
        full = [x for x in held if x["bytes"] > OVERFULL * share + x["largest"]]
        more = []
        if full:
            some = spark.createDataFrame([(x["range"],) for x in full], "range long")
            inside = ranged.join(F.broadcast(some), "range")
            drawn = _draw(inside, SAMPLES * sum(-(-x["bytes"] // share) for x in full),
                          sum(x["bytes"] for x in full))
            by: dict[int, list] = {}
            for s in drawn:
                by.setdefault(bisect.bisect_right(bounds, s), []).append(s)
            for x in full:
                more += splitters(by.get(x["range"], []), int(-(-x["bytes"] // share)))
        grown = sorted(set(bounds) | set(more))
        if len(grown) == len(bounds):  # none overfull, or a single record each
            break
        bounds = grown
    offsets, b, n = [], 0, 0
    for x in sorted(held, key=lambda x: x["range"]):
        offsets.append((x["range"], b, n))
        b, n = b + x["bytes"], n + x["n"]
    offset = spark.createDataFrame(offsets, "range long, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy(*ORDER) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a range has about OVERFULL * share bytes at most: no window sees a hot key or row whole
    placed = ranged.repartition("range") \
        .withColumn("upto", F.sum("size").over(order)) \
        .withColumn("place", F.count(F.lit(1)).over(order)) \
        .join(F.broadcast(offset), "range") \
        .select("doc_id", "size", "text_crc32", "range",
                (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"),
                (F.col("rows_before") + F.col("place") - 1).alias("row"))
    shard = F.least(F.lit(shards - 1), F.expr(f"(2 * start + size) * {shards} div {2 * max(1, total)}"))
    placed = stored(placed.withColumn("shard", shard.cast("int")), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("range").alias("split_range"))

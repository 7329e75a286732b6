"""Helpers shared by the corpus operators: inputs, shared scratch tables,
row identity and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[^\x20\x09-\x0D]+``, the words of every operator here (Java and Python).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
EDGES_PER_FILE = 100_000
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """Lower-case A-Z only."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests, a laptop) a local
    folder is made and set for the session; a cluster without one is an error,
    since its executors could not see the driver's folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-scratch-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the
    lineage is cut, and lost executors cannot take the rows with them."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rid): null text is empty; ``rid`` tells rows with the
    same doc_id but other text apart (rows equal in both share it, and get
    equal results).  Other columns, whatever their names, are left out."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(docs["doc_id"].cast("long"), text).alias("rid"))


def unused(docs: DataFrame, *stems: str) -> list[str]:
    """Column names that begin with ``stems`` and that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for stem in stems:
        out.append(next(n for n in (stem + "_" * i for i in range(len(taken) + 1)) if n.lower() not in taken))
    return out


def same_row(a: DataFrame, b: DataFrame):
    """Join condition on row identity (doc_id may be null)."""
    return (a["rid"] == b["rid"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def one_each(docs: DataFrame, *keys) -> DataFrame:
    """One row of those equal in ``keys``, the same in every run, with all
    columns.  Rows are combined before the shuffle: a repeated one costs a row
    per map task."""
    order = F.xxhash64(*[docs[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), order.alias("__order"),
                       *[k.alias(f"__key{i}") for i, k in enumerate(keys)])
    return rows.groupBy(*[f"__key{i}" for i in range(len(keys))]) \
        .agg(F.min_by("__row", "__order").alias("__row")).select("__row.*")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): rows (node, root) for
    every node of an edge, ``root`` the smallest node reachable.

    Alternating large-star and small-star steps: each is one grouping with
    a map-side minimum, hubs only ever pass their minimum on, and the number
    of edges never grows.  A round is written to the shared folder; the loop
    ends when a round changes no edge.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .filter("a <> b").distinct()
    e = stored(e, "edges")
    # a table of few edges is kept in few files: a round then costs few tasks
    files = max(4, e.count() // EDGES_PER_FILE)
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: every larger neighbour of a node points to the node's minimum;
        # dealt by that neighbour, which the small star groups and joins by as well
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).repartition("a").distinct())
        # small star: the smaller neighbours of a node, and itself, point to the smallest
        down = large.filter("a <> b")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        j = down.join(low, "a")
        e = stored(j.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                   .unionByName(low.select("a", F.col("m").alias("b"))).distinct().coalesce(files), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")) \
                .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))) \
                .groupBy("node").agg(F.min("root").alias("root"))
        before = now
    raise RuntimeError("components did not settle")

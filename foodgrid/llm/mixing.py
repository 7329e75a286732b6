"""Mixing sources to target weights by entropy balancing (operator 9).

Document rates solve a convex problem: of all rates that meet each source's
token target, the ones of least entropy distance from "once each", with every
rate between 0 and ``MAX_COPIES``.  The dual has one multiplier per source;
its solution tilts the rates exponentially in the document's size,

    rate = MAX / (1 + (MAX - 1) * exp(-m * size / mean size of the source)),

and is found by Newton steps inside a bracket.  Each step is one aggregation
over the histogram (source, size) -> documents, so it touches no document and
no hot source; sums are whole numbers, so reruns agree to the last copy.

Rates are rounded into copies systematically: along each source ordered by
(size, salt, doc_id) a document takes one more copy than the whole part where
the running sum of fractions passes a whole number (rows equal in doc_id, text
and source are one entry with their number, so a row that is a third of all is one row), so a source's words miss
their target by about one document.  The running sum has four levels, none of
which grows with a source's documents: blocks of ``SIZE_BLOCK`` sizes, sizes in
a block, salts of a size, and documents of a (source, size, salt) cell, which
holds about ``CELL`` copies of a single size at most (there are as many salts
as that takes).  DataFrame functions only.

Defined cases: null text has size 0; a null source is a source, ordered last;
a document of size 0 keeps rate 1; a source without words has target 0;
rows with the same doc_id but other text are rounded apart; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD_PATTERN, one_each, stored, unused

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
SALTS = 64              # at least
DEALT = 1 << 10         # copies of one row made in a task, where rows were repeated
CELL = 1 << 18          # documents of one size in a cell, if all had that size
SIZE_BLOCK = 1024
UNIT = 1 << 24          # fractions of a copy, as whole numbers: sums stay below 2**63 for 5e11 documents
TOKEN_UNIT = 1 << 10    # fractions of a token in the Newton sums


def sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].alias("source"),
                       F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size"),
                       F.xxhash64(docs["doc_id"].cast("long"), text).alias("rid"))


def share_targets(totals: list[tuple], cap: int = MAX_COPIES,
                  weights: tuple = WEIGHTS) -> list[float]:
    """Targets of sources [(name, size)]: shares of all sizes by weight, held
    at ``cap`` times the source's size, the excess reshared by weight."""
    everything = sum(s for _, s in totals)
    w = [weights[i % len(weights)] for i in range(len(totals))]
    held: dict[int, float] = {i: 0.0 for i, (_, s) in enumerate(totals) if s == 0}
    while True:
        free = [i for i in range(len(totals)) if i not in held]
        left, weight = everything - sum(held.values()), sum(w[i] for i in free)
        over = [i for i in free if left * w[i] > cap * totals[i][1] * weight]
        if not over:
            return [held[i] if i in held else left * w[i] / weight for i in range(len(totals))]
        held |= {i: float(cap * totals[i][1]) for i in over}


def _rate(size, mean, multiplier):
    return F.when(size == 0, F.lit(1.0)).otherwise(
        F.lit(float(MAX_COPIES))
        / (1 + (MAX_COPIES - 1) * F.exp(F.least(F.lit(600.0), -multiplier * size / mean))))


def solve_rates(spark, hist: DataFrame, sources: list[dict], steps: int = 60,
                tolerance: float = 1e-4) -> list[dict]:
    """The multiplier of each source, by Newton steps kept inside a bracket.

    ``hist``: (sid, size, n).  The state is one small row per source.
    """
    for s in sources:
        s["lo"], s["hi"], s["m"] = -700.0, 700.0, 0.0
        s["done"] = s["size"] == 0
        if not s["done"] and s["target"] >= MAX_COPIES * s["size"] * (1 - 1e-9):
            s["m"], s["done"] = 1e9, True
    for _ in range(steps):
        open_ = [s for s in sources if not s["done"]]
        if not open_:
            break
        state = spark.createDataFrame([(s["sid"], s["mean"], s["m"]) for s in open_],
                                      "sid long, mean double, m double")
        r = _rate(F.col("size"), F.col("mean"), F.col("m"))
        whole = lambda c: F.sum(F.round(c * TOKEN_UNIT).cast("decimal(28,0)"))
        sums = (hist.join(F.broadcast(state), "sid").withColumn("r", r)
                .groupBy("sid").agg(
                    whole(F.col("n") * F.col("size") * F.col("r")).alias("g"),
                    whole(F.col("n") * F.col("size") * F.col("size") / F.col("mean")
                          * F.col("r") * (1 - F.col("r") / MAX_COPIES)).alias("h")))
        got = {x["sid"]: (float(x["g"]) / TOKEN_UNIT, float(x["h"]) / TOKEN_UNIT)
               for x in sums.collect()}  # one row per source
        for s in open_:
            g, h = got[s["sid"]]
            gap = g - s["target"]
            if abs(gap) <= tolerance * max(1.0, s["target"]):
                s["done"] = True
                continue
            s["lo"], s["hi"] = (s["lo"], s["m"]) if gap > 0 else (s["m"], s["hi"])
            step = s["m"] - gap / h if h > 0 else None
            inside = step is not None and s["lo"] < step < s["hi"]
            s["m"] = step if inside else (s["lo"] + s["hi"]) / 2
    return sources


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken, rid per row."""
    groups = mix_groups(docs)
    columns = ["doc_id", "source", "size", "source_size", "target", "rate", "whole", "extra", "rid", "n"]
    few = groups.filter(F.col("n") <= DEALT).withColumn("deal", F.lit(0).cast("long")).select(*columns, "deal")
    many = groups.filter(F.col("n") > DEALT)
    if not many.isEmpty():   # a row's repeats may be very many: DEALT of them at a time, in any task
        dealt = many.withColumn("deal", F.explode(F.expr(f"sequence(0L, (n - 1) div {DEALT})")))
        few = few.unionByName(dealt.select(*columns, "deal").repartition("rid", "deal"))
    rows = few.withColumn("k", F.explode(F.expr(f"sequence(deal * {DEALT}, least(n, (deal + 1) * {DEALT}) - 1)"))) \
        .withColumn("copies", F.col("whole") + F.when(F.col("k") < F.col("extra"), 1).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"), "rid")


def mix_groups(docs: DataFrame) -> DataFrame:
    """One row for the ``n`` rows equal in doc_id, text and source: each takes
    ``whole`` copies, and ``extra`` of them one more."""
    spark = docs.sparkSession
    rows = stored(sizes(docs).groupBy("doc_id", "source", "size", "rid").agg(F.count(F.lit(1)).alias("n")), "sizes")
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n"))
    # one row per source, not per document; Python orders strings by code point
    found = sorted(((x["source"], x["size"], x["n"]) for x in totals.collect()),
                   key=lambda x: (x[0] is None, x[0] or ""))
    targets = share_targets([(a, b) for a, b, _ in found])
    sources = [{"sid": i, "source": a, "size": b, "n": n, "target": t, "mean": max(b, 1) / max(n, 1)}
               for i, ((a, b, n), t) in enumerate(zip(found, targets, strict=True))]
    names = spark.createDataFrame([(s["source"], s["sid"]) for s in sources],
                                  "name string, sid long")
    salts = max(SALTS, sum(n for _, _, n in found) // CELL)
    salt = F.pmod(F.xxhash64("rid"), F.lit(salts)).alias("salt")
    keyed = rows.join(F.broadcast(names), rows["source"].eqNullSafe(names["name"])) \
        .select("doc_id", "rid", "source", "sid", "size", salt, "n")
    cells = stored(keyed.groupBy("sid", "size", "salt").agg(F.sum("n").alias("n")), "cells")
    hist = stored(cells.groupBy("sid", "size").agg(F.sum("n").alias("n")), "hist")
    solve_rates(spark, hist, sources)
    solved = spark.createDataFrame(
        [(s["sid"], s["size"], float(s["target"]), s["mean"], s["m"]) for s in sources],
        "sid long, source_size long, target double, mean double, m double")
    rated = hist.join(F.broadcast(solved), "sid") \
        .withColumn("rate", _rate(F.col("size"), F.col("mean"), F.col("m"))) \
        .withColumn("whole", F.floor("rate")) \
        .withColumn("part", F.round((F.col("rate") - F.col("whole")) * UNIT).cast("long")) \
        .withColumn("block", F.expr(f"size div {SIZE_BLOCK}")).withColumn("sum", F.col("n") * F.col("part"))

    def before(of, order, *within):  # running sum, without the row itself
        along = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(of).over(along) - F.col(of)

    blocks = rated.groupBy("sid", "block").agg(F.sum("sum").alias("all")) \
        .select("sid", "block", before("all", "block", "sid").alias("block_before"))
    rated = rated.withColumn("size_before", before("sum", "size", "sid", "block")).join(blocks, ["sid", "block"]) \
        .select("sid", "size", "source_size", "target", "rate", "whole", "part",
                (F.col("block_before") + F.col("size_before")).alias("start"))
    cells = cells.withColumn("cell_before", before("n", "salt", "sid", "size")).join(rated, ["sid", "size"]) \
        .withColumn("before", F.col("start") + F.col("cell_before") * F.col("part")) \
        .select("sid", "size", "salt", "source_size", "target", "rate", "whole", "part", "before")
    along = Window.partitionBy("sid", "size", "salt").orderBy("doc_id", "rid", "source") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.col("before") + F.col("earlier") * F.col("part") + UNIT // 2
    out = keyed.withColumn("earlier", F.sum("n").over(along) - F.col("n")).join(cells, ["sid", "size", "salt"]) \
        .withColumn("run", run).withColumn("extra", F.expr(f"(run + n * part) div {UNIT} - run div {UNIT}"))
    return out.select("doc_id", "rid", "source", "size", "source_size", "target", "rate",
                      F.col("whole").cast("long").alias("whole"), "extra", "n")


def repeat_by_mix(docs: DataFrame) -> DataFrame:
    """The documents, each repeated by its copies (0: gone), with their columns.

    Rows equal in doc_id and text are one row, with the sum of their copies.
    """
    at, of, times, rows, part, copy = unused(docs, "mix_id", "mix_rid", "mix_copies", "mix_rows", "mix_part", "mix_copy")
    copies = stored(mix_groups(docs).groupBy(F.col("doc_id").alias(at), F.col("rid").alias(of)).agg(
        F.sum(F.col("whole") * F.col("n") + F.col("extra")).alias(times), F.sum("n").alias(rows)), "copies")
    repeated = not copies.filter(F.col(rows) > 1).isEmpty()
    if repeated:
        docs = one_each(docs, docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    row = F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    n = F.col(times)
    taken = docs.join(copies, (row == F.col(of)) & docs["doc_id"].cast("long").eqNullSafe(F.col(at))) \
        .filter(n > 0).select(*[docs[c] for c in docs.columns], of, times)
    if repeated:  # a row's copies may be very many: DEALT of them at a time
        dealt = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / DEALT)))
        taken = taken.withColumn(part, dealt).repartition(of, part) \
            .withColumn(times, F.least(F.lit(DEALT).cast("long"), n - F.col(part) * DEALT)).drop(part)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), n))).drop(of, times, copy)

"""URL filter rules as a sort-merge range join (operator 11).

A rule (host, path, verdict) fits a url whose host is the rule's or one of its
subdomains, and whose path starts with the rule's; of the rules that fit, the
longest wins (host and path together, then the longer host).  A canonical key
is the host's labels in reverse, each closed by a dot, then ``/`` and the path:
``www.example.com`` with ``/en/`` is ``com.example.www.//en/``.  In the order of
these keys a rule is the interval of the keys that begin with its own, and the
intervals of one host nest or are apart.  A url stands at one point for each
depth of its host at which any rule has its host.

Points and rules are sorted together by ranges of the key and swept.  A rule
carries its stack, itself below the rules it lies in; a point sees the stack
of the last rule before it, drops what has ended there (the keys its own does
not begin with), and takes the top.  A range begins with the stack that the
ranges before it end with.  So each point costs one row of one sort, however
many rules there are, and no host or path is gathered: equal urls are one point,
unequal ones of a hot host lie in many ranges.  DataFrame functions only.

Defined cases: a null url, or one without ``://``, has an empty host and path;
a url that no rule fits has a null rule and the verdict ``default`` (allow); of
rules equal in host and path, block wins; a rule with a null column is left
out; no rules at all give every url the default; every row of ``pages`` gives
one row, repeated ones too; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import lower_ascii, stored

#: The rules of ``op11_url_rules``: host, path, verdict.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
DEFAULT = "allow"
RULE, POINT, SEED = 1, 2, 0     # a range's seed comes first; a rule before the points it holds


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def key_of(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("./"), path)


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows of a short list."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "verdict"), r, strict=True)])
                     for r in rules])
    return spark.range(1).select(F.inline(rows))


def stacked(rules: DataFrame) -> DataFrame:
    """(key, depth, stack) of each rule: itself and the rules whose keys its
    own begins with, shortest first.  Its prefixes meet the rules by equality;
    the work is the rules' total length, and no url takes part."""
    host = lower_ascii(F.col("host"))
    own = rules.filter("host is not null and path is not null and verdict is not null") \
        .groupBy(host.alias("host"), "path").agg(F.max("verdict").alias("verdict")) \
        .select(key_of(_labels(F.col("host")), F.col("path")).alias("key"),
                F.size(_labels(F.col("host"))).alias("depth"), F.length("path").alias("tail"),
                F.struct(F.length("path").alias("tail"), (F.length("host") + F.length("path")).alias("size"),
                         F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"),
                         "verdict", key_of(_labels(F.col("host")), F.col("path")).alias("key")).alias("entry"))
    prefixes = own.select(F.col("key").alias("of"), F.explode(F.sequence(F.lit(0), F.col("tail"))).alias("cut"),
                          (F.length("key") - F.col("tail")).alias("head")) \
        .select("of", F.expr("substring(of, 1, head + cut)").alias("key"))
    stacks = prefixes.join(own.select("key", "entry"), "key").groupBy("of") \
        .agg(F.array_sort(F.collect_list("entry")).alias("stack"))   # at most one entry a character
    return own.join(stacks, own["key"] == stacks["of"]).select("key", "depth", "stack")


def swept(points: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, entry) of each point (key, host, path) inside any rule:
    the longest of the rules (key, stack) whose key its own begins with."""
    spark = points.sparkSession
    none = F.lit(None)
    kind = dict(rules.dtypes)["stack"]
    events = rules.select("key", F.lit(RULE).alias("kind"), none.cast("string").alias("host"),
                          none.cast("string").alias("path"), "stack") \
        .unionByName(points.select("key", F.lit(POINT).alias("kind"), "host", "path", none.cast(kind).alias("stack")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(events.repartitionByRange(ranges, "key", "kind").withColumn("range", F.spark_partition_id()),
                    "ranged")
    # what stands on top at each range's end, carried over ranges without rules: one row a range
    ends = ranged.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == RULE, F.col("key"))).alias("stack"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    seeds = ends.select("range", F.lit("").alias("key"), F.lit(SEED).alias("kind"), none.cast("string").alias("host"),
                        none.cast("string").alias("path"), F.last("stack", True).over(before).alias("stack"))
    along = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.filter("active", lambda r: F.startswith(F.col("key"), r["key"]))
    return ranged.unionByName(seeds.select(*ranged.columns)) \
        .withColumn("active", F.last("stack", True).over(along)).filter(F.col("kind") == POINT) \
        .select("host", "path", F.try_element_at(active, F.lit(-1)).alias("entry")).filter("entry is not null")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    host, path = host_and_path(pages["url"])
    urls = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    stacks = stored(stacked(rules), "rules")
    # the depths of the rules' hosts: a list of d of them takes rules of d * d / 2 characters
    depths = sorted(r["depth"] for r in stacks.select("depth").distinct().collect())
    labels = _labels(F.col("host"))
    depth = F.explode(F.filter(F.lit(depths).cast("array<int>") if depths else F.array().cast("array<int>"),
                               lambda d: d <= F.size(labels)))
    points = urls.select("host", "path").distinct().select("host", "path", depth.alias("depth")) \
        .select(key_of(F.slice(labels, F.lit(1), F.col("depth")), F.col("path")).alias("key"), "host", "path")
    best = swept(points, stacks.drop("depth")).groupBy("host", "path").agg(
        F.max(F.struct("entry.size", "entry.host_size", "entry.rule", "entry.verdict")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

"""Running sums over a whole table that no single task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder


def running_before(df: DataFrame, order: list[str], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows before, by ``order``
    (which must tell rows apart).

    Rows are dealt by ranges of the order and summed inside each range; only
    the totals of the ranges, one row each, are summed in one task.  The ranged
    rows are written to the shared folder, so both sums see the same ranges.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    path = shared_folder(spark, "ranged")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_sum")) \
        .select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(totals, "_range") \
        .withColumn(name, F.col("_earlier") + F.coalesce(F.sum(value).over(within), F.lit(0))) \
        .drop("_range", "_earlier")

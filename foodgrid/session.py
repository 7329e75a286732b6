"""Session construction and small plan helpers shared by every module."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "foodgrid", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """Get or create a session with the settings the plans rely on.

    AQE (coalesce + skew join) is switched on explicitly: the only shuffle
    keys are business ids and (term, location) pairs, and AQE splits a hot
    partition of either at runtime.  ``checkpoint_dir`` is applied only when
    the cluster has not named one already (tests pass a scratch folder).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          # no Python call site per column: half the calls that build a plan
          .config("spark.python.sql.dataFrameDebugging.enabled", "false")
          .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    sc = spark.sparkContext
    # The cluster's own setting wins; ours only fills a gap (tests, bench).
    if checkpoint_dir and not sc.getConf().get("spark.checkpoint.dir", None) \
            and not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_dir)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.  Where that
    is unset only a local session gets a local folder: executors of a cluster
    would not see it."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors see")
        base = tempfile.mkdtemp(prefix="foodgrid-")
        sc.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


#: Partition folders that a write task has open at a time; with more it sorts its rows after all.
OPEN_FOLDERS = 16


@contextlib.contextmanager
def _set_to(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def unsorted_partitions(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside, a write by few partition values keeps one file open for each of them
    and does not sort its rows: a sort holds all rows of a task at their full width."""
    return _set_to(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS))


def released_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside, the shuffle files of a write are deleted when it ends.  Else they stay until
    the driver happens to collect its garbage, and those of all steps add up."""
    return _set_to(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def read_in_splits(spark: SparkSession, size: int) -> contextlib.AbstractContextManager[None]:
    """Inside, a task reads files of about ``size`` bytes, or fewer where that is set."""
    key = "spark.sql.files.maxPartitionBytes"
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    return _set_to(spark, key, f"{max(1, min(size, most))}b")


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of ``df``.  It comes from file sizes; no job runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's estimate of ``df`` is within its own limit for a broadcast."""
    return estimated_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


#: Estimated bytes of input for one shuffle partition, and the most partitions asked for.
SHUFFLE_BYTES, MOST_PARTITIONS = 8 << 20, 20_000


def fits_partitions(df: DataFrame) -> bool:
    """Whether a shuffle of ``df``, by the planner's estimate, has ``SHUFFLE_BYTES`` a partition at most."""
    conf = df.sparkSession.conf
    n = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) \
        or conf.get("spark.sql.shuffle.partitions")
    return estimated_bytes(df) <= SHUFFLE_BYTES * int(n)


def sized_shuffles(df: DataFrame) -> DataFrame:
    """``df``, its session set to shuffle rows of its size in partitions of ``SHUFFLE_BYTES``.

    With a fixed number of partitions, what a task sorts grows with the input.  The
    number that AQE starts from is raised in proportion (never lowered).  Beside an
    input of more than one such partition, however many are configured, AQE coalesces
    to no more than ``SHUFFLE_BYTES`` and takes four times that for skewed: its own
    sizes suit rows that are not widened after the shuffle.  A session setting and not
    ``repartition(n)``, whose partitions AQE would not split where a key is skewed.
    An input that the configured number and sizes suit changes nothing.
    """
    spark = df.sparkSession
    conf, size = spark.conf, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    first, adaptive = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive."
    now = int(conf.get(first, None) or conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_PARTITIONS, -(-estimated_bytes(df) // SHUFFLE_BYTES))
    if wanted > now:
        conf.set(first, str(wanted))
    if wanted > 1:
        for key, most in ((adaptive + "advisoryPartitionSizeInBytes", SHUFFLE_BYTES),
                          (adaptive + "skewJoin.skewedPartitionThresholdInBytes", 4 * SHUFFLE_BYTES)):
            if size(conf.get(key)) > most:
                conf.set(key, f"{most}b")
    return df

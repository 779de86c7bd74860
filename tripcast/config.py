"""Business rules (one frozen dataclass) and session helpers."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame


# Fixed values that the results depend on: passenger range, duration and
# timeout limits, watermark delay, window sizes, topic names, bucket hours.
@dataclass(frozen=True)
class Rules:
    max_passengers: int = 8
    max_duration_seconds: int = 3 * 60 * 60
    timeout_seconds: int = 48 * 60 * 60
    out_of_orderness_seconds: int = 30
    daily_window: str = "24 hours"
    weekly_window: str = "7 days"
    weekly_offset: str = "4 days"  # epoch day 0 is a Thursday; +4 days starts weeks on Monday
    last_hour_window_minutes: int = 60
    last_hour_slide_minutes: int = 5
    gauge_window_seconds: int = 3 * 60 * 60
    gauge_tick_seconds: int = 60
    gauge_block_ticks: int = 1440  # prefix sums run per block of ticks (one day at 1 min)
    pickup_topic: str = "pickup_events"
    dropoff_topic: str = "dropoff_events"
    unknown_borough: str = "Unknown"


DEFAULT_RULES = Rules()

# time-of-day buckets by dropoff hour: [start, end) -> name; other hours are night
TIME_OF_DAY_BUCKETS = (
    (5, 11, "morning"),
    (11, 14, "noon"),
    (14, 17, "afternoon"),
    (17, 23, "evening"),
)
NIGHT = "night"


def get_session(master: str | None = None, app_name: str = "tripcast",
                shuffle_partitions: int | None = None, local_memory: str | None = None) -> SparkSession:
    """Return (or create) a session with the settings the operators rely on.

    On a cluster the master, memory and checkpoint folder come from the
    cluster configuration; only unset values get local defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if local_memory and master and master.startswith("local"):
        # local mode runs everything in the driver JVM; a cluster sets its own memory
        builder = builder.config("spark.driver.memory", local_memory)
    spark = builder.getOrCreate()
    apply_session_settings(spark)
    return spark


def apply_session_settings(spark: SparkSession) -> None:
    """Settings that must hold for correct results on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared checkpoint folder.

    One write job (an RDD checkpoint would run a second job to write its
    files), and readers of the table get column pruning and pushed filters.
    A lost executor after the write costs nothing: the table is on shared
    storage.
    """
    import uuid

    path = scratch_path(df.sparkSession, f"tables/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of a batch source that arrives in too few partitions.

    Per-row work (JSON parsing, rule evaluation) runs in the scan's tasks; a
    source with fewer splits than the cluster has cores (one unsplittable
    file, a topic with one partition) would leave cores idle. Wide inputs
    and streams are returned unchanged. Apply it to a source scan: counting
    partitions of a scan only plans its splits, while on a derived plan it
    would run the plan's broadcasts or shuffles.
    """
    if df.isStreaming or not isinstance(df, ClassicDataFrame):
        return df  # a Spark Connect session has no RDDs to count partitions of
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= target else df.repartition(target)

"""Idempotent table writers (K-S1 .. K-S9).

The reference commits one database row at a time with ``ON CONFLICT``.
Here a sink is a set operation on DataFrames plus one file write per batch:

* insert-ignore (rejected_events, invalid_trips): first row per key wins;
  rows whose key is already in the target are dropped by a left anti join.
* upsert (aggregates): last row per key wins; only the partitions a batch
  touches are rewritten (dynamic partition overwrite), after the old rows
  of those partitions were merged in and the merge was written to the
  shared checkpoint folder (never read and overwrite the same files).
* guarded append (raw_trips, event log): refuse when the target has rows.

Replaying a batch leaves every table unchanged, which is what recovery by
replay (T15) needs.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripcast.config import checkpoint_dir
from tripcast.schemas import AGGREGATE_KEYS


# ---------------------------------------------------------------- set logic

def with_payload_key(rejected: DataFrame) -> DataFrame:
    """Add the de-duplication key of rejected events: md5 of the raw payload (F8)."""
    return rejected.withColumn("payload_md5", F.md5(F.col("raw_payload")))


def dedupe_rejected(rejected: DataFrame) -> DataFrame:
    """Rejected events with one row per (topic, md5(raw_payload)) (K-S1).

    Equal payloads of one topic get equal reasons, so grouping on the full
    row is the same as first-wins on the key, and stays a hash aggregation
    with partial aggregation for a payload repeated millions of times.
    """
    keyed = with_payload_key(rejected)
    return keyed.select("topic", "reason", "raw_payload", "payload_md5").distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order`` (insert-ignore within one batch)."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first._v_{c}").alias(c) for c in rest]).select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order`` (upsert within one batch)."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_v_{c}") for c in rest])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last._v_{c}").alias(c) for c in rest]).select(*df.columns)


def first_invalid(trips: DataFrame) -> DataFrame:
    """invalid_trips: first emitted row per trip_id; ties by reason (K-S2)."""
    invalid = trips.where(~F.col("is_valid")).drop("is_valid")
    return first_per_key(invalid, ["trip_id"], ["event_time", "invalid_reason"])


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not in the target yet (insert-ignore)."""
    return incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def upsert_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = AGGREGATE_KEYS) -> DataFrame:
    """Target after upserting ``incoming``: its rows replace existing rows with the same key (K-S3)."""
    keep = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return keep.unionByName(incoming.select(*existing.columns))


# ---------------------------------------------------------------- file tables

def _has_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table has rows; a missing folder or one without bytes has none, and an unreadable table raises."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder) or fs.getContentSummary(folder).getLength() == 0:
        return False
    return not spark.read.format(fmt).load(path).isEmpty()


def append_if_empty(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> bool:
    """Write ``df`` only when the target is empty; False when refused (K-S5, K-S9, A14)."""
    if _has_rows(df.sparkSession, path, fmt):
        return False
    w = df.write.mode("append").format(fmt)  # never overwrites: rows that came in meanwhile stay
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return True


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV export with header (K-S7), one folder per slice when partitioned."""
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] | None = None) -> None:
    """Insert-ignore into a parquet table on ``keys`` (K-S1, K-S2, K-S4 mode 'ignore')."""
    spark = df.sparkSession
    batch = first_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))
    if _has_rows(spark, path):
        batch = new_rows(batch, spark.read.parquet(path), keys)
    batch.write.mode("append").parquet(path)


def unseen(rows: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the table lacks; of the table only the keys that the rows hold leave the scan's tasks."""
    spark = rows.sparkSession
    if not _has_rows(spark, path):
        return rows
    wanted = rows.select(*keys).distinct()
    held = spark.read.parquet(path).select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return new_rows(rows, held, keys)


def write_epoch(df: DataFrame, path: str, epoch_id: int) -> bool:
    """Write one micro-batch to ``path/epoch=<id>`` unless that epoch was committed already.

    The rows are written to a hidden folder, which readers skip, and moved into place as
    a whole: a reader sees all of an epoch or nothing, and a replayed epoch, which carries
    the same rows, finds its folder and adds nothing. The move is one rename, atomic on
    file systems such as HDFS. Cost is proportional to the batch, not the table.
    """
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    target = jpath(os.path.join(path, f"epoch={epoch_id}"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    stage = os.path.join(path, "_staging", f"{epoch_id}-{uuid.uuid4().hex}")
    df.write.parquet(stage)
    if not fs.rename(jpath(stage), target):
        raise OSError(f"epoch {epoch_id} of {path} could not be moved into place")
    return True


def upsert_partitions(df: DataFrame, path: str, keys: Sequence[str] = AGGREGATE_KEYS,
                      partition_by: Sequence[str] = ("metric_name", "window_date"),
                      order: Sequence[str] | None = None) -> None:
    """Upsert into a partitioned parquet table (K-S3, K-S4 mode 'upsert').

    Only partitions present in ``df`` are rewritten. ``window_date`` is
    derived from ``window_start`` when it is a partition column.
    """
    spark = df.sparkSession
    if "window_date" in partition_by and "window_date" not in df.columns:
        df = df.withColumn("window_date", F.to_date("window_start"))
    if order is None:  # the batch's own order: the last row of a key wins
        df, order = df.withColumn("_arrival", F.monotonically_increasing_id()), ["_arrival"]
    batch = last_per_key(df, keys, order).drop("_arrival")
    if _has_rows(spark, path):
        existing = spark.read.parquet(path)
        touched = batch.select(*partition_by).distinct()
        old = existing.join(touched, list(partition_by), "left_semi")
        merged = upsert_rows(old.select(*batch.columns), batch, keys)
    else:
        merged = batch
    # the merge reads files that the overwrite replaces: stage it in the shared folder first
    stage = os.path.join(checkpoint_dir(spark), f"upsert-{uuid.uuid4().hex}")
    merged.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    (staged.repartition(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    _delete(spark, stage)


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a staging folder of ours from the (shared) file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace_rows(df: DataFrame, path: str) -> int:
    """Replace all rows of a small table at once (K-S6); returns the new version.

    A version is written aside and moved into place as a whole; readers (``read_current``)
    take the highest one, so they see the old rows or the new ones, and a
    failed refresh changes nothing. Versions but the last two are deleted.
    """
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    known = _versions(spark, path)
    version = max(known, default=0) + 1
    stage = os.path.join(path, "_staging", uuid.uuid4().hex)
    df.write.parquet(stage)
    if not fs.rename(jpath(stage), jpath(os.path.join(path, f"version={version}"))):
        raise OSError(f"version {version} of {path} could not be moved into place")
    for old in sorted(known)[:-1]:
        _delete(spark, os.path.join(path, f"version={old}"))
    return version


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The last version that ``replace_rows`` put in place."""
    known = _versions(spark, path)
    if not known:
        raise ValueError(f"{path} has no version yet")
    return spark.read.parquet(os.path.join(path, f"version={max(known)}"))


def topic_has_records(spark: SparkSession, topic: str, bootstrap_servers: str | None = None, fallback_path: str | None = None) -> bool:
    """Whether a topic holds records (K-S9)."""
    if bootstrap_servers:
        found = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
                 .option("startingOffsets", "earliest").option("endingOffsets", "latest").load())
        return not found.isEmpty()
    return _has_rows(spark, os.path.join(fallback_path, f"topic={topic}"))


def publish_topic(df: DataFrame, topic: str, bootstrap_servers: str | None = None, fallback_path: str | None = None,
                  order: Sequence[str] = (), carry: Sequence[str] = (), made: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """Keyed publish (K-S8): key = trip id, value = JSON; False and nothing sent if the topic has records (K-S9).

    Without a broker the topic is a folder of Parquet files, which also keep ``carry``. ``order``: the
    records of each file are in this order, and files hold ranges of it. ``made`` gives the records their
    key and value after they were put in order, so that the sort carries only what these are made of.
    """
    if topic_has_records(df.sparkSession, topic, bootstrap_servers, fallback_path):
        return False
    out = df.orderBy(*order) if order else df
    out = made(out) if made else out
    out = out.select(F.col("key").cast("string"), F.col("value").cast("string"), *(c for c in dict.fromkeys((*carry, *order))))
    if bootstrap_servers:
        (out.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).option("kafka.acks", "all").save())
    else:
        # ids are random digits, which only a codec with entropy coding makes smaller
        out.write.option("compression", "zstd").parquet(os.path.join(fallback_path, f"topic={topic}"))
    return True

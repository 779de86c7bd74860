"""Event topic sources.

A topic is any DataFrame with a ``value`` STRING column (and optionally a
``key``). With a Kafka connector on the class path the same function reads a
broker; tests and files use the text source, one JSON document per line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripcast.config import spread


@dataclass(frozen=True)
class TopicSource:
    """Where one event topic lives (S8): a Kafka topic or a folder of text files."""

    topic: str
    format: str = "kafka"          # "kafka" or "text"
    path: str | None = None        # folder for format="text"
    bootstrap_servers: str | None = None
    group_id: str | None = None
    max_files_per_trigger: int | None = None


def _kafka_options(src: TopicSource) -> dict[str, str]:
    opts = {"subscribe": src.topic, "startingOffsets": "earliest"}
    if src.bootstrap_servers:
        opts["kafka.bootstrap.servers"] = src.bootstrap_servers
    if src.group_id:
        opts["groupIdPrefix"] = src.group_id  # a fixed group would split the topic between queries
    return opts


def read_topic(spark: SparkSession, src: TopicSource) -> DataFrame:
    """Bounded read of a topic: key, value (batch)."""
    if src.format == "kafka":
        raw = spread(spark.read.format("kafka").options(**_kafka_options(src)).load())
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    return spread(spark.read.text(src.path)).select(F.lit(None).cast("string").alias("key"), "value")


def read_topic_stream(spark: SparkSession, src: TopicSource) -> DataFrame:
    """Unbounded read of a topic from the earliest offset: key, value."""
    if src.format == "kafka":
        raw = spark.readStream.format("kafka").options(**_kafka_options(src)).load()
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if src.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(src.max_files_per_trigger))
    return reader.load(src.path).select(F.lit(None).cast("string").alias("key"), "value")

"""Structured Streaming form of the job.

Query A reads both topics, validates (same projection as batch), puts a
30 s watermark on each valid stream after validation (rejected messages
never move event time), unions them and runs the stateful trip join. Trips
go to a file sink, whose commit log every reader of the table obeys, batch or
stream: files that a failed attempt left behind are no rows (T15). rejected_events
keeps one row per topic + md5 of the payload, and ``start_invalid_query`` the first
invalid row per trip id for invalid_trips: each micro-batch is reduced by the rule of batch
and what the table holds already is left out, so that no key set grows in a state store
and a duplicate is ignored however late it comes. Both write one folder per epoch, moved
into place when it is whole. ``LateRows`` counts what came behind the watermark (T7).
Metric queries read the trips table as a stream, put their own watermark on the trip
event time and aggregate each grain in append mode; their ``foreachBatch`` upserts into
the aggregates table.

Every query has its own checkpoint folder under the shared checkpoint
location; replays after a failure rewrite nothing twice because every sink
is keyed and idempotent.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tripcast.config import DEFAULT_RULES, Rules, checkpoint_dir
from tripcast.operators import enrich, metrics as M, validation as V
from tripcast.schemas import TRIPS
from tripcast.sinks import writers
from tripcast.sources.events import TopicSource, read_topic_stream
from tripcast.streaming.gauge import bucket_ticks, gauge_sink
from tripcast.streaming.join_processor import TripJoinProcessor


class LateRows(StreamingQueryListener):
    """Account of rows that came behind the watermark and were left out (T7): ``dropped`` per query id.

    Register it with ``spark.streams.addListener`` before the queries start.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryTerminated(self, event) -> None:
        pass


def watermarked(events: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Bounded out-of-orderness watermark on validated events."""
    return events.withWatermark("event_time", f"{rules.out_of_orderness_seconds} seconds")


def join_input(pickups: DataFrame, dropoffs: DataFrame) -> DataFrame:
    """Union of both sides in one shape for the keyed processor."""
    p = pickups.select("trip_id", F.lit("pickup").alias("side"), "event_time",
                       F.col("pickup_zone").alias("zone"), "passenger_count",
                       F.lit(None).cast("double").alias("trip_distance"),
                       F.lit(None).cast("double").alias("total_amount"))
    d = dropoffs.select("trip_id", F.lit("dropoff").alias("side"), "event_time",
                        F.col("dropoff_zone").alias("zone"),
                        F.lit(None).cast("double").alias("passenger_count"),
                        "trip_distance", "total_amount")
    return p.unionByName(d)


def stream_trips(pickups: DataFrame, dropoffs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Keyed stateful join with event-time timers (J1 streaming)."""
    u = join_input(watermarked(pickups, rules), watermarked(dropoffs, rules))
    return u.groupBy("trip_id").transformWithState(
        TripJoinProcessor(rules), TRIPS, "Append", "EventTime")


def stream_metric_rows(trips: DataFrame, grain: M.Grain, zones: DataFrame,
                       rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Windowed statistics of valid trips in append mode, as metric rows."""
    valid = trips.where(F.col("is_valid"))
    enriched = enrich.enrich_trips(valid, zones, rules)
    # two chained aggregations: a trip updates one state row, not one for each sliding window that holds it
    return M.to_metric_rows(M.window_stats(watermarked(enriched, rules), grain, rules), grain.metrics)


def _insert_ignore_sink(path: str, keys: list[str], reduced):
    """foreachBatch function: the micro-batch's rows by key that the table lacks (K-S1, K-S2)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        rows = reduced(batch).persist()  # read by the look-up and the write
        writers.write_epoch(writers.unseen(rows, path, keys), path, epoch_id)
        rows.unpersist()
    return write


def _aggregate_sink(out_dir: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        writers.upsert_partitions(batch, os.path.join(out_dir, "aggregates"))
    return write


def _trips_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    """The trips table as a stream; its folder is made if no trip was written yet, so all queries can start at once."""
    path = os.path.join(out_dir, "trips")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return spark.readStream.schema(TRIPS).parquet(path)


def start_trip_query(spark: SparkSession, pickup_src: TopicSource, dropoff_src: TopicSource, out_dir: str,
                     rules: Rules = DEFAULT_RULES, trigger: dict | None = None,
                     checkpoint_root: str | None = None) -> list[StreamingQuery]:
    """Query A (parse, validate, join) and the dead-letter query."""
    root = checkpoint_root or os.path.join(checkpoint_dir(spark), "streams")
    trigger = trigger or {"processingTime": "10 seconds"}
    pp = V.parse_events(read_topic_stream(spark, pickup_src), "pickup", pickup_src.topic, rules)
    dp = V.parse_events(read_topic_stream(spark, dropoff_src), "dropoff", dropoff_src.topic, rules)
    trips = stream_trips(V.pickups(pp), V.dropoffs(dp), rules)
    q_trips = (trips.writeStream.format("parquet").option("path", os.path.join(out_dir, "trips")).outputMode("append")
               .option("checkpointLocation", os.path.join(root, "trips")).trigger(**trigger).start())
    sink = _insert_ignore_sink(os.path.join(out_dir, "rejected_events"), ["topic", "payload_md5"], writers.dedupe_rejected)
    q_rej = (V.all_rejected(pp, dp).writeStream.foreachBatch(sink)
             .option("checkpointLocation", os.path.join(root, "rejected")).trigger(**trigger).start())
    return [q_trips, q_rej]


def start_invalid_query(spark: SparkSession, out_dir: str, rules: Rules = DEFAULT_RULES,
                        trigger: dict | None = None, checkpoint_root: str | None = None) -> StreamingQuery:
    """invalid_trips from the trips table: first emitted row per trip_id (K-S2)."""
    root = checkpoint_root or os.path.join(checkpoint_dir(spark), "streams")
    trigger = trigger or {"processingTime": "10 seconds"}
    sink = _insert_ignore_sink(os.path.join(out_dir, "invalid_trips"), ["trip_id"], writers.first_invalid)
    return (_trips_stream(spark, out_dir).writeStream.foreachBatch(sink)
            .option("checkpointLocation", os.path.join(root, "invalid")).trigger(**trigger).start())


def start_gauge_query(spark: SparkSession, pickup_src: TopicSource, dropoff_src: TopicSource, out_dir: str,
                      rules: Rules = DEFAULT_RULES, trigger: dict | None = None,
                      checkpoint_root: str | None = None) -> StreamingQuery:
    """Lifecycle signals (T13) -> open-trips gauge ticks upserted into aggregates."""
    root = checkpoint_root or os.path.join(checkpoint_dir(spark), "streams")
    trigger = trigger or {"processingTime": "60 seconds"}
    pp = V.parse_events(read_topic_stream(spark, pickup_src), "pickup", pickup_src.topic, rules)
    dp = V.parse_events(read_topic_stream(spark, dropoff_src), "dropoff", dropoff_src.topic, rules)
    signals = V.lifecycle(watermarked(V.pickups(pp), rules), watermarked(V.dropoffs(dp), rules))
    return (bucket_ticks(signals, rules).writeStream.foreachBatch(gauge_sink(out_dir, rules))
            .option("checkpointLocation", os.path.join(root, "gauge")).trigger(**trigger).start())


def start_metric_queries(spark: SparkSession, zones: DataFrame, out_dir: str, rules: Rules = DEFAULT_RULES,
                         trigger: dict | None = None, checkpoint_root: str | None = None) -> list[StreamingQuery]:
    """One query per grain over the trips table, upserting the aggregates table (U3, K-S3)."""
    root = checkpoint_root or os.path.join(checkpoint_dir(spark), "streams")
    trigger = trigger or {"processingTime": "10 seconds"}
    out = []
    for g in M.grains(rules):
        trips = _trips_stream(spark, out_dir)
        rows = stream_metric_rows(trips, g, zones, rules)
        out.append(rows.writeStream.foreachBatch(_aggregate_sink(out_dir)).outputMode("append")
                   .option("checkpointLocation", os.path.join(root, f"metrics_{g.name}"))
                   .trigger(**trigger).start())
    return out

"""Batch form of the whole job: topics -> validation -> trip join -> metrics.

One logical plan per output table. ``TripTables`` holds the lazily built
DataFrames; nothing runs until an output is written or collected. For a
run that writes several outputs, ``materialize=True`` writes the trip
table once to the shared checkpoint folder so the four metric grains and
the sinks read it instead of re-parsing the topics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripcast.config import DEFAULT_RULES, Rules, materialize as _materialize
from tripcast.operators import enrich, gauge, metrics, pairing, trips as trip_ops, validation as V
from tripcast.sources import fixtures


@dataclass
class TripTables:
    parsed_pickups: DataFrame
    parsed_dropoffs: DataFrame
    pickups: DataFrame
    dropoffs: DataFrame
    pairs: DataFrame
    bound: Column | None
    trips: DataFrame
    enriched: DataFrame
    close: str
    rules: Rules

    @property
    def rejected(self) -> DataFrame:
        return V.all_rejected(self.parsed_pickups, self.parsed_dropoffs)

    @property
    def valid(self) -> DataFrame:
        return trip_ops.valid_trips(self.trips)

    @property
    def invalid(self) -> DataFrame:
        return trip_ops.invalid_trips(self.trips)

    @property
    def lifecycle(self) -> DataFrame:
        return V.lifecycle(self.pickups, self.dropoffs)

    def metrics(self) -> DataFrame:
        return metrics.all_metrics(self.enriched, self.rules, self.bound)

    def metric(self, name: str) -> DataFrame:
        return metrics.metric(self.enriched, name, self.rules, self.bound)

    def stats(self, grain_name: str) -> DataFrame:
        return metrics.window_stats(self.enriched, metrics.grain(grain_name, self.rules), self.rules,
                                    bound=self.bound)

    def open_trips(self) -> DataFrame:
        return gauge.open_trips(self.pairs, self.rules, self.bound if self.close == "watermark" else None)

    def aggregates(self) -> DataFrame:
        """Every metric row, windowed metrics and the gauge."""
        return self.metrics().unionByName(self.open_trips())


def build(pickup_records: DataFrame, dropoff_records: DataFrame, zones: DataFrame,
          rules: Rules = DEFAULT_RULES, close: str = "watermark", materialize: bool = False) -> TripTables:
    """Wire the job over two topics of JSON records (``value`` column each)."""
    pp = V.parse_events(pickup_records, "pickup", rules.pickup_topic, rules)
    pd_ = V.parse_events(dropoff_records, "dropoff", rules.dropoff_topic, rules)
    pk, dk = V.pickups(pp), V.dropoffs(pd_)
    sides = trip_ops.both_sides(pk, dk)
    g = trip_ops.cogrouped(sides)
    if materialize:
        g = _materialize(g)
        pairs = pairing.single_pairs(g)
        # a second read of the topics only if a trip id has more than one event on a side
        if not g.where(pairing.repeats(g)).isEmpty():
            pairs = pairs.unionByName(_materialize(pairing.repeated_pairs(g, sides, rules)))
    else:
        pairs = pairing.pairs(g, sides, rules)
    bound = trip_ops.final_watermark(pairs, rules) if close == "watermark" else None
    trips = trip_ops.trips_from_pairs(pairs, rules, close, bound)
    valid = trip_ops.valid_trips(trips)
    enriched = enrich.enrich_trips(valid, zones, rules)
    return TripTables(pp, pd_, pk, dk, pairs, bound, trips, enriched, close, rules)


def build_from_fixture(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
                       close: str = "watermark", materialize: bool = False) -> TripTables:
    """The job over the event log derived from the test tables (fixture A2)."""
    log = fixtures.event_log_fixture(spark, sf_dir, rules)
    pick = log.where(F.col("topic") == rules.pickup_topic).select("key", "value")
    drop = log.where(F.col("topic") == rules.dropoff_topic).select("key", "value")
    return build(pick, drop, fixtures.zone_fixture(spark, sf_dir), rules, close, materialize)


# ---------------------------------------------------------------- jobs

def run_trip_job(pickup_records: DataFrame, dropoff_records: DataFrame, zones: DataFrame, out_dir: str,
                 rules: Rules = DEFAULT_RULES, close: str = "watermark") -> TripTables:
    """Batch run of the whole job into ``out_dir``: aggregates (upsert), invalid_trips and
    rejected_events (insert-ignore). Re-running with the same or more input is idempotent."""
    import os

    from tripcast.sinks import writers

    t = build(pickup_records, dropoff_records, zones, rules, close, materialize=True)
    writers.append_new(writers.first_invalid(t.trips), os.path.join(out_dir, "invalid_trips"), ["trip_id"])
    writers.append_new(writers.dedupe_rejected(t.rejected), os.path.join(out_dir, "rejected_events"),
                       ["topic", "payload_md5"])
    writers.upsert_partitions(t.aggregates(), os.path.join(out_dir, "aggregates"))
    return t


def run_cleaning_job(raw: DataFrame, zones: DataFrame, raw_trips_path: str,
                     rules: Rules = DEFAULT_RULES) -> DataFrame | None:
    """Clean raw trip rows into the raw_trips table (V1-V4, K-S5).

    Refuses (returns None) when the table already has rows; otherwise
    returns the load summary (status, reason, rows), counted while the rows were written.
    """
    from tripcast.operators import cleaning
    from tripcast.sinks import writers

    cleaned, seen = cleaning.counted(cleaning.clean_trips(raw, zones, rules))
    if not writers.append_if_empty(cleaning.accepted_trips(cleaned), raw_trips_path):
        return None
    return cleaning.observed_summary(raw.sparkSession, seen)


def run_zones_job(spark: SparkSession, csv_path: str, zones_path: str) -> DataFrame:
    """Replace the zone dimension by the zones of a lookup file (S1, K-S6); returns the new table."""
    from tripcast.sinks import writers
    from tripcast.sources.zones import read_zones_csv

    writers.replace_rows(read_zones_csv(spark, csv_path), zones_path)
    return writers.read_current(spark, zones_path)


def run_publish_job(raw_trips: DataFrame, event_log_path: str, rules: Rules = DEFAULT_RULES,
                    bootstrap_servers: str | None = None) -> bool:
    """Derive the event log of a raw_trips table and publish both topics (O2-O4, K-S8, K-S9).

    Trip ids come from each row's content (O3), so a re-run derives the same
    ids, also after the table was rewritten. Every record carries its place in replay order.
    Nothing is sent if one of the topics has records.
    """
    from tripcast.operators import eventlog
    from tripcast.sinks import writers

    spark, topics = raw_trips.sparkSession, (rules.pickup_topic, rules.dropoff_topic)
    if any(writers.topic_has_records(spark, t, bootstrap_servers, event_log_path) for t in topics):
        return False
    # records are dealt and sorted without their texts: ids as bytes, which sort as their hex digits do
    with_ids = eventlog.assign_trip_ids(raw_trips).withColumn("trip_id", F.unhex("trip_id"))
    pickup, dropoff, payload = eventlog.payload_fields()
    events = eventlog.trip_events(with_ids, rules, pickup, dropoff).drop("topic")
    log = eventlog.replay_positions(events)  # reads a written table
    for topic, rank in zip(topics, (eventlog.PICKUP_RANK, eventlog.DROPOFF_RANK), strict=True):
        own = log.where(F.col("kind_rank") == rank)
        writers.publish_topic(own, topic, bootstrap_servers, event_log_path, order=("sequence",), carry=("event_time", "sequence"),
                              made=lambda d: d.withColumn("key", F.lower(F.hex("key"))).withColumn("value", payload))
    return True

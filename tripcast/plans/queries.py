"""Registered queries: one per operator id of the inventory.

Every query reads the provided tables of one scale-factor folder (or data
Spark derives from them) and returns a DataFrame with aliased columns;
timestamps leave as TIMESTAMP_NTZ (UTC wall clock), counts as BIGINT and
measures as DOUBLE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripcast.config import DEFAULT_RULES, apply_session_settings, scratch_path
from tripcast.functions.timefn import iso_week_label, time_of_day, to_ntz
from tripcast.operators import cleaning, eventlog, metrics as M, trips as T_, validation as V
from tripcast.plans import batch, reports
from tripcast.sinks import writers
from tripcast.sources import fixtures
from tripcast.sources.trips import date_slices, ordered_trips, read_trips_csv, table_slices, write_by_month, year_slices
from tripcast.sources.zones import read_zones_csv, valid_zone_ids

Query = Callable[[SparkSession, str], DataFrame]
R = DEFAULT_RULES


def _tables(spark: SparkSession, sf: str, close: str = "watermark", materialize: bool = True) -> batch.TripTables:
    """The batch job over the fixture topics; the co-grouped trip state is
    checkpointed once so every output and the watermark scalar read it."""
    apply_session_settings(spark)
    return batch.build_from_fixture(spark, sf, R, close, materialize=materialize)


def _parsed(spark: SparkSession, sf: str) -> batch.TripTables:
    """Only the validation half is used: no trip state to materialize."""
    return _tables(spark, sf, materialize=False)


def _trip_out(df: DataFrame) -> DataFrame:
    """Trip rows with naive timestamps, as compared with the SQL check."""
    return df.select(
        "trip_id", "pickup_zone", "dropoff_zone",
        to_ntz(F.col("pickup_datetime")).alias("pickup_datetime"),
        to_ntz(F.col("dropoff_datetime")).alias("dropoff_datetime"),
        "duration_seconds", "trip_distance", "passenger_count", "total_amount",
        "is_valid", "invalid_reason", to_ntz(F.col("event_time")).alias("event_time"),
    )


# ------------------------------------------------------------------ sources

def _scratch(spark, name):
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


def s1_zone_scan(spark, sf):
    """The zones as a lookup file, read back."""
    path = _scratch(spark, "zones")
    zones = fixtures.zone_fixture(spark, sf)
    writers.export_csv(zones.withColumnsRenamed({"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}), path)
    return read_zones_csv(spark, path)


def ks6_zones_refresh(spark, sf):
    """The zone table, first with changed and surplus rows, then replaced by the lookup file (K-S6)."""
    path, table = _scratch(spark, "zones"), _scratch(spark, "zones-table")
    zones = fixtures.zone_fixture(spark, sf)
    writers.replace_rows(zones.unionByName(zones.withColumns({"location_id": F.col("location_id") + 1000, "borough": F.lit("old")})), table)
    writers.export_csv(zones.withColumnsRenamed({"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}), path)
    return batch.run_zones_job(spark, path, table)


def s2_raw_trips(spark, sf):
    """The raw trips as CSV files, read back."""
    path = _scratch(spark, "trips-csv")
    writers.export_csv(fixtures.raw_trip_fixture(spark, sf), path)
    return read_trips_csv(spark, path)


# number, first day, last day
NAMED_SLICES = [(1, "1995-03-09", "1995-06-30"), (2, "1996-02-27", "1996-03-01"), (3, "1997-12-31", "1998-01-01"), (9, "2031-01-01", "2031-12-31")]


def s3_named_slices(spark, sf):
    """Slices with named first and last days, by bounds that reach the scan (S3)."""
    raw = fixtures.raw_trip_fixture(spark, sf).withColumn("_pickup", F.try_to_timestamp(F.col("pickup_datetime")))
    return date_slices(raw, NAMED_SLICES, ts_col="_pickup").drop("_pickup")


def s3_table_slices(spark, sf):
    """The same slices of a table with a folder per month (S3)."""
    path = _scratch(spark, "trips-by-month")
    raw = fixtures.raw_trip_fixture(spark, sf).withColumn("_pickup", F.try_to_timestamp(F.col("pickup_datetime")))
    write_by_month(raw, path, ts_col="_pickup")
    return table_slices(spark, path, NAMED_SLICES, ts_col="_pickup").drop("_pickup")


FIRST_YEAR = 1995  # has slice number 1


def s3_date_slices(spark, sf):
    raw = fixtures.raw_trip_fixture(spark, sf).withColumn(
        "_pickup", F.try_to_timestamp(F.col("pickup_datetime")))
    return year_slices(raw, FIRST_YEAR, ts_col="_pickup").drop("_pickup")


def s4_ordered_trips(spark, sf):
    cleaned = cleaning.clean_trips(fixtures.raw_trip_fixture(spark, sf), fixtures.cleaning_zone_fixture(spark, sf))
    acc = cleaning.accepted_trips(cleaned)
    return ordered_trips(acc.select(
        to_ntz(F.col("pickup_datetime")).alias("pickup_datetime"),
        to_ntz(F.col("dropoff_datetime")).alias("dropoff_datetime"),
        "pickup_zone", "dropoff_zone", "passenger_count",
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("total_amount").cast("double").alias("total_amount")))


def s7_valid_zone_ids(spark, sf):
    return valid_zone_ids(fixtures.zone_fixture(spark, sf))


# ------------------------------------------------------------------ cleaning

def _cleaned(spark, sf):
    return cleaning.clean_trips(fixtures.raw_trip_fixture(spark, sf), fixtures.cleaning_zone_fixture(spark, sf))


def v1_clean_reasons(spark, sf):
    c = _cleaned(spark, sf)
    return c.select(*fixtures.raw_trip_fixture(spark, sf).columns, "reason")


def v2_coerced_times(spark, sf):
    c = _cleaned(spark, sf)
    return c.select("pickup_datetime", "dropoff_datetime",
                    to_ntz(F.col("pickup_ts")).alias("pickup_ts"), to_ntz(F.col("dropoff_ts")).alias("dropoff_ts"))


def v3_raw_trips(spark, sf):
    acc = cleaning.accepted_trips(_cleaned(spark, sf))
    return acc.select(
        to_ntz(F.col("pickup_datetime")).alias("pickup_datetime"),
        to_ntz(F.col("dropoff_datetime")).alias("dropoff_datetime"),
        "pickup_zone", "dropoff_zone", "passenger_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("trip_distance").cast("double").alias("trip_distance"))


def v4_load_summary(spark, sf):
    return cleaning.load_summary(_cleaned(spark, sf))


def j5_zone_semi(spark, sf):
    return cleaning.zone_semi(fixtures.raw_trip_fixture(spark, sf), fixtures.cleaning_zone_fixture(spark, sf))


def j5_zone_anti(spark, sf):
    return cleaning.zone_anti(fixtures.raw_trip_fixture(spark, sf), fixtures.cleaning_zone_fixture(spark, sf))


# ------------------------------------------------------------------ events

def o2_event_log(spark, sf):
    log = eventlog.order_event_log(fixtures.event_log_fixture(spark, sf, R))
    return log.select("topic", "key", to_ntz(F.col("event_time")).alias("event_time"), "kind_rank", "value")


def o2_replay_positions(spark, sf):
    """Every event's place in replay order."""
    log = eventlog.replay_positions(fixtures.event_log_fixture(spark, sf, R))
    return log.select("sequence", "topic", "key", to_ntz(F.col("event_time")).alias("event_time"))


def o3_trip_ids(spark, sf):
    """Stable surrogate id per source row, from the row and its number among equal rows."""
    li = eventlog.assign_trip_ids(fixtures.load_table(spark, sf, "lineitem"))
    return li.select("l_orderkey", "l_linenumber", "trip_id")


def v6_pickup_reasons(spark, sf):
    t = _parsed(spark, sf)
    return t.parsed_pickups.select("raw_payload", "reason")


def v6_dropoff_reasons(spark, sf):
    t = _parsed(spark, sf)
    return t.parsed_dropoffs.select("raw_payload", "reason")


def v6_reason_counts(spark, sf):
    t = _parsed(spark, sf)
    return (V.reason_counts(t.parsed_pickups).withColumn("topic", F.lit(R.pickup_topic))
            .unionByName(V.reason_counts(t.parsed_dropoffs).withColumn("topic", F.lit(R.dropoff_topic))))


def v8_valid_pickups(spark, sf):
    t = _parsed(spark, sf)
    return t.pickups.withColumn("event_time", to_ntz(F.col("event_time")))


def v8_valid_dropoffs(spark, sf):
    t = _parsed(spark, sf)
    return t.dropoffs.withColumn("event_time", to_ntz(F.col("event_time")))


def u1_rejected_union(spark, sf):
    return _parsed(spark, sf).rejected


def t13_lifecycle(spark, sf):
    return _parsed(spark, sf).lifecycle.withColumn("event_time", to_ntz(F.col("event_time")))


# ------------------------------------------------------------------ trips

def j1_trips(spark, sf):
    return _trip_out(_tables(spark, sf).trips)


def j1_trips_all_released(spark, sf):
    return _trip_out(_tables(spark, sf, close="all").trips)


def j1_repeated_events(spark, sf):
    """Four source events share a trip id, so that their pickups and dropoffs repeat and interleave (J1.5)."""
    trips = fixtures.trip_fixture(fixtures.load_table(spark, sf, "events")).withColumn(
        "trip_id", F.floor(F.col("event_id") / 4).cast("string"))
    pickups = trips.where("has_pickup").select(
        "trip_id", F.col("pickup_datetime").alias("event_time"), "pickup_zone", F.col("passenger_count").cast("double").alias("passenger_count"))
    dropoffs = trips.where("has_dropoff").select(
        "trip_id", F.col("dropoff_datetime").alias("event_time"), "dropoff_zone", "trip_distance", "total_amount")
    return _trip_out(T_.join_trips(pickups, dropoffs, R, close="all"))


def j2_orphans(spark, sf):
    return _trip_out(T_.orphans(_tables(spark, sf).trips))


def j3_duration_rule(spark, sf):
    t = _tables(spark, sf).trips.where(F.col("duration_seconds").isNotNull())
    return t.select("trip_id", "duration_seconds", "is_valid", "invalid_reason")


def v10_valid_trips(spark, sf):
    return _trip_out(_tables(spark, sf).valid)


def v10_invalid_trips(spark, sf):
    return _trip_out(_tables(spark, sf).invalid)


def j4_enriched_trips(spark, sf):
    e = _tables(spark, sf).enriched
    return e.select("trip_id", to_ntz(F.col("dropoff_datetime")).alias("dropoff_datetime"),
                    "dropoff_zone", "dropoff_borough", "time_of_day")


# ------------------------------------------------------------------ metrics

def a0_daily_borough_stats(spark, sf):
    return M.stats_as_doubles(_tables(spark, sf).stats("borough"))


def _metric_query(name: str) -> Query:
    def q(spark, sf):
        return _tables(spark, sf).metric(name)
    q.__name__ = name
    return q


METRIC_IDS = {
    "a1_trip_count_by_borough": "trip_count_by_borough",
    "a2_avg_passengers_by_borough": "avg_passengers_by_borough",
    "a3_avg_distance_by_borough": "avg_distance_by_borough",
    "a4_trip_count_by_time_of_day": "trip_count_by_time_of_day",
    "a5_avg_passengers_by_time_of_day": "avg_passengers_by_time_of_day",
    "a6_avg_distance_by_time_of_day": "avg_distance_by_time_of_day",
    "a7_trips_per_week": "trips_per_week",
    "a8_revenue_by_week": "revenue_by_week",
    "a9_revenue_per_mile_by_week": "revenue_per_mile_by_week",
    "a10_avg_price_last_h": "avg_price_last_h",
    "a11_revenue_last_h": "revenue_last_h",
    "a12_trips_last_h": "trips_last_h",
}


def g1_open_trips(spark, sf):
    return _tables(spark, sf).open_trips()


def a0b_aggregates(spark, sf):
    return _tables(spark, sf).aggregates()


def f5_time_of_day(spark, sf):
    ev = fixtures.load_table(spark, sf, "events")
    return ev.select("event_id", time_of_day(F.col("ts")).alias("time_of_day"))


def f6_iso_week(spark, sf):
    li = fixtures.load_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", iso_week_label(F.col("l_shipdate")).alias("iso_week"))


# ------------------------------------------------------------------ sinks

def ks1_rejected_dedupe(spark, sf):
    return writers.dedupe_rejected(_parsed(spark, sf).rejected)


def ks2_invalid_first(spark, sf):
    inv = writers.first_invalid(_tables(spark, sf).trips)
    return inv.select(
        "trip_id", "pickup_zone", "dropoff_zone",
        to_ntz(F.col("pickup_datetime")).alias("pickup_datetime"),
        to_ntz(F.col("dropoff_datetime")).alias("dropoff_datetime"),
        "duration_seconds", "trip_distance", "passenger_count", "total_amount", "invalid_reason")


def ks3_metrics_upsert(spark, sf):
    """The finite run's metrics in a table, then half of the boroughs' and all last windows upserted with changed values.

    Of the second run (every window closed) only metrics by borough and of the
    last hour come again, each value one larger: other rows stay, some change,
    and windows that the first run left open are new.
    """
    first = _tables(spark, sf).metrics()
    again = _tables(spark, sf, close="all").metrics().where(
        F.col("metric_name").endswith("_by_borough") | F.col("metric_name").endswith("_last_h")
    ).withColumn("value", F.col("value") + F.lit(1.0))
    path = _scratch(spark, "ks3")
    writers.upsert_partitions(first, path, partition_by=("metric_name",))
    writers.upsert_partitions(again, path, partition_by=("metric_name",))
    return spark.read.parquet(path).select(*first.columns)


def ks5_guarded_load(spark, sf):
    """The cleaning job's table and summary, loaded from all raw trips; a second load is refused (K-S5, A14, V4)."""
    table = _scratch(spark, "raw-trips")
    raw, zones = fixtures.raw_trip_fixture(spark, sf), fixtures.cleaning_zone_fixture(spark, sf)
    summary = batch.run_cleaning_job(raw, zones, table, R)
    refused = batch.run_cleaning_job(raw, zones, table, R) is None
    stored = spark.read.parquet(table).agg(F.count("*").alias("stored"), F.sum("passenger_count").alias("passengers"))
    return summary.select("status", "reason", "rows", stored.select("stored").scalar().alias("stored"),
                          stored.select("passengers").scalar().alias("passengers"), F.lit(refused).alias("refused"))


def ks8_published_topics(spark, sf):
    """Both topics of the raw trips' event log as published; a second run is refused (K-S8, K-S9)."""
    path = _scratch(spark, "topics")
    raw = cleaning.accepted_trips(_cleaned(spark, sf))
    sent = batch.run_publish_job(raw, path, R)
    again = batch.run_publish_job(raw, path, R)
    log = spark.read.parquet(path)
    # the ids are SHA-256 in hex: half as many bytes name as many trips
    return log.groupBy("topic").agg(F.count("*").alias("records"), F.count_distinct(F.unhex("key")).alias("trips"),
                                    to_ntz(F.min("event_time")).alias("first_time"), to_ntz(F.max("event_time")).alias("last_time")
                                    ).withColumns({"sent": F.lit(sent), "sent_again": F.lit(again)})


# ------------------------------------------------------------------ reports

def r1_trips_per_borough(spark, sf):
    return reports.trips_per_borough(_tables(spark, sf).metric("trip_count_by_borough"))


def r2_invalid_by_reason(spark, sf):
    return reports.invalid_by_reason(writers.first_invalid(_tables(spark, sf).trips))


def r3_rejected_listing(spark, sf):
    return reports.rejected_listing(writers.dedupe_rejected(_parsed(spark, sf).rejected))


def r4_progress(spark, sf):
    return reports.progress(_tables(spark, sf).metric("trips_last_h"))


def r5_reconciliation(spark, sf):
    t = _tables(spark, sf)
    return reports.reconciliation(t.metric("trip_count_by_borough"), t.valid, writers.first_invalid(t.trips), t.bound)


def r5_raw_reconciliation(spark, sf):
    """The job over the undamaged event log of all acceptable trips, against those trips."""
    raw = fixtures.trip_fixture(fixtures.load_table(spark, sf, "events")).where(
        (F.col("passenger_count") <= R.max_passengers) & (F.col("total_amount") > 0))
    log = eventlog.trip_events(raw, R)
    sides = [log.where(F.col("topic") == t).select("key", "value") for t in (R.pickup_topic, R.dropoff_topic)]
    t = batch.build(*sides, fixtures.zone_fixture(spark, sf), R, materialize=True)
    return reports.raw_reconciliation(t.metric("trip_count_by_borough"), writers.first_invalid(t.trips), raw, t.bound)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "s1_zone_scan": s1_zone_scan,
        "s2_raw_trips": s2_raw_trips,
        "s3_date_slices": s3_date_slices,
        "s3_named_slices": s3_named_slices,
        "s3_table_slices": s3_table_slices,
        "s4_ordered_trips": s4_ordered_trips,
        "s7_valid_zone_ids": s7_valid_zone_ids,
        "v1_clean_reasons": v1_clean_reasons,
        "v2_coerced_times": v2_coerced_times,
        "v3_raw_trips": v3_raw_trips,
        "v4_load_summary": v4_load_summary,
        "j5_zone_semi": j5_zone_semi,
        "j5_zone_anti": j5_zone_anti,
        "o2_event_log": o2_event_log,
        "o2_replay_positions": o2_replay_positions,
        "o3_trip_ids": o3_trip_ids,
        "v6_pickup_reasons": v6_pickup_reasons,
        "v6_dropoff_reasons": v6_dropoff_reasons,
        "v6_reason_counts": v6_reason_counts,
        "v8_valid_pickups": v8_valid_pickups,
        "v8_valid_dropoffs": v8_valid_dropoffs,
        "u1_rejected_union": u1_rejected_union,
        "t13_lifecycle": t13_lifecycle,
        "j1_trips": j1_trips,
        "j1_trips_all_released": j1_trips_all_released,
        "j1_repeated_events": j1_repeated_events,
        "j2_orphans": j2_orphans,
        "j3_duration_rule": j3_duration_rule,
        "v10_valid_trips": v10_valid_trips,
        "v10_invalid_trips": v10_invalid_trips,
        "j4_enriched_trips": j4_enriched_trips,
        "a0_daily_borough_stats": a0_daily_borough_stats,
    }
    for qid, name in METRIC_IDS.items():
        out[qid] = _metric_query(name)
    out.update({
        "g1_open_trips": g1_open_trips,
        "a0b_aggregates": a0b_aggregates,
        "f5_time_of_day": f5_time_of_day,
        "f6_iso_week": f6_iso_week,
        "ks1_rejected_dedupe": ks1_rejected_dedupe,
        "ks2_invalid_first": ks2_invalid_first,
        "ks3_metrics_upsert": ks3_metrics_upsert,
        "ks5_guarded_load": ks5_guarded_load,
        "ks6_zones_refresh": ks6_zones_refresh,
        "ks8_published_topics": ks8_published_topics,
        "r1_trips_per_borough": r1_trips_per_borough,
        "r2_invalid_by_reason": r2_invalid_by_reason,
        "r3_rejected_listing": r3_rejected_listing,
        "r4_progress": r4_progress,
        "r5_reconciliation": r5_reconciliation,
        "r5_raw_reconciliation": r5_raw_reconciliation,
    })
    return {name: _with_settings(fn) for name, fn in out.items()}


def _with_settings(fn: Query) -> Query:
    """Pin the settings results depend on (UTC, duplicate JSON keys) on any session."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        apply_session_settings(spark)
        return fn(spark, sf)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run

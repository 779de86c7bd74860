"""Reports (R1, R4, R5) on hand-made tables; topic publish and read-back (K-S8, S5)."""

import json
import os
import tempfile
from datetime import datetime

import pytest
from conftest import event
from pyspark.sql import functions as F

from tripcast.operators import eventlog, validation as V
from tripcast.plans import batch, reports
from tripcast.sinks import writers
from tripcast.sources.events import TopicSource, read_topic

AGG = "metric_name string, window_start timestamp_ntz, window_end timestamp_ntz, dimension string, value double"


def aggregates(spark):
    d1, d2, d3 = datetime(2023, 5, 17), datetime(2023, 5, 18), datetime(2023, 5, 19)
    return spark.createDataFrame([
        ("trip_count_by_borough", d1, d2, "North", 3.0),
        ("trip_count_by_borough", d1, d2, "South", 7.0),
        ("trip_count_by_borough", d2, d3, "North", 1.0),
        ("trips_last_h", d1, datetime(2023, 5, 17, 1), "all", 2.0),
        ("trips_last_h", datetime(2023, 5, 17, 0, 5), datetime(2023, 5, 17, 1, 5), "all", 2.0),
    ], AGG)


def test_trips_per_borough_one_day_largest_first(spark):
    rows = reports.trips_per_borough(aggregates(spark), day="2023-05-17").collect()
    assert [(r.dimension, r.value) for r in rows] == [("South", 7.0), ("North", 3.0)]


def test_progress(spark):
    r = reports.progress(aggregates(spark)).first()
    assert r.windows == 2 and r.last_window_end == datetime(2023, 5, 17, 1, 5)


def test_reconciliation_flags_consistency(spark):
    valid = spark.createDataFrame([(datetime(2023, 5, 17, 10),)] * 10 + [(datetime(2023, 5, 18, 9),)],
                                  "event_time timestamp")
    invalid = spark.createDataFrame([("x",)], "trip_id string")
    r = reports.reconciliation(aggregates(spark), valid, invalid).first()
    assert (r.daily_total, r.valid_trips, r.invalid_trips, r.consistent) == (11.0, 11, 1, True)


def test_publish_then_read_topic(spark):
    base = tempfile.mkdtemp(prefix="tripcast-topic-")
    recs = spark.createDataFrame([("r-810", json.dumps(event("pickup"))), ("t2", json.dumps(event("pickup", trip_id="t2")))],
                                 "key string, value string")
    writers.publish_topic(recs, "pickup_events", fallback_path=os.path.join(base, "log"))
    log = spark.read.parquet(os.path.join(base, "log"))
    assert not writers.publish_topic(recs, "pickup_events", fallback_path=os.path.join(base, "log"))  # filled (K-S9)
    assert writers.publish_topic(recs.limit(0), "dropoff_events", fallback_path=os.path.join(base, "log"))
    assert sorted(r.key for r in log.collect()) == ["r-810", "t2"]
    # the same payloads as a text topic (one JSON document per line)
    folder = os.path.join(base, "text")
    os.makedirs(folder)
    with open(os.path.join(folder, "part-0.txt"), "w") as fh:
        for r in log.orderBy("key").collect():
            fh.write(r.value + "\n")
    parsed = V.parse_events(read_topic(spark, TopicSource("pickup_events", format="text", path=folder)), "pickup")
    assert sorted(r.trip_id for r in V.pickups(parsed).collect()) == ["r-810", "t2"]


def test_raw_reconciliation_notices_a_lost_trip(spark):
    at = lambda d, h, m=0: datetime(2023, 5, d, h, m)
    raw = [(at(17, 6), at(17, 6, 30)), (at(17, 7), at(17, 10)), (at(17, 8), at(17, 8)), (at(17, 8), at(17, 11, 1)), (at(10, 1), at(14, 2)),
           (at(17, 23, 50), at(18, 0, 20)), (at(19, 4), at(19, 5))]
    rows = [(f"t{i}", p, d, 1, 2, 1, 1.0, 5.0) for i, (p, d) in enumerate(raw)]
    trips = spark.createDataFrame(rows, "trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_zone int, dropoff_zone int, "
                                        "passenger_count int, trip_distance double, total_amount double")
    zones = spark.createDataFrame([(2, "North", "z", "y")], "location_id int, borough string, zone string, service_zone string")

    def reconciled(sent):
        log = eventlog.trip_events(sent)
        t = batch.build(*(log.where(F.col("topic") == x).select("key", "value") for x in ("pickup_events", "dropoff_events")), zones)
        return reports.raw_reconciliation(t.metric("trip_count_by_borough"), writers.first_invalid(t.trips), trips, t.bound).first()

    r = reconciled(trips)
    assert (r.daily_total, r.raw_valid, r.invalid_total, r.raw_invalid, r.consistent) == (3.0, 3, 3, 3, True)
    for lost in ("t0", "t2", "t4", "t5"):
        r = reconciled(trips.where(F.col("trip_id") != lost))
        assert (r.raw_valid, r.raw_invalid, r.consistent) == (3, 3, False), lost


def test_replay_positions_are_gapless_and_in_order(spark):
    ev = spark.range(5000).select(F.lit("x").alias("topic"), F.col("id").cast("string").alias("key"),
                                  F.timestamp_seconds(F.col("id") * 7919 % 600).alias("event_time"), (F.col("id") % 2).cast("int").alias("kind_rank"))
    got = eventlog.replay_positions(ev).orderBy("sequence").collect()
    assert [r.sequence for r in got] == list(range(5000))
    keys = [(r.event_time, r.kind_rank, r.key) for r in got]
    assert keys == sorted(keys)
    assert eventlog.replay_positions(ev.limit(0)).collect() == []


def test_zones_refresh_replaces_all_or_nothing(spark, tmp_path):
    table, csv = str(tmp_path / "zones"), tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n7,East,Harbour,Boats\n8,East,Mill,Boats\n")
    ids = lambda: sorted(r.location_id for r in writers.read_current(spark, table).collect())
    with pytest.raises(ValueError, match="no version"):
        writers.read_current(spark, table)
    batch.run_zones_job(spark, str(csv), table)
    assert ids() == [7, 8]
    with pytest.raises(Exception, match="broken"):
        writers.replace_rows(spark.range(9).select(F.raise_error(F.lit("broken")).cast("int").alias("location_id")), table)
    assert ids() == [7, 8]
    for k in (9, 10, 11):
        csv.write_text(f"LocationID,Borough,Zone,service_zone\n{k},East,Harbour,Boats\n")
        batch.run_zones_job(spark, str(csv), table)
    assert ids() == [11] and sorted(f for f in os.listdir(table) if f[0] != "_") == ["version=3", "version=4"]

"""Cleaning rules (V1-V4), the gauge (G1) and idempotent sinks (K-S1..K-S6)."""

import os
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripcast.config import checkpoint_dir
from tripcast.operators import cleaning, gauge
from tripcast.operators.trips import pair_sides
from tripcast.sinks import writers
from tripcast.sources.zones import read_zones_csv

RAW = ("pickup_datetime string, dropoff_datetime string, passenger_count double, trip_distance double, "
       "total_amount double, pickup_location_id double, dropoff_location_id double")


# a raw row that passes every rule, by column
GOOD = {"pickup_datetime": "2023-05-17 06:40:00", "dropoff_datetime": "2023-05-17 07:05:30", "passenger_count": 3.0,
        "trip_distance": 7.75, "total_amount": 31.4, "pickup_location_id": 19.0, "dropoff_location_id": 23.0}


def values(**changes):
    return tuple((GOOD | changes).values())


def zones(spark, ids=(19, 23)):
    return spark.createDataFrame([(i, "B", "Z", "S") for i in ids],
                                 "location_id int, borough string, zone string, service_zone string")


def reason(spark, **changes):
    df = spark.createDataFrame([values(**changes)], RAW)
    return cleaning.clean_trips(df, zones(spark)).first()["reason"]


@pytest.mark.parametrize("changes,expected", [
    ({}, None),
    ({"dropoff_datetime": "2023-05-17 06:39:59"}, "time_order"),
    ({"total_amount": 0.0}, "price"),
    ({"pickup_location_id": 77.0}, "invalid_zones"),
    ({"dropoff_location_id": 23.6}, None),  # truncated to 23
    ({"trip_distance": float("nan")}, "missing_values"),
    ({"passenger_count": None}, "missing_values"),
    ({"pickup_datetime": "17th of May"}, "missing_values"),
    ({"trip_distance": 0.0}, "distance"),
    ({"passenger_count": 9.0}, "passengers"),
    ({"passenger_count": 0.0, "total_amount": -0.5}, "price"),  # first failing rule wins
])
def test_cleaning_rules(spark, changes, expected):
    assert reason(spark, **changes) == expected


def test_load_summary_and_projection(spark):
    rows = [values(), values(total_amount=0.0),
            values(passenger_count=5.6)]
    cleaned = cleaning.clean_trips(spark.createDataFrame(rows, RAW), zones(spark))
    summary = {(r.status, r.reason): r.rows for r in cleaning.load_summary(cleaned).collect()}
    assert summary == {("processed", None): 3, ("inserted", None): 2, ("rejected", None): 1, ("rejected", "price"): 1}
    acc = cleaning.accepted_trips(cleaned).collect()
    assert sorted(r.passenger_count for r in acc) == [3, 5]


def test_zone_csv_keeps_na_text(spark, tmp_path):
    p = tmp_path / "zones.csv"
    p.write_text('LocationID,Borough,Zone,service_zone\n7,"East","Harbour, old","Boats"\n'
                 '81,"Nowhere","N/A","N/A"\n82,"N/A","","Trams"\n')
    z = {r.location_id: r for r in read_zones_csv(spark, str(p)).collect()}
    assert z[82].borough == "N/A" and z[82].zone == "" and z[81].zone == "N/A" and z[7].zone == "Harbour, old"


PICKUP = "trip_id string, event_time timestamp, pickup_zone int, passenger_count double"
DROPOFF = "trip_id string, event_time timestamp, dropoff_zone int, trip_distance double, total_amount double"
SPAN = timedelta(hours=3)


def gauge_of(spark, pickups, dropoffs, bound=None):
    pk = spark.createDataFrame([(i, t, 1, 1.0) for i, t in pickups], PICKUP)
    dk = spark.createDataFrame([(i, t, 1, 1.0, 1.0) for i, t in dropoffs], DROPOFF)
    bound = None if bound is None else F.lit(bound).cast("timestamp")
    return {r.window_end: r.value for r in gauge.open_trips(pair_sides(pk, dk), bound=bound).collect()}


def ticks_of(pairs, bound):
    """Ticks before bound with a pickup in their window, and their open trips; pairs of pickup and end (or None)."""
    found = {}
    for p, _ in pairs:
        t = p.replace(second=0, microsecond=0)
        t += timedelta(minutes=t < p)
        while t <= p + SPAN and (bound is None or t < bound):
            found[t] = float(sum(q <= t <= q + SPAN and (e is None or e > t or e < q - SPAN) for q, e in pairs))
            t += timedelta(minutes=1)
    return found


def test_gauge_matches_brute_force(spark):
    base = datetime(2023, 5, 17, 20, 30)  # goes on over midnight, where a block ends
    pairs = []
    for i in range(60):
        p = base + timedelta(minutes=7 * i, seconds=(i * 13) % 60)
        pairs.append((p, None if i % 9 == 0 else p + timedelta(minutes=(i * 37) % 300 - 20)))
    pairs += [(datetime(2023, 5, 17, 23, 0), datetime(2023, 5, 18)), (datetime(2023, 5, 17, 21, 0), None), (datetime(2023, 5, 18), None),
              (datetime(2023, 5, 18, 1, 0), datetime(2023, 5, 17, 21, 30)), (datetime(2023, 5, 17, 20, 59, 59), None)]
    pickups = [(f"t{i}", p) for i, (p, _) in enumerate(pairs)]
    dropoffs = [(f"t{i}", d) for i, (_, d) in enumerate(pairs) if d]
    for bound in (None, datetime(2023, 5, 18, 1, 0, 30), datetime(2023, 5, 18, 0, 0)):
        assert gauge_of(spark, pickups, dropoffs, bound) == ticks_of(pairs, bound)


def test_gauge_rows_follow_the_pickups_not_the_years_between(spark):
    days = [datetime(1999, 12, 31, 23, 59, 1), datetime(2023, 5, 17, 6, 40), datetime(2051, 1, 1)]
    got = gauge_of(spark, [(str(d), d) for d in days], [])
    assert got == ticks_of([(d, None) for d in days], None) and len(got) < 1000


def test_gauge_of_repeated_events(spark):
    at = [datetime(2023, 5, 17, 6, m) for m in (0, 10, 25, 40, 50)]
    # a second pickup takes the place of the first, a second dropoff closes nothing
    got = gauge_of(spark, [("a", at[0]), ("a", at[1]), ("a", at[4])], [("a", at[2]), ("a", at[3])])
    # the pickup at 6:50 meets the dropoff that waits since 6:40, so it is never open
    want = ticks_of([(at[0], at[1]), (at[1], at[2]), (at[4], at[3])], None)
    assert got == want


def test_nothing_makes_no_tick(spark):
    assert gauge_of(spark, [], [("a", datetime(2023, 5, 17))]) == {}


def _fresh(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def test_rejected_insert_ignore_is_idempotent(spark):
    path = _fresh(spark, "rejected")
    rej = spark.createDataFrame([("pickup_events", "invalid_json", "{x"), ("pickup_events", "invalid_json", "{x"),
                                 ("dropoff_events", "invalid_json", "{x")], "topic string, reason string, raw_payload string")
    batch = writers.dedupe_rejected(rej)
    for _ in range(2):  # replay
        writers.append_new(batch, path, ["topic", "payload_md5"])
    assert spark.read.parquet(path).count() == 2


def test_metric_upsert_last_wins_and_idempotent(spark):
    path = _fresh(spark, "aggregates")
    schema = "metric_name string, window_start timestamp_ntz, window_end timestamp_ntz, dimension string, value double"
    t0, t1 = datetime(2023, 5, 17), datetime(2023, 5, 18)
    first = spark.createDataFrame([("m", t0, t1, "a", 1.0), ("m", t1, datetime(2023, 5, 19), "a", 5.0)], schema)
    second = spark.createDataFrame([("m", t0, t1, "a", 2.0), ("m", t0, t1, "b", 3.0)], schema)
    writers.upsert_partitions(first, path)
    writers.upsert_partitions(second, path)
    writers.upsert_partitions(second, path)
    got = {(r.window_start, r.dimension): r.value for r in spark.read.parquet(path).collect()}
    assert got == {(t0, "a"): 2.0, (t0, "b"): 3.0, (t1, "a"): 5.0}


def test_guarded_append_refuses_non_empty(spark):
    path = _fresh(spark, "raw_trips")
    df = spark.range(3)
    assert writers.append_if_empty(df, path) is True
    assert writers.append_if_empty(df, path) is False
    assert spark.read.parquet(path).count() == 3


def test_epoch_write_skips_committed_replay(spark):
    path = _fresh(spark, "trips")
    df = spark.range(5)
    assert writers.write_epoch(df, path, 0) is True
    assert writers.write_epoch(df, path, 0) is False  # replay of a committed epoch
    assert writers.write_epoch(spark.range(2), path, 1) is True
    assert spark.read.parquet(path).count() == 7


def test_epoch_write_that_fails_before_its_commit_leaves_no_rows(spark):
    path = _fresh(spark, "epochs")
    assert writers.write_epoch(spark.range(5), path, 0)
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("long").alias("id")).repartition(4)
    with pytest.raises(Exception, match="lost"):
        writers.write_epoch(broken, path, 1)
    # files that were written whole, but never moved into place
    spark.range(100).write.parquet(os.path.join(path, "_staging", "1-of-a-lost-driver"))
    assert spark.read.parquet(path).count() == 5
    assert writers.write_epoch(spark.range(4), path, 1) and spark.read.parquet(path).count() == 9

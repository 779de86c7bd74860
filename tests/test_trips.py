"""Trip join (J1-J3), orphans, duplicates, enrichment (J4) and sinks K-S2."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import event, records
from tripcast.operators import enrich, trips as T, validation as V
from tripcast.sinks import writers


def sides(spark, pickups, dropoffs):
    p = V.pickups(V.parse_events(records(spark, pickups), "pickup"))
    d = V.dropoffs(V.parse_events(records(spark, dropoffs), "dropoff"))
    return p, d


def run(spark, pickups, dropoffs, close="all"):
    p, d = sides(spark, pickups, dropoffs)
    return {(r.trip_id, r.invalid_reason): r for r in T.join_trips(p, d, close=close).collect()}


def test_three_hours_exactly_is_valid(spark):
    out = run(spark, [event("pickup", pickup_datetime="2023-05-17T05:10:20")],
              [event("dropoff", dropoff_datetime="2023-05-17T08:10:20")])
    trip = out[("r-810", None)]
    assert trip.is_valid and trip.duration_seconds == 10800.0


def test_one_second_over_three_hours(spark):
    out = run(spark, [event("pickup", pickup_datetime="2023-05-17T05:10:20")],
              [event("dropoff", dropoff_datetime="2023-05-17T08:10:21")])
    assert list(out) == [("r-810", "duration_over_3h")]


def test_zero_duration(spark):
    out = run(spark, [event("pickup", pickup_datetime="2023-05-17T09:00:00")],
              [event("dropoff", dropoff_datetime="2023-05-17T09:00:00")])
    assert list(out) == [("r-810", "non_positive_duration")]


def test_dropoff_before_pickup_is_matched_and_non_positive(spark):
    out = run(spark, [event("pickup", pickup_datetime="2023-05-17T10:00:00")],
              [event("dropoff", dropoff_datetime="2023-05-17T09:00:00")])
    trip = out[("r-810", "non_positive_duration")]
    assert trip.duration_seconds == -3600.0
    assert trip.event_time == datetime(2023, 5, 17, 9, 0)  # trips are windowed by dropoff time


def test_orphans_both_sides(spark):
    out = run(spark, [event("pickup", trip_id="p_only")], [event("dropoff", trip_id="d_only")])
    assert set(out) == {("p_only", "missing_dropoff"), ("d_only", "missing_pickup")}
    assert out[("p_only", "missing_dropoff")].event_time == datetime(2023, 5, 19, 6, 40)


def test_exactly_48h_matches_beyond_splits(spark):
    out = run(spark, [event("pickup", trip_id="a", pickup_datetime="2023-05-17T10:00:00"),
                      event("pickup", trip_id="b", pickup_datetime="2023-05-17T10:00:00")],
              [event("dropoff", trip_id="a", dropoff_datetime="2023-05-19T10:00:00"),
               event("dropoff", trip_id="b", dropoff_datetime="2023-05-19T10:00:01")])
    assert ("a", "duration_over_3h") in out
    assert ("b", "missing_dropoff") in out and ("b", "missing_pickup") in out


def plain_pairs(events, limit=48 * 3600):
    """The pairing rule event by event: (pickup, dropoff) with None for a missing side; events are (seconds, side, value)."""
    out, held = [], None
    for e in sorted(events):
        if held is None:
            held = e
        elif e[0] - held[0] > limit:
            out.append((held, None) if held[1] == 0 else (None, held))
            held = e
        elif e[1] != held[1]:
            out.append((held, e) if held[1] == 0 else (e, held))
            held = None
        else:
            held = e
    if held:
        out.append((held, None) if held[1] == 0 else (None, held))
    return out


def typed(spark, events):
    """Typed sides of (trip_id, seconds, side, value)."""
    p = spark.createDataFrame([(i, t, v) for i, t, s, v in events if s == 0], "trip_id string, s long, pickup_zone int").select(
        "trip_id", F.timestamp_seconds("s").alias("event_time"), "pickup_zone", F.lit(1.0).alias("passenger_count"))
    d = spark.createDataFrame([(i, t, v) for i, t, s, v in events if s == 1], "trip_id string, s long, dropoff_zone int").select(
        "trip_id", F.timestamp_seconds("s").alias("event_time"), "dropoff_zone", F.lit(1.0).alias("trip_distance"), F.lit(5.0).alias("total_amount"))
    return p, d


def joined(spark, events):
    return sorted((r.trip_id, r.pickup_zone, r.dropoff_zone) for r in T.join_trips(*typed(spark, events), close="all").select(
        "trip_id", F.coalesce("pickup_zone", F.lit(-1)).alias("pickup_zone"), F.coalesce("dropoff_zone", F.lit(-1)).alias("dropoff_zone")).collect())


def wanted(events):
    ids = {i for i, *_ in events}
    return sorted((i, p[2] if p else -1, d[2] if d else -1) for i in ids for p, d in plain_pairs([e[1:] for e in events if e[0] == i]))


@pytest.mark.parametrize("order", ["PPD", "PDP", "PDD", "DPD", "DDP", "PDPD", "PPDD", "DPDP", "PDDP", "PPP", "DDD"])
def test_repeated_events_before_and_after_a_match(spark, order):
    events = [("a", 1_684_300_000 + 600 * k, int(c == "D"), k) for k, c in enumerate(order)]
    assert joined(spark, events) == wanted(events)


def test_repeated_events_at_random(spark, monkeypatch):
    """Many events of an id, in blocks of time that runs cross, with ties and gaps beyond 48 h."""
    from tripcast.operators import pairing

    rng = random.Random(8)
    for block in (3600, 100_000):
        monkeypatch.setattr(pairing, "BLOCK_SECONDS", block)
        events, n = [], 0
        for i in range(60):
            t = 1_684_300_000
            for _ in range(rng.randrange(1, 30)):
                t += rng.choice([0, 60, 600, 3600, 40_000, 172_800, 172_801, 400_000])
                n += 1
                events.append((f"t{i}", t, rng.randrange(2), n))
        assert joined(spark, events) == wanted(events)


def test_watermark_release_of_orphans(spark):
    # bound = least(max pickup, max dropoff) - 30 s = 2023-05-21 10:00:00 - 30 s
    pickups = [event("pickup", trip_id="old", pickup_datetime="2023-05-17T10:00:00"),
               event("pickup", trip_id="late", pickup_datetime="2023-05-20T10:00:00"),
               event("pickup", trip_id="last", pickup_datetime="2023-05-21T10:00:00")]
    dropoffs = [event("dropoff", trip_id="last", dropoff_datetime="2023-05-21T10:10:00")]
    out = run(spark, pickups, dropoffs, close="watermark")
    assert ("old", "missing_dropoff") in out       # timer 05-19 10:00 < bound
    assert ("late", "missing_dropoff") not in out  # timer 05-22 10:00 not reached
    assert ("last", None) in out


def test_enrichment_unknown_zone_and_time_of_day(spark):
    p, d = sides(spark, [event("pickup"), event("pickup", trip_id="t2")],
                 [event("dropoff"), event("dropoff", trip_id="t2", dropoff_zone=99)])
    zones = spark.createDataFrame([(19, "North", "A", "x"), (23, "South", "B", "y")],
                                  "location_id int, borough string, zone string, service_zone string")
    e = {r.trip_id: r for r in enrich.enrich_trips(T.valid_trips(T.join_trips(p, d, close="all")), zones).collect()}
    assert e["r-810"].dropoff_borough == "South" and e["r-810"].time_of_day == "morning"
    assert e["t2"].dropoff_borough == "Unknown"


def test_invalid_trips_keep_first_emitted(spark):
    # dropoff 72 h after pickup: missing_dropoff (emitted at p+48h) precedes missing_pickup (d+48h)
    p, d = sides(spark, [event("pickup", pickup_datetime="2023-05-17T10:00:00")],
                 [event("dropoff", dropoff_datetime="2023-05-20T10:00:00")])
    rows = writers.first_invalid(T.join_trips(p, d, close="all")).collect()
    assert [(r.trip_id, r.invalid_reason) for r in rows] == [("r-810", "missing_dropoff")]


@pytest.mark.parametrize("n_dupes", [1, 50])
def test_hot_trip_id_is_one_trip(spark, n_dupes):
    pickups = [event("pickup", trip_id="", pickup_datetime=f"2023-05-17T10:{i % 60:02d}:00") for i in range(n_dupes)]
    out = run(spark, pickups, [event("dropoff", trip_id="", dropoff_datetime="2023-05-17T11:30:00")])
    assert len(out) == 1


def test_hot_trip_id_third_of_all_events(spark):
    """One trip id holding a third of 60,000 events, a pickup and its dropoff in turn: every pair is found."""
    n = 60_000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("trip_id"),
        (F.lit(1_684_300_000) + 60 * F.col("id")).cast("timestamp").alias("event_time"),
    )
    p = ev.select("trip_id", "event_time", F.lit(1).alias("pickup_zone"), F.lit(1.0).alias("passenger_count"))
    d = ev.select("trip_id", (F.col("event_time") + F.expr("INTERVAL 90 SECONDS")).alias("event_time"),
                  F.lit(2).alias("dropoff_zone"), F.lit(1.0).alias("trip_distance"), F.lit(5.0).alias("total_amount"))
    trips = T.join_trips(p, d, close="all")
    assert trips.groupBy("trip_id").count().where("trip_id <> '' and count > 1").isEmpty()
    got = trips.groupBy("duration_seconds").count().collect()
    assert [(r.duration_seconds, r["count"]) for r in got] == [(90.0, n)]

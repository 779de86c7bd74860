"""Event validation rules (V5-V7): one case per reason, in rule order."""

import json

import pytest

from conftest import event, records
from tripcast.operators import validation as V


def reason_of(spark, payload, event_type):
    parsed = V.parse_events(records(spark, [payload]), event_type)
    return parsed.select("reason").first()["reason"]


PICKUP_CASES = [
    (event("pickup"), None),
    (event("pickup", passenger_count=9), "invalid_passenger_count"),
    (event("pickup", event_type="ride"), "unexpected_event_type"),
    (event("dropoff"), "unexpected_event_type"),  # dropoff on the pickup topic
    ("{not json", "invalid_json"),
    (json.dumps(event("pickup")) + " x", "invalid_json"),
    ('{"trip_id": "r-810", "passenger_count": NaN}', "invalid_json"),
    ("[1]", "not_a_json_object"),
    ("null", "not_a_json_object"),
    ("5", "not_a_json_object"),
    (event("pickup", trip_id=None), "missing_trip_id"),
    ({k: v for k, v in event("pickup").items() if k != "pickup_zone"}, "missing_pickup_zone"),
    ({k: v for k, v in event("pickup").items() if k != "passenger_count"}, "missing_passenger_count"),
    (event("pickup", pickup_datetime=None), "missing_pickup_datetime"),
    (event("pickup", pickup_datetime="yesterday"), "invalid_timestamp"),
    (event("pickup", pickup_datetime="2023-13-17T10:00:00"), "invalid_timestamp"),
    (event("pickup", pickup_datetime=20230517), "invalid_timestamp"),
    (event("pickup", pickup_datetime="2023-05-17T10:00:00+01:00"), None),
    (event("pickup", pickup_datetime="2023-05-17 10:00:00.5"), None),
    (event("pickup", pickup_zone="5"), "invalid_zone"),
    (event("pickup", pickup_zone=5.0), "invalid_zone"),
    (event("pickup", pickup_zone=True), None),  # K1: bool counts as int
    (event("pickup", pickup_zone=2**40), "invalid_zone"),  # K8: beyond INT
    (event("pickup", passenger_count="3"), "invalid_passenger_count"),
    (event("pickup", passenger_count=True), "invalid_passenger_count"),
    (event("pickup", passenger_count=0), "invalid_passenger_count"),
    (event("pickup", passenger_count=1.5), None),
    (event("pickup", passenger_count=8), None),
    (event("pickup", trip_id=5), None),  # K7: any non-null id, kept as text
]

DROPOFF_CASES = [
    (event("dropoff"), None),
    (event("dropoff", trip_distance=-0.75), "invalid_trip_distance"),
    (event("dropoff", trip_distance=True), "invalid_trip_distance"),
    (event("dropoff", trip_distance=0), "invalid_trip_distance"),
    (event("dropoff", total_amount=0), "invalid_total_amount"),
    (event("dropoff", total_amount="31.4"), "invalid_total_amount"),
    (event("dropoff", dropoff_zone=5.0), "invalid_zone"),
    (event("dropoff", dropoff_zone=True), None),
    (event("pickup"), "unexpected_event_type"),
    ({k: v for k, v in event("dropoff").items() if k != "total_amount"}, "missing_total_amount"),
    (event("dropoff", trip_distance=None), "missing_trip_distance"),
]


@pytest.mark.parametrize("payload,expected", PICKUP_CASES)
def test_pickup_rules(spark, payload, expected):
    assert reason_of(spark, payload, "pickup") == expected


@pytest.mark.parametrize("payload,expected", DROPOFF_CASES)
def test_dropoff_rules(spark, payload, expected):
    assert reason_of(spark, payload, "dropoff") == expected


def test_duplicate_keys_last_wins(spark):
    raw = '{"trip_id":"r-810","event_type":"pickup","pickup_datetime":"2023-05-17T10:00:00",' \
          '"pickup_zone":1,"passenger_count":9,"passenger_count":3}'
    parsed = V.parse_events(records(spark, [raw]), "pickup")
    row = parsed.first()
    assert row["reason"] is None and row["passenger_count"] == 3.0


def test_invalid_json_becomes_rejected_record(spark):
    parsed = V.parse_events(records(spark, ["{not json"]), "pickup")
    rej = V.rejected_events(parsed).collect()
    assert [(r.topic, r.reason, r.raw_payload) for r in rej] == [("pickup_events", "invalid_json", "{not json")]
    assert V.valid_events(parsed).count() == 0


def test_valid_event_is_typed(spark):
    parsed = V.parse_events(records(spark, [event("pickup", pickup_datetime="2023-05-17T10:00:00Z")]), "pickup")
    row = V.pickups(parsed).first()
    assert row.trip_id == "r-810" and row.pickup_zone == 19 and row.passenger_count == 3.0
    assert str(row.event_time) == "2023-05-17 10:00:00"
    assert V.rejected_events(parsed).count() == 0


def test_lifecycle_one_signal_per_valid_event(spark):
    p = V.pickups(V.parse_events(records(spark, [event("pickup"), event("pickup", trip_id="t2")]), "pickup"))
    d = V.dropoffs(V.parse_events(records(spark, [event("dropoff"), "{bad"]), "dropoff"))
    sig = sorted((r.signal, r.trip_id) for r in V.lifecycle(p, d).collect())
    assert sig == [("dropoff", "r-810"), ("pickup", "r-810"), ("pickup", "t2")]


def test_parse_runs_once_per_payload(spark):
    """The valid split must not copy the JSON parse into a pushed-down filter."""
    parsed = V.parse_events(records(spark, [event("pickup")]), "pickup")
    plan = V.pickups(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(concat([") <= 3  # one strict parse (its sub-expressions appear 3 times)

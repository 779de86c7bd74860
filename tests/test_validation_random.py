"""Event validation on generated messages: a sound message with one known fault has that fault's reason."""

import json
import random

import pytest

from conftest import event, records
from tripcast.operators import validation as V

NOT_NUMBERS = ["7", True, [7], {"n": 7}]
NOT_TIMES = ["tomorrow", "2021-02-29T01:00:00", "2021-14-02", "03/05/2021", 20210503, False, "2021-05-03T25:00:00"]
NOT_ZONES = ["4", 4.5, [4], 2**31, -(2**31) - 1, 10**19]
# field -> reason and values that break it, by topic
FAULTS = {
    "pickup": {"pickup_datetime": ("invalid_timestamp", NOT_TIMES), "pickup_zone": ("invalid_zone", NOT_ZONES),
               "passenger_count": ("invalid_passenger_count", [0, -1, 9, 0.99, 8.5, *NOT_NUMBERS]),
               "event_type": ("unexpected_event_type", ["dropoff", "", 3, None])},
    "dropoff": {"dropoff_datetime": ("invalid_timestamp", NOT_TIMES), "dropoff_zone": ("invalid_zone", NOT_ZONES),
                "trip_distance": ("invalid_trip_distance", [0, -0.5, *NOT_NUMBERS]), "total_amount": ("invalid_total_amount", [0.0, -3, *NOT_NUMBERS]),
                "event_type": ("unexpected_event_type", ["pickup", "trip", 3, None])},
}
NOT_JSON = ["", "{", '{"a": }', "{} {}", "[1,", '{"a": 1} tail']
NOT_OBJECTS = ["[]", "3", '"text"', "null", "true"]


def sound(rng, topic):
    day = f"20{rng.randint(10, 30)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    time = day + rng.choice(["", "T07", " 07:15", "T07:15:30", "T07:15:30.25", "T07:15:30Z", "T07:15:30+02:00"])
    values = {"trip_id": f"r{rng.randint(0, 99)}", f"{topic}_datetime": time, f"{topic}_zone": rng.randint(-5, 300)}
    more = {"passenger_count": rng.choice([1, 8, 2.5])} if topic == "pickup" else {
        "trip_distance": rng.choice([1e-9, 0.004, 7, 1e13]), "total_amount": rng.choice([0.01, 12.345, 1e10, 5])}
    return event(topic, **values, **more)


@pytest.mark.parametrize("topic", ["pickup", "dropoff"])
def test_one_fault_gives_its_reason(spark, topic):
    rng = random.Random(len(topic))
    cases = [(json.dumps(sound(rng, topic)), None) for _ in range(150)]
    for field, (reason, values) in FAULTS[topic].items():
        cases += [(json.dumps(sound(rng, topic) | {field: v}), reason) for v in values for _ in range(3)]
    for field in event(topic):
        absent = sound(rng, topic)
        del absent[field]
        reason = "unexpected_event_type" if field == "event_type" else f"missing_{field}"
        cases.append((json.dumps(absent), reason))
        cases.append((json.dumps(sound(rng, topic) | {field: None}), reason))
    cases += [(t, "invalid_json") for t in NOT_JSON] + [(t, "not_a_json_object") for t in NOT_OBJECTS]
    got = {r.raw_payload: r.reason for r in V.parse_events(records(spark, [c for c, _ in cases]), topic).select("raw_payload", "reason").collect()}
    wrong = [(text, reason, got[text]) for text, reason in cases if got[text] != reason]
    assert not wrong, wrong[:10]

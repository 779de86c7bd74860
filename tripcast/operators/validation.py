"""Parse-or-dead-letter and event validation.

One projection parses the JSON text into a VARIANT once and derives the
first failing rule as ``reason``; valid and rejected rows are split from it
with a generator (see ``_split``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.functions import jsonfn as J
from tripcast.functions.timefn import parse_iso_timestamp

# Fixed field lists, in the order the missing_<field> rule checks them.
PICKUP_FIELDS = ("trip_id", "event_type", "pickup_datetime", "pickup_zone", "passenger_count")
DROPOFF_FIELDS = ("trip_id", "event_type", "dropoff_datetime", "dropoff_zone", "trip_distance", "total_amount")


def _reason(obj: Column, m: dict[str, Column], event_type: str, rules: Rules) -> Column:
    fields = PICKUP_FIELDS if event_type == "pickup" else DROPOFF_FIELDS
    r = F.when(obj.isNull(), F.lit("invalid_json"))
    r = r.when(~J.is_json_object(obj), F.lit("not_a_json_object"))
    r = r.when(F.coalesce(J.json_string(m["event_type"]) != F.lit(event_type), F.lit(True)),
               F.lit("unexpected_event_type"))
    for f in fields:
        r = r.when(J.is_missing(m[f]), F.lit(f"missing_{f}"))
    r = r.when(parse_iso_timestamp(J.json_string(m[f"{event_type}_datetime"])).isNull(),
               F.lit("invalid_timestamp"))
    r = r.when(~J.is_json_integer(m[f"{event_type}_zone"]), F.lit("invalid_zone"))
    if event_type == "pickup":
        pc = m["passenger_count"]
        r = r.when(~J.is_json_number(pc) | ~J.json_double(pc).between(1, rules.max_passengers),
                   F.lit("invalid_passenger_count"))
    else:
        d, a = m["trip_distance"], m["total_amount"]
        r = r.when(~J.is_json_number(d) | (J.json_double(d) <= 0), F.lit("invalid_trip_distance"))
        r = r.when(~J.is_json_number(a) | (J.json_double(a) <= 0), F.lit("invalid_total_amount"))
    return r  # NULL when every rule passes


def parse_events(records: DataFrame, event_type: str, topic: str | None = None,
                 rules: Rules = DEFAULT_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON records (``value``) -> topic, raw_payload, reason and typed event columns (V5, V6).

    Output: topic, raw_payload, reason, trip_id, event_time, and for pickups
    pickup_zone, passenger_count; for dropoffs dropoff_zone, trip_distance,
    total_amount. Typed columns are only meaningful where reason IS NULL.
    """
    if topic is None:
        topic = rules.pickup_topic if event_type == "pickup" else rules.dropoff_topic
    fields = PICKUP_FIELDS if event_type == "pickup" else DROPOFF_FIELDS
    parsed = records.select(*keep, F.col("value").alias("raw_payload"),
                            J.strict_parse_json(F.col("value")).alias("_obj"))
    obj = F.col("_obj")
    members = parsed.select(*keep, "raw_payload", "_obj",
                            *[J.field(obj, f).alias(f"_m_{f}") for f in fields])
    m = {f: F.col(f"_m_{f}") for f in fields}
    typed = [
        J.json_text(m["trip_id"]).alias("trip_id"),
        parse_iso_timestamp(J.json_string(m[f"{event_type}_datetime"])).alias("event_time"),  # T1
        J.json_int_value(m[f"{event_type}_zone"]).alias(f"{event_type}_zone"),
    ]
    if event_type == "pickup":
        typed.append(J.json_double(m["passenger_count"]).alias("passenger_count"))
    else:
        typed += [J.json_double(m["trip_distance"]).alias("trip_distance"),
                  J.json_double(m["total_amount"]).alias("total_amount")]
    return members.select(
        *keep, F.lit(topic).alias("topic"), "raw_payload",
        _reason(obj, m, event_type, rules).alias("reason"), *typed,
    )


def _split(parsed: DataFrame, keep_row: Column, columns: list[str]) -> DataFrame:
    """Rows where ``keep_row`` holds, without a Filter node.

    A filter on ``reason`` would be pushed below the parsing projections with
    the JSON parse copied into every rule it references; a generator over a
    one-element (or NULL) array selects the same rows and parses once.
    """
    return parsed.select(F.inline(F.when(keep_row, F.array(F.struct(*[F.col(c) for c in columns])))))


def valid_events(parsed: DataFrame) -> DataFrame:
    """Events that passed every rule, typed (V8)."""
    cols = [c for c in parsed.columns if c not in ("reason", "raw_payload")]
    return _split(parsed, F.col("reason").isNull(), cols)


def rejected_events(parsed: DataFrame) -> DataFrame:
    """Dead-letter records: topic, reason, raw_payload (V8)."""
    return _split(parsed, F.col("reason").isNotNull(), ["topic", "reason", "raw_payload"])


def pickups(parsed: DataFrame) -> DataFrame:
    return valid_events(parsed).select("trip_id", "event_time", "pickup_zone", "passenger_count")


def dropoffs(parsed: DataFrame) -> DataFrame:
    return valid_events(parsed).select("trip_id", "event_time", "dropoff_zone", "trip_distance", "total_amount")


def all_rejected(*parsed: DataFrame) -> DataFrame:
    """UNION ALL of the dead-letter records of several topics."""
    out = None
    for p in parsed:
        r = rejected_events(p)
        out = r if out is None else out.unionByName(r)
    return out


def lifecycle(pickup_events: DataFrame, dropoff_events: DataFrame) -> DataFrame:
    """One signal per valid event: signal, trip_id, event_time."""
    return (
        pickup_events.select(F.lit("pickup").alias("signal"), "trip_id", "event_time")
        .unionByName(dropoff_events.select(F.lit("dropoff").alias("signal"), "trip_id", "event_time"))
    )


def reason_counts(parsed: DataFrame) -> DataFrame:
    """Outcome per payload: reason ('ok' when valid) and count."""
    return parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("events"))

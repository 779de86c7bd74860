"""Event-log derivation from trips.

Each trip becomes one pickup and one dropoff record. The reference merges
them through a heap; here the same order is a sort key
``(event_time, kind_rank, key)`` where a dropoff precedes a pickup at equal
time, so Spark range-partitions and sorts it in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripcast.config import DEFAULT_RULES, Rules, materialize
from tripcast.functions.timefn import iso_string

DROPOFF_RANK, PICKUP_RANK = 0, 1
COPIES_PER_BLOCK = 10_000  # of equal rows numbered in one task


def pickup_payload(trip_id: Column, pickup_ts: Column, zone: Column, passengers: Column) -> Column:
    """JSON text of a pickup event."""
    return F.to_json(F.struct(
        trip_id.alias("trip_id"),
        F.lit("pickup").alias("event_type"),
        iso_string(pickup_ts).alias("pickup_datetime"),
        zone.alias("pickup_zone"),
        passengers.alias("passenger_count"),
    ))


def dropoff_payload(trip_id: Column, dropoff_ts: Column, zone: Column,
                    distance: Column, amount: Column) -> Column:
    """JSON text of a dropoff event; numbers as doubles."""
    return F.to_json(F.struct(
        trip_id.alias("trip_id"),
        F.lit("dropoff").alias("event_type"),
        iso_string(dropoff_ts).alias("dropoff_datetime"),
        zone.alias("dropoff_zone"),
        distance.cast("double").alias("trip_distance"),
        amount.cast("double").alias("total_amount"),
    ))


def row_text(columns: list[str]) -> Column:
    """Unambiguous text of a row: each value with its length, in order of the column names."""
    def one(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat_ws("#", *(one(c) for c in sorted(columns)))


def assign_trip_ids(df: DataFrame, id_col: str = "trip_id") -> DataFrame:
    """Deterministic surrogate id per source row (O3): hash of the row and its number among equal rows.

    Ids don't depend on files or their order, so they outlive a rewrite or move of
    the table. Equal rows are counted (map-side first) and numbered when they are
    written out again in blocks, so that many copies of a row don't meet in a task.
    """
    columns = df.columns
    counted = df.groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.count("*").alias("_copies"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES_PER_BLOCK))))
    first = F.col("_block") * COPIES_PER_BLOCK
    spread = blocks.repartition(*(F.col(f"`{c}`") for c in columns), F.col("_block"))
    numbered = spread.withColumn("_number", F.explode(F.sequence(
        first, F.least(first + COPIES_PER_BLOCK, F.col("_copies")) - 1)))
    return numbered.select(*(F.col(f"`{c}`") for c in columns), F.sha2(
        F.concat_ws("#", row_text(columns), F.col("_number").cast("string")), 256).alias(id_col))


def trip_events(trips: DataFrame, rules: Rules = DEFAULT_RULES,
                pickup_value: Column | None = None, dropoff_value: Column | None = None,
                with_pickup: Column | None = None, with_dropoff: Column | None = None) -> DataFrame:
    """One pickup and one dropoff record per trip: topic, key, event_time, kind_rank, value.

    ``trips`` needs trip_id, pickup_datetime, dropoff_datetime, pickup_zone,
    dropoff_zone, passenger_count, trip_distance, total_amount. The payload
    and presence columns may be overridden (fixtures damage payloads).
    """
    pv = pickup_value if pickup_value is not None else pickup_payload(
        F.col("trip_id"), F.col("pickup_datetime"), F.col("pickup_zone"), F.col("passenger_count"))
    dv = dropoff_value if dropoff_value is not None else dropoff_payload(
        F.col("trip_id"), F.col("dropoff_datetime"), F.col("dropoff_zone"),
        F.col("trip_distance"), F.col("total_amount"))
    wp = with_pickup if with_pickup is not None else F.lit(True)
    wd = with_dropoff if with_dropoff is not None else F.lit(True)
    pickup = F.struct(
        F.lit(rules.pickup_topic).alias("topic"), F.col("trip_id").alias("key"),
        F.col("pickup_datetime").alias("event_time"), F.lit(PICKUP_RANK).alias("kind_rank"),
        pv.alias("value"))
    dropoff = F.struct(
        F.lit(rules.dropoff_topic).alias("topic"), F.col("trip_id").alias("key"),
        F.col("dropoff_datetime").alias("event_time"), F.lit(DROPOFF_RANK).alias("kind_rank"),
        dv.alias("value"))
    both = F.array(F.when(wp, pickup), F.when(wd, dropoff))
    return trips.select(F.inline(F.filter(both, lambda e: e.isNotNull())))


def payload_fields(value: str = "value") -> tuple[Column, Column, Column]:
    """What the payloads of pickups and of dropoffs are made of beside key and time, and the payload made of it.

    The first two are the values for trip_events; the third is the JSON text of a record with such a value.
    """
    names = ("pickup_zone", "passenger_count", "dropoff_zone", "trip_distance", "total_amount")
    pickup = F.struct(*(F.col(c) if k < 2 else F.when(F.lit(False), F.col(c)).alias(c) for k, c in enumerate(names)))
    dropoff = F.struct(*(F.col(c) if k >= 2 else F.when(F.lit(False), F.col(c)).alias(c) for k, c in enumerate(names)))
    of = {c: F.col(value)[c] for c in names}
    key, time = F.col("key"), F.col("event_time")
    made = F.when(F.col("kind_rank") == PICKUP_RANK, pickup_payload(key, time, of["pickup_zone"], of["passenger_count"])).otherwise(
        dropoff_payload(key, time, of["dropoff_zone"], of["trip_distance"], of["total_amount"]))
    return pickup, dropoff, made


def order_event_log(events: DataFrame) -> DataFrame:
    """Replay order: event time, dropoff before pickup, then key (O2)."""
    return events.orderBy("event_time", "kind_rank", "key")


def replay_positions(events: DataFrame, sequence_col: str = "sequence") -> DataFrame:
    """events with their place in replay order, from 0 without gaps (O2).

    A distributed ranking: events are dealt by ranges of the order and sorted there, each range's
    size is counted, and a range starts where those before it end. No task sees more than
    its range, and the order is a column that outlives any later shuffle.
    """
    order = ("event_time", "kind_rank", "key")
    ranges = events.repartitionByRange(*order).sortWithinPartitions(*order)
    # the ranges are sampled, so they are written once and then read as they are
    numbered = materialize(ranges.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_range")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    out = numbered.withColumn("_range", part).join(F.broadcast(starts), "_range")
    return out.select(*events.columns, (F.col("_start") + place).alias(sequence_col))

"""Inputs derived from the provided test tables (see FIXTURES.md).

* trips (A): one trip per ``events`` row; durations, zones and presence
  flags follow fixed rules on ``event_id`` so every outcome occurs.
* topic records (A2): pickup and dropoff JSON payloads of those trips, some
  damaged on purpose, one reason per ``event_id % 50`` residue.
* raw trip rows (B): ``orders ⋈ lineitem ⋈ customer ⋈ supplier`` shaped
  like the trip CSV files, with injected rule violations.

All rows of the source tables are used; the modulo rules only choose which
variant a row takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripcast.config import DEFAULT_RULES, Rules, spread
from tripcast.functions.timefn import iso_string
from tripcast.operators.eventlog import dropoff_payload, pickup_payload, trip_events
from tripcast.sources.zones import zones_from_nations


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zone_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: 25 nations as zones, their regions as boroughs."""
    return zones_from_nations(load_table(spark, sf_dir, "nation"), load_table(spark, sf_dir, "region"))


# Fixed fixture rules (event_id residues), stated together:
#   duration: %97 -> 0 s, %89 -> 10800 s, %83 -> 10801 s, %79 -> 259200 s,
#             else 60 + (event_id * 37) % 5400 s
#   zones:    pickup = user_id % 27, dropoff = (user_id * 7 + event_id) % 27
#   passengers: %101 -> 9, else 1 + event_id % 8
#   distance: (10 + event_id % 2000) / 100
#   presence: %71 -> no pickup event, %73 -> no dropoff event
def trip_fixture(events: DataFrame) -> DataFrame:
    """Fixture A: trips derived from ``events``."""
    eid = F.col("event_id")
    dur = (
        F.when(eid % 97 == 0, 0).when(eid % 89 == 0, 10800).when(eid % 83 == 0, 10801)
        .when(eid % 79 == 0, 259200).otherwise(60 + (eid * 37) % 5400)
    )
    pickup = F.date_trunc("second", F.col("ts")).cast("timestamp")
    return events.select(
        eid.alias("event_id"),
        eid.cast("string").alias("trip_id"),
        pickup.alias("pickup_datetime"),
        F.timestamp_seconds(F.unix_seconds(pickup) + dur).alias("dropoff_datetime"),
        (F.col("user_id") % 27).cast("int").alias("pickup_zone"),
        ((F.col("user_id") * 7 + eid) % 27).cast("int").alias("dropoff_zone"),
        F.when(eid % 101 == 0, 9).otherwise(1 + eid % 8).cast("int").alias("passenger_count"),
        ((F.lit(10) + eid % 2000) / F.lit(100.0)).alias("trip_distance"),
        F.col("value").alias("total_amount"),
        (eid % 71 != 0).alias("has_pickup"),
        (eid % 73 != 0).alias("has_dropoff"),
    )


def _json(fields: list[Column], keep_nulls: bool = False) -> Column:
    opts = {"ignoreNullFields": "false"} if keep_nulls else None
    return F.to_json(F.struct(*fields), opts) if opts else F.to_json(F.struct(*fields))


# Fixed payload damage by event_id % 50, stated together:
#   pickups:  0 '{not json'; 9 valid JSON + ' x'; 1 '[1]'; 2 event_type "trip";
#             3 trip_id null; 8 pickup_zone absent; 4 pickup_datetime "yesterday";
#             5 pickup_zone as string; 6 passenger_count 9; 7 passenger_count as string
#   dropoffs: 10 trip_distance -1; 11 total_amount 0; 12 trip_distance true;
#             13 dropoff_zone 5.0; 14 dropoff_zone true
def damaged_pickup_payload() -> Column:
    r = F.col("event_id") % 50
    tid, ts = F.col("trip_id"), iso_string(F.col("pickup_datetime"))
    zone, pc = F.col("pickup_zone"), F.col("passenger_count")
    et = F.lit("pickup")

    def obj(trip_id=tid, event_type=et, when=ts, z=zone, p=pc, keep_nulls=False, drop_zone=False):
        cols = [trip_id.alias("trip_id"), event_type.alias("event_type"), when.alias("pickup_datetime")]
        if not drop_zone:
            cols.append(z.alias("pickup_zone"))
        cols.append(p.alias("passenger_count"))
        return _json(cols, keep_nulls)

    clean = pickup_payload(tid, F.col("pickup_datetime"), zone, pc)
    return (
        F.when(r == 0, F.lit("{not json"))
        .when(r == 9, F.concat(clean, F.lit(" x")))
        .when(r == 1, F.lit("[1]"))
        .when(r == 2, obj(event_type=F.lit("trip")))
        .when(r == 3, obj(trip_id=F.lit(None).cast("string"), keep_nulls=True))
        .when(r == 8, obj(drop_zone=True))
        .when(r == 4, obj(when=F.lit("yesterday")))
        .when(r == 5, obj(z=zone.cast("string")))
        .when(r == 6, obj(p=F.lit(9)))
        .when(r == 7, obj(p=pc.cast("string")))
        .otherwise(clean)
    )


def damaged_dropoff_payload() -> Column:
    r = F.col("event_id") % 50
    tid, ts = F.col("trip_id"), iso_string(F.col("dropoff_datetime"))
    zone = F.col("dropoff_zone")
    dist, amt = F.col("trip_distance").cast("double"), F.col("total_amount").cast("double")

    def obj(z=zone, d=dist, a=amt):
        return _json([tid.alias("trip_id"), F.lit("dropoff").alias("event_type"),
                      ts.alias("dropoff_datetime"), z.alias("dropoff_zone"),
                      d.alias("trip_distance"), a.alias("total_amount")])

    clean = dropoff_payload(tid, F.col("dropoff_datetime"), zone, dist, amt)
    return (
        F.when(r == 10, obj(d=F.lit(-1.0)))
        .when(r == 11, obj(a=F.lit(0.0)))
        .when(r == 12, obj(d=F.lit(True)))
        .when(r == 13, obj(z=F.lit(5.0).cast("decimal(2,1)")))
        .when(r == 14, obj(z=F.lit(True)))
        .otherwise(clean)
    )


def event_log_fixture(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Fixture A2: the event log (topic, key, event_time, kind_rank, value) of fixture A."""
    trips = trip_fixture(spread(load_table(spark, sf_dir, "events")))
    return trip_events(
        trips, rules,
        pickup_value=damaged_pickup_payload(), dropoff_value=damaged_dropoff_payload(),
        with_pickup=F.col("has_pickup"), with_dropoff=F.col("has_dropoff"),
    )


# Fixed injection rules for fixture B (l_orderkey residues), stated together:
#   %101 -> distance missing, %103 -> distance 0, %107 -> amount 0,
#   %109 -> 9 passengers, %113 -> unreadable pickup time; valid zones: nation key < 20
CLEANING_VALID_ZONE_LIMIT = 20


def raw_trip_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B: raw trip rows shaped like the trip CSV files (S2 schema)."""
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lineitem = spread(load_table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders meet their customers first: line items, the largest table, are then dealt once less
    ordered = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey", "c_custkey")
    j = (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .join(ordered, F.col("l_orderkey") == ordered.o_orderkey)
    )
    k = F.col("l_orderkey")
    amount = F.round(
        F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2
    ).cast("double")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return j.select(
        F.when(k % 113 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", fmt)).alias("pickup_datetime"),
        F.date_format("l_shipdate", fmt).alias("dropoff_datetime"),
        F.when(k % 109 == 0, F.lit(9.0)).otherwise(F.col("l_linenumber").cast("double")).alias("passenger_count"),
        F.when(k % 101 == 0, F.lit(None).cast("double")).when(k % 103 == 0, F.lit(0.0))
        .otherwise(F.col("l_quantity")).alias("trip_distance"),
        F.when(k % 107 == 0, F.lit(0.0)).otherwise(amount).alias("total_amount"),
        F.col("c_nationkey").cast("double").alias("pickup_location_id"),
        F.col("s_nationkey").cast("double").alias("dropoff_location_id"),
    )


def cleaning_zone_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_fixture(spark, sf_dir).where(F.col("location_id") < CLEANING_VALID_ZONE_LIMIT)

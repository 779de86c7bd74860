"""Explicit schemas of every table the operators read or write."""

from pyspark.sql import types as T

# zone dimension (location_id -> borough)
ZONES = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# zone lookup file as published: header LocationID,Borough,Zone,service_zone
ZONES_CSV = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# raw trip file: datetimes stay strings until coerced, numbers are doubles
RAW_TRIPS_CSV = T.StructType([
    T.StructField("pickup_datetime", T.StringType()),
    T.StructField("dropoff_datetime", T.StringType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("pickup_location_id", T.DoubleType()),
    T.StructField("dropoff_location_id", T.DoubleType()),
])

# cleaned trips
RAW_TRIPS = T.StructType([
    T.StructField("pickup_datetime", T.TimestampType()),
    T.StructField("dropoff_datetime", T.TimestampType()),
    T.StructField("pickup_zone", T.IntegerType()),
    T.StructField("dropoff_zone", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
])

# an event topic: key and JSON text
TOPIC_RECORDS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

PICKUPS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("pickup_zone", T.IntegerType()),
    T.StructField("passenger_count", T.DoubleType()),
])

DROPOFFS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("dropoff_zone", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

TRIPS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("pickup_zone", T.IntegerType()),
    T.StructField("dropoff_zone", T.IntegerType()),
    T.StructField("pickup_datetime", T.TimestampType()),
    T.StructField("dropoff_datetime", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("invalid_reason", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])

REJECTED_EVENTS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
])

AGGREGATES = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

AGGREGATE_KEYS = ("metric_name", "window_start", "window_end", "dimension")

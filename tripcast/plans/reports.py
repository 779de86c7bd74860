"""User reports over the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripcast.config import DEFAULT_RULES, Rules


def trips_per_borough(aggregates: DataFrame, day: str | None = None) -> DataFrame:
    """Trips per borough per day, largest first (R1, O5); one day when ``day`` is given."""
    rows = aggregates.where(F.col("metric_name") == "trip_count_by_borough")
    if day is not None:
        rows = rows.where(F.col("window_start") == F.lit(day).cast("timestamp_ntz"))
    return rows.select("window_start", "dimension", "value").orderBy("window_start", F.desc("value"), "dimension")


def invalid_by_reason(invalid_trips: DataFrame) -> DataFrame:
    """Invalid trips per reason."""
    return invalid_trips.groupBy("invalid_reason").agg(F.count(F.lit(1)).alias("trips"))


def rejected_listing(rejected: DataFrame) -> DataFrame:
    """topic, reason, raw_payload of the dead-letter table."""
    return rejected.select("topic", "reason", "raw_payload")


def progress(aggregates: DataFrame, metric_name: str = "trips_last_h") -> DataFrame:
    """Number of windows written and the latest window end of one metric."""
    return aggregates.where(F.col("metric_name") == metric_name).agg(
        F.count(F.lit(1)).alias("windows"), F.max("window_end").alias("last_window_end"))


def reconciliation(aggregates: DataFrame, valid_trips: DataFrame, invalid_trips: DataFrame,
                   bound=None) -> DataFrame:
    """Sum of daily trip counts vs. a direct count of valid trips in closed days.

    One row: daily_total (from the metric table), valid_trips (counted
    straight from the trip table, dropoff day closed by ``bound``),
    invalid_trips, consistent.
    """
    daily = aggregates.where(F.col("metric_name") == "trip_count_by_borough").agg(
        F.coalesce(F.sum("value"), F.lit(0.0))).scalar()
    day_end = F.date_trunc("day", F.col("event_time")) + F.expr("INTERVAL 1 DAY")
    v = valid_trips if bound is None else valid_trips.where(day_end <= bound)
    direct = v.agg(F.count(F.lit(1))).scalar()
    inval = invalid_trips.agg(F.count(F.lit(1))).scalar()
    # three scalar subqueries, one output row
    return aggregates.sparkSession.range(1).select(
        daily.alias("daily_total"), direct.alias("valid_trips"), inval.alias("invalid_trips"),
        (daily == direct.cast("double")).alias("consistent"))


def raw_reconciliation(aggregates: DataFrame, invalid_trips: DataFrame, raw_trips: DataFrame, bound, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The job's results against the raw trips it replayed.

    One row: daily_total and invalid_total from the result tables, and what the raw
    rows' own times (pickup_datetime, dropoff_datetime) say: raw_valid, trips of a valid duration in
    days that ``bound`` closes, and raw_invalid, trips of another duration, or whose sides wait out
    the time limit before ``bound``.
    """
    gap = F.unix_micros("dropoff_datetime") - F.unix_micros("pickup_datetime")
    limit = F.make_dt_interval(secs=F.lit(rules.timeout_seconds))
    met = F.abs(gap) <= rules.timeout_seconds * 1_000_000
    valid = met & (gap > 0) & (gap <= rules.max_duration_seconds * 1_000_000)
    closed = F.date_trunc("day", F.col("dropoff_datetime")) + F.expr("INTERVAL 1 DAY") <= F.col("bound")
    waited = F.least("pickup_datetime", "dropoff_datetime") + limit < F.col("bound")
    raw = raw_trips.select("pickup_datetime", "dropoff_datetime", bound.alias("bound")).agg(
        F.count_if(valid & closed).alias("raw_valid"), F.count_if((met & ~valid) | (~met & waited)).alias("raw_invalid"))
    daily = aggregates.where(F.col("metric_name") == "trip_count_by_borough").agg(F.coalesce(F.sum("value"), F.lit(0.0))).scalar()
    total = invalid_trips.agg(F.count(F.lit(1))).scalar()
    out = raw.select(daily.alias("daily_total"), "raw_valid", total.alias("invalid_total"), "raw_invalid")
    return out.withColumn("consistent", (F.col("daily_total") == F.col("raw_valid")) & (F.col("invalid_total") == F.col("raw_invalid")))

"""Scalar functions (F5, F6), statistics (A0) and window grains."""

import math
import random
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripcast.functions.timefn import epoch_millis, from_epoch_millis, iso_week_label, parse_iso_timestamp, time_of_day
from tripcast.operators import metrics as M


@pytest.mark.parametrize("hour,minute,expected", [
    (4, 59, "night"), (5, 0, "morning"), (10, 59, "morning"), (11, 0, "noon"), (13, 59, "noon"),
    (14, 0, "afternoon"), (16, 59, "afternoon"), (17, 0, "evening"), (22, 59, "evening"), (23, 0, "night"),
])
def test_time_of_day_boundaries(spark, hour, minute, expected):
    df = spark.createDataFrame([(datetime(2022, 1, 1, hour, minute),)], "ts timestamp")
    assert df.select(time_of_day(F.col("ts"))).first()[0] == expected


@pytest.mark.parametrize("day,expected", [
    ("2021-12-31", "2021-W52"), ("2022-01-01", "2021-W52"), ("2022-01-03", "2022-W01"),
    ("2024-12-30", "2025-W01"),
])
def test_iso_week_label(spark, day, expected):
    df = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("timestamp").alias("ts"))
    assert df.select(iso_week_label(F.col("ts"))).first()[0] == expected


@pytest.mark.parametrize("text,ok", [
    ("2022-01-01T10:00:00", True), ("2022-01-01", True), ("2022-01-01 10:00", True),
    ("2022-01-01T10", True), ("2022-01-01T10:00:00.123456Z", True), ("2022-01-01T10:00:00-05:00", True),
    ("2022", False), ("2022-1-1", False), ("10:00", False), ("20220101T100000", False), (" 2022-01-01", False),
])
def test_iso_grammar(spark, text, ok):
    df = spark.createDataFrame([(text,)], "s string")
    assert (df.select(parse_iso_timestamp(F.col("s"))).first()[0] is not None) == ok


def test_epoch_milliseconds_there_and_back(spark):
    df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 999000),), (datetime(2023, 5, 17, 6, 40, 0, 123000),), (None,)], "t timestamp")
    rows = df.select("t", epoch_millis(F.col("t")).alias("ms"), from_epoch_millis(epoch_millis(F.col("t"))).alias("back")).collect()
    assert [r.ms for r in rows] == [-1, 1684305600123, None] and all(r.t == r.back for r in rows)


def trips_df(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t), b, tod, float(pc), float(dist), float(amt)) for t, b, tod, pc, dist, amt in rows],
        "event_time timestamp, dropoff_borough string, time_of_day string, passenger_count double, "
        "trip_distance double, total_amount double")


def test_statistics_of_a_window(spark):
    df = trips_df(spark, [("2023-05-17 06:41:00", "N", "morning", 5, 0.35, 8.2),
                          ("2023-05-17 12:03:00", "N", "noon", 1, 11.05, 41.9),
                          ("2023-05-17 12:04:00", "S", "noon", 1, 1.0, 1.0)])
    s = M.stats_as_doubles(M.window_stats(df, M.grain("borough"))).where("dimension = 'N'").first()
    assert (s.trips, s.passengers, s.distance, s.revenue) == (2, 6.0, 11.4, 50.1)


def exact_total(values):
    finite = [v for v in values if v is not None and math.isfinite(v)]
    odd = [v for v in values if v is not None and not math.isfinite(v)]
    if odd or not finite:
        return sum(odd) if odd else None
    total = sum(map(Fraction, map(repr, finite)))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


SUMS = [[1e300, 1e-30, 1 / 3], [1e300, -1e300, 1e-30], [0.1] * 10, [1e18, 0.01, -1e18], [-0.1, -0.2, 1e-12], [5e-324, 1e-300, -1e-300], [1.7976931348623157e308, -1e292],
        [123456789.12345678, 1e-9, -123456789.12345678], [2.5, None], [None], [0.0, -0.0], [float("inf"), 1.0], [float("nan"), 1e300], [-3e-8, 2e-16, -7e25, 7e25]]


def test_sums_are_exact_in_every_order(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i, values in enumerate(SUMS):
        for k in range(4):
            mixed = values * (1 if k == 0 else 3)
            rng.shuffle(mixed)
            want[f"{i} {k}"] = exact_total(mixed)
            rows += [(f"{i} {k}", v) for v in mixed]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "dropoff_borough string, v double").repartition(5).select(
        F.to_timestamp(F.lit("2023-05-17 06:40:00")).alias("event_time"), "dropoff_borough",
        F.lit(1.0).alias("passenger_count"), F.col("v").alias("trip_distance"), F.col("v").alias("total_amount"))
    got = {r.dimension: r.revenue for r in M.window_stats(df, M.grain("borough")).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == v or (v is not None and math.isnan(v) and math.isnan(got[k])), (k, got[k], v)


def test_weekly_windows_start_monday_with_iso_label(spark):
    df = trips_df(spark, [("2022-01-01 10:00:00", "Q", "m", 1, 1.0, 10.0),   # Saturday
                          ("2022-01-03 00:00:00", "Q", "m", 1, 3.0, 30.0)])  # Monday
    rows = sorted(M.grain_metrics(df, M.grain("week")).where("metric_name = 'trips_per_week'").collect(),
                  key=lambda r: r.window_start)
    assert [(str(r.window_start), r.dimension, r.value) for r in rows] == [
        ("2021-12-27 00:00:00", "2021-W52", 1.0), ("2022-01-03 00:00:00", "2022-W01", 1.0)]


def test_revenue_per_mile_zero_distance(spark):
    df = trips_df(spark, [("2022-01-01 10:00:00", "Q", "m", 1, 0.0, 10.0)])
    v = M.grain_metrics(df, M.grain("week"), only="revenue_per_mile_by_week").first().value
    assert v == 0.0


def test_sliding_hour_equals_spark_sliding_window(spark):
    rows = [(f"2022-01-01 {h:02d}:{m:02d}:{s:02d}", "Q", "x", 1 + (h % 3), 1.5, 10.0 + m)
            for h in range(0, 5) for m in (0, 4, 5, 29, 59) for s in (0, 59)]
    df = trips_df(spark, rows)
    ours = {(r.window_start, r.window_end): (r.trips, float(r.revenue))
            for r in M.window_stats(df, M.grain("last_hour")).collect()}
    ref = df.groupBy(F.window("event_time", "1 hour", "5 minutes")).agg(
        F.count("*").alias("n"), F.sum(F.col("total_amount").cast("decimal(18,6)")).alias("rev"))
    theirs = {(r.window.start, r.window.end): (r.n, float(r.rev)) for r in ref.collect()}
    assert ours == theirs


def test_windows_close_at_the_watermark(spark):
    df = trips_df(spark, [("2022-01-01 10:00:00", "Q", "m", 1, 1.0, 10.0),
                          ("2022-01-02 10:00:00", "Q", "m", 1, 1.0, 10.0)])
    bound_open = F.lit("2022-01-01 23:59:59").cast("timestamp")
    bound_closed = F.lit("2022-01-02 00:00:00").cast("timestamp")
    assert M.window_stats(df, M.grain("borough"), bound=bound_open).count() == 0
    assert M.window_stats(df, M.grain("borough"), bound=bound_closed).count() == 1


def test_metric_rows_long_format(spark):
    df = trips_df(spark, [("2022-01-01 10:00:00", "Q", "morning", 2, 2.0, 10.0)])
    rows = M.all_metrics(df).collect()
    names = {r.metric_name for r in rows}
    assert len(names) == 12
    assert {r.value for r in rows if r.metric_name == "avg_passengers_by_borough"} == {2.0}

"""Physical-plan properties that matter at scale."""

import contextlib
import io
import os
import tempfile
from datetime import datetime

from conftest import event, records
from pyspark.sql import functions as F

from tripcast.operators import pairing, trips as T, validation as V
from tripcast.sources.trips import date_slices, table_slices, write_by_month


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_slices_reach_the_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tripcast-slices-"), "trips")
    rows = [(datetime(2021, 9, d, 12), float(d)) for d in range(1, 31)]
    spark.createDataFrame(rows, "pickup_datetime timestamp, trip_distance double").write.parquet(path)
    sliced = date_slices(spark.read.parquet(path), [(40, "2021-09-05", "2021-09-15"), (41, "2021-09-20", "2021-09-22")])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        sliced.explain("formatted")
    pushed = [line for line in buf.getvalue().splitlines() if line.startswith("PushedFilters")]
    assert pushed and "GreaterThanOrEqual(pickup_datetime" in pushed[0] and "LessThan(pickup_datetime" in pushed[0]
    got = {r.slice_no: 0 for r in sliced.collect()}
    assert sliced.count() == 14 and set(got) == {40, 41}


def test_slices_of_a_table_read_their_months_only(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tripcast-months-"), "trips")
    rows = [(datetime(2020 + m // 12, m % 12 + 1, 14, 23, 59, 59, 999999), float(m)) for m in range(48)] + [(None, 1.0), (datetime(2021, 9, 30), 2.0), (datetime(2021, 10, 1), 3.0)]
    write_by_month(spark.createDataFrame(rows, "pickup_datetime timestamp, trip_distance double"), path)
    slices = [(40, "2021-08-15", "2021-09-30"), (41, "2022-03-14", "2022-03-14"), (42, "2021-09-01", "2021-09-14")]
    sliced = table_slices(spark, path, slices)
    want = sorted((n, d) for n, lo, hi in slices for t, d in rows if t and lo <= t.date().isoformat() <= hi)
    assert sorted((r.slice_no, r.trip_distance) for r in sliced.collect()) == want
    scan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in scan
    files = sliced.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("pickup_month=")[1][:7] for r in files} == {"2021-09", "2022-03"}


def test_trip_ids_without_repeats_are_paired_by_one_aggregation(spark):
    p = V.pickups(V.parse_events(records(spark, [event("pickup")]), "pickup"))
    d = V.dropoffs(V.parse_events(records(spark, [event("dropoff")]), "dropoff"))
    plan = plan_of(T.trips_from_pairs(pairing.single_pairs(T.cogrouped(T.both_sides(p, d))), close="all"))
    for bad in ("SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "ShuffledHashJoin", "Window", "SortAggregate", "Sort ["):
        assert bad not in plan
    assert "partial_max" in plan  # map-side reduction before the shuffle

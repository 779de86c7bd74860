"""Large and small amounts, unreadable targets, repeated keys and moved columns."""

import os

import pytest
from pyspark.sql import functions as F

from tripcast.operators import metrics as M
from tripcast.sinks import writers
from tripcast.sources.trips import read_trips_csv


def trips(spark, rows):
    return spark.createDataFrame([("2021-05-03 07:00:00", "North", "morning", 1.0, d, a) for d, a in rows],
                                 "t string, dropoff_borough string, time_of_day string, passenger_count double, trip_distance double, total_amount double"
                                 ).select(F.to_timestamp("t").alias("event_time"), "*")


@pytest.mark.parametrize("rows", [[(4e-7, 12.345)], [(1.0, 1e13), (2.0, 0.01)], [(1e-30, 1e300), (3.5, 2.0)]])
def test_sums_neither_abort_nor_round(spark, rows):
    got = {r.metric_name: r.value for r in M.all_metrics(trips(spark, rows)).collect()}
    revenue, miles = sum(a for _, a in rows), sum(d for d, _ in rows)
    assert got["revenue_by_week"] == revenue
    assert got["revenue_per_mile_by_week"] == pytest.approx(revenue / miles, rel=1e-12)


def test_guard_raises_on_an_unreadable_table_and_leaves_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(path)
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            with open(f"{path}/{name}", "wb") as file:
                file.write(b"no parquet")
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):
        writers.append_if_empty(spark.range(1), path)
    assert sorted(os.listdir(path)) == before


def test_upsert_keeps_the_last_row_of_a_key(spark, tmp_path):
    path = str(tmp_path / "u")
    write = lambda rows: writers.upsert_partitions(spark.createDataFrame(rows, "k int, p int, v string").coalesce(1), path, ["k"], ["p"])
    write([(1, 0, "a"), (2, 0, "b"), (3, 1, "c")])
    write([(2, 0, "x"), (2, 0, "y"), (4, 0, "d")])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "y"), (3, "c"), (4, "d")]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("dropoff_datetime,pickup_datetime,passenger_count,total_amount,trip_distance,dropoff_location_id,pickup_location_id,extra\n"
                    "2021-05-03 08:00:00,2021-05-03 07:00:00,2,9.5,1.5,7,6,z\n")
    r = read_trips_csv(spark, str(path)).first()
    assert (r.pickup_datetime, r.dropoff_datetime, r.trip_distance, r.total_amount, r.pickup_location_id) == ("2021-05-03 07:00:00", "2021-05-03 08:00:00", 1.5, 9.5, 6.0)

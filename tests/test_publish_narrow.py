"""The publish job deals records without their texts and writes them once in between (K-S8)."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripcast.config import checkpoint_dir
from tripcast.operators import eventlog
from tripcast.plans import batch


def trips(spark):
    at = datetime(2022, 2, 7, 5)
    rows = [(at + timedelta(minutes=k % 7), at + timedelta(minutes=k % 7 + k % 3 + 1), k % 4, k % 5, k % 8 + 1, 9.5 + k % 2, 0.25 * (k % 6)) for k in range(300)]
    rows += [rows[3]] * 4 + [(at, at + timedelta(hours=1), 1, None, None, 2.0, 1.0)]
    return spark.createDataFrame(rows, "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_zone int, dropoff_zone int, passenger_count int, "
                                       "total_amount double, trip_distance double")


def tables(spark):
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file://"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_publish_writes_records_once_in_between_and_without_texts(spark, tmp_path):
    before = tables(spark)
    assert batch.run_publish_job(trips(spark), str(tmp_path / "log"))
    made = tables(spark) - before
    assert len(made) == 1  # two with all texts before
    between = spark.read.parquet(os.path.join(checkpoint_dir(spark), "tables", made.pop()))
    assert dict(between.dtypes)["key"] == "binary" and dict(between.dtypes)["value"].startswith("struct")


def test_published_records_are_those_of_the_event_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert batch.run_publish_job(trips(spark), path)
    assert not batch.run_publish_job(trips(spark), path)
    columns = ["topic", "key", "value", "event_time", "sequence"]
    got = [tuple(r) for r in spark.read.parquet(path).select(columns).orderBy("sequence").collect()]
    events = eventlog.trip_events(eventlog.assign_trip_ids(trips(spark)))
    expected = sorted(events.collect(), key=lambda r: (r.event_time, r.kind_rank, r.key))
    assert got == [(r.topic, r.key, r.value, r.event_time, k) for k, r in enumerate(expected)]
    assert sum('"passenger_count"' not in r[2] and r[0] == "pickup_events" for r in got) == 1  # a missing value has no field
    per_file = spark.read.parquet(path).select(F.input_file_name().alias("f"), "topic", "sequence").groupBy("topic", "f").agg(
        F.min("sequence").alias("lo"), F.max("sequence").alias("hi")).orderBy("topic", "lo").collect()
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:], strict=False) if a.topic == b.topic)  # files hold ranges

"""Batch jobs end to end: cleaning load, event-log publish, trip job re-run."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tripcast.config import DEFAULT_RULES as R
from tripcast.operators import validation as V
from tripcast.plans import batch
from tripcast.sources import fixtures
from tripcast.sources.trips import read_trips_csv
from tripcast.sinks import writers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def work():
    if not os.path.exists(f"{SF}/events.parquet"):
        pytest.skip("no test data")
    return tempfile.mkdtemp(prefix="tripcast-jobs-")


def test_cleaning_load_then_publish_then_validate(spark, work):
    # raw trip rows as CSV files (S2), cleaned into raw_trips (V1-V4, K-S5)
    csv_dir = os.path.join(work, "csv")
    raw = fixtures.raw_trip_fixture(spark, SF).withColumn("slice", F.year(F.try_to_timestamp("pickup_datetime")))
    writers.export_csv(raw, csv_dir, partition_by=["slice"])  # K-S7
    files = [os.path.join(r, f) for r, _, fs in os.walk(csv_dir) for f in fs if f.endswith(".csv")]
    loaded = read_trips_csv(spark, files)
    assert loaded.count() == raw.count()  # rows without a readable date land in the default partition
    raw_trips = os.path.join(work, "raw_trips")
    summary = batch.run_cleaning_job(loaded, fixtures.cleaning_zone_fixture(spark, SF), raw_trips)
    s = {(r.status, r.reason): r.rows for r in summary.collect()}
    assert s[("processed", None)] == s[("inserted", None)] + s[("rejected", None)]
    assert spark.read.parquet(raw_trips).count() == s[("inserted", None)]
    assert batch.run_cleaning_job(loaded, fixtures.cleaning_zone_fixture(spark, SF), raw_trips) is None

    # publish the event log (O2-O4, K-S8/K-S9): one pickup and one dropoff per trip, stable ids
    log_path = os.path.join(work, "event_log")
    assert batch.run_publish_job(spark.read.parquet(raw_trips), log_path) is True
    assert batch.run_publish_job(spark.read.parquet(raw_trips), log_path) is False
    log = spark.read.parquet(log_path)
    n = spark.read.parquet(raw_trips).count()
    assert log.count() == 2 * n and log.select("key").distinct().count() == n
    # every record knows its place in replay order, and each topic's files are in it
    order = log.orderBy("sequence").select("sequence", "event_time").collect()
    assert [r.sequence for r in order] == list(range(2 * n)) and all(a.event_time <= b.event_time for a, b in zip(order, order[1:]))
    for topic in (R.pickup_topic, R.dropoff_topic):
        for f in {r.f for r in log.where(F.col("topic") == topic).select(F.input_file_name().alias("f")).distinct().collect()}:
            places = [r.sequence for r in spark.read.parquet(f).select("sequence").collect()]
            assert places == sorted(places)

    # every published event passes validation
    pick = log.where(F.col("topic") == R.pickup_topic).select("key", "value")
    parsed = V.parse_events(pick, "pickup")
    assert V.rejected_events(parsed).count() == 0


def test_trip_job_rerun_is_idempotent(spark, work):
    out = os.path.join(work, "out")
    log = fixtures.event_log_fixture(spark, SF, R)
    pick = log.where(F.col("topic") == R.pickup_topic).select("key", "value")
    drop = log.where(F.col("topic") == R.dropoff_topic).select("key", "value")
    zones = fixtures.zone_fixture(spark, SF)
    batch.run_trip_job(pick, drop, zones, out)
    counts = {t: spark.read.parquet(os.path.join(out, t)).count()
              for t in ("aggregates", "invalid_trips", "rejected_events")}
    batch.run_trip_job(pick, drop, zones, out)  # replay
    again = {t: spark.read.parquet(os.path.join(out, t)).count() for t in counts}
    assert counts == again and all(v > 0 for v in counts.values())


def test_trip_ids_follow_the_rows_not_the_files(spark, tmp_path, monkeypatch):
    from tripcast.operators import eventlog

    monkeypatch.setattr(eventlog, "COPIES_PER_BLOCK", 3)  # several blocks of one row's copies
    rows = [("a#b", None)] * 8 + [("a", "b"), (None, "a#b"), ("a", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    ids = []
    for files in (1, 5):
        path = str(tmp_path / f"rows{files}")
        df.repartition(files).write.parquet(path)
        got = eventlog.assign_trip_ids(spark.read.parquet(path)).collect()
        assert sorted((r.x or "", r.y or "") for r in got) == sorted((x or "", y or "") for x, y in rows)
        ids.append({r.trip_id for r in got})
    assert len(ids[0]) == len(rows)
    assert ids[0] == ids[1]
    assert eventlog.assign_trip_ids(df.limit(0)).count() == 0

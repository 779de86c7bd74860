"""The date-slice query keeps rows of every year."""

from datetime import datetime

from pyspark.sql import functions as F

from tripcast.plans import queries
from tripcast.sources import fixtures
from tripcast.sources.trips import year_slices

DATES = ["0001-01-01", "1969-12-31 23:59:59", "1994-12-31 23:59:59.999999", "1995-01-01", "2001-12-31 23:59:59.999999", "2002-01-01", "2024-02-29 12:00:00", "9999-12-31 23:59:59"]


def test_every_year_has_a_slice(spark, monkeypatch):
    raw = fixtures.raw_trip_fixture(spark, "/root/testdata/sf0.001")
    some = raw.limit(1).drop("pickup_datetime").crossJoin(spark.createDataFrame([(d,) for d in DATES + [None, "no date"]], "pickup_datetime string"))
    some = some.select(*raw.columns)
    monkeypatch.setattr(fixtures, "raw_trip_fixture", lambda spark, sf: some)
    got = {r.pickup_datetime: r.slice_no for r in queries.s3_date_slices(spark, "").collect()}
    assert got == {d: int(d[:4]) - 1994 for d in DATES}


def test_numbers_of_the_test_data_are_as_before(spark):
    raw = fixtures.raw_trip_fixture(spark, "/root/testdata/sf0.001")
    times = raw.select(F.try_to_timestamp("pickup_datetime").alias("t")).where("t is not null")
    rows = year_slices(times, queries.FIRST_YEAR, ts_col="t").collect()
    assert len(rows) == times.count() and all(r.slice_no == r.t.year - 1994 for r in rows)
    assert {r.slice_no for r in rows} <= set(range(1, 8)) and min(r.t for r in rows) >= datetime(1995, 1, 1)

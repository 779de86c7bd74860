"""Trip file sources: multi-file CSV scan (S2), date slices (S3), ordered scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripcast.schemas import RAW_TRIPS_CSV
from tripcast.sources.csv import by_header

MONTH = "pickup_month"
RAW_TRIP_COLUMNS = [f.name for f in RAW_TRIPS_CSV.fields]


def read_trips_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All trip CSV files, columns found by each path's header, with the declared types.

    File splits replace the reference's 50,000-row chunks.
    """
    if isinstance(paths, str):
        paths = [paths]
    files = [by_header(spark, p, RAW_TRIPS_CSV).csv(p).select(*RAW_TRIP_COLUMNS) for p in paths]
    return reduce(DataFrame.unionByName, files)


def _day(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def date_slices(df: DataFrame, slices: Sequence[tuple[int, str, str]],
                ts_col: str = "pickup_datetime", slice_col: str = "slice_no") -> DataFrame:
    """Rows whose ``ts_col`` lies in one of the named day ranges (S3).

    ``slices`` is a short list of ``(number, first_day, last_day)``; a row
    belongs to a slice when ``first_day <= ts < last_day + 1 day`` (K14: no
    fractional second is lost at the upper end). The slice number is a CASE
    expression, so the outer bounds reach the scan as pushed filters.
    """
    ts = F.col(ts_col)
    label: Column | None = None
    lo_all, hi_all = None, None
    for number, first, last in slices:
        lo = dt.datetime.combine(_day(first), dt.time())
        hi = dt.datetime.combine(_day(last) + dt.timedelta(days=1), dt.time())
        cond = (ts >= F.lit(lo)) & (ts < F.lit(hi))
        label = F.when(cond, F.lit(number)) if label is None else label.when(cond, F.lit(number))
        lo_all = lo if lo_all is None or lo < lo_all else lo_all
        hi_all = hi if hi_all is None or hi > hi_all else hi_all
    return (
        df.where((ts >= F.lit(lo_all)) & (ts < F.lit(hi_all)))
        .withColumn(slice_col, label)
        .where(F.col(slice_col).isNotNull())
    )


def write_by_month(df: DataFrame, path: str, ts_col: str = "pickup_datetime") -> None:
    """Trips as a table with one folder per month of ``ts_col``; rows without a time go to the null folder."""
    by_month = df.withColumn(MONTH, F.trunc(F.col(ts_col).cast("date"), "month"))
    by_month.repartition(MONTH).write.partitionBy(MONTH).parquet(path)


def table_slices(spark: SparkSession, path: str, slices: Sequence[tuple[int, str, str]],
                 ts_col: str = "pickup_datetime", slice_col: str = "slice_no") -> DataFrame:
    """As date_slices, over a table of ``write_by_month``: only the folders of the slices' months are read (S3).

    The slices are a table that is joined by month, so that their months prune the
    scan when it runs. A row that lies in two slices comes once for each.
    """
    rows = []
    for number, first, last in slices:
        lo, hi = _day(first), _day(last)
        for k in range(12 * lo.year + lo.month - 1, 12 * hi.year + hi.month):
            rows.append((number, lo, hi, dt.date(k // 12, k % 12 + 1, 1)))
    named = spark.createDataFrame(rows, f"{slice_col} int, _first date, _last date, {MONTH} date")
    day = F.col(ts_col).cast("date")
    found = spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("date"))
    # a row per slice and month, named by the caller: always a small side
    named = named.where("_first <= _last")  # a slice that ends before it starts holds nothing
    return found.join(F.broadcast(named), MONTH).where(day.between(F.col("_first"), F.col("_last"))).drop(MONTH, "_first", "_last")


def year_slices(df: DataFrame, first_year: int, ts_col: str = "pickup_datetime", slice_col: str = "slice_no") -> DataFrame:
    """Rows with a time, in one slice per calendar year (S3); ``first_year`` is number 1, earlier years have 0 and less.

    The number follows from the row alone, so no year that the data holds is left out.
    """
    return df.where(F.col(ts_col).isNotNull()).withColumn(slice_col, F.year(ts_col) - F.lit(first_year - 1))


def ordered_trips(df: DataFrame, columns: Sequence[str] | None = None,
                  order_col: str = "pickup_datetime") -> DataFrame:
    """Projected columns in event-time order (S4, O1): a range-partitioned sort."""
    cols = list(columns) if columns else df.columns
    return df.select(*cols).orderBy(order_col)

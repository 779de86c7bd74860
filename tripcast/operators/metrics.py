"""Windowed trip metrics (A0-A12) and the wide-to-long finaliser.

Statistics per window and dimension are a ``groupBy(window, key, bands)`` of counts
and sums, in which a hot dimension value (the constant 'all', a busy borough) is
reduced before the shuffle, and a small second one that puts the bands together. A
band is a range of magnitudes (``functions.numeric``): sums are exact and the same in
every row order, for values of any size (K13). Nearly all rows share one band, so
the first aggregation has a row per window and key.

Metrics are listed in ``METRICS``; add one by adding a line.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.functions.numeric import added, amount, band, ratio, ratio_or_zero, special
from tripcast.functions.timefn import iso_week_label

# Fixed metric names: what each one is, over the statistics of its grain.
#   (name, grain, statistic, divided by, what a division by zero or less gives)
METRICS = (
    ("trip_count_by_borough", "borough", "trips", None, None),
    ("avg_passengers_by_borough", "borough", "passengers", "trips", None),
    ("avg_distance_by_borough", "borough", "distance", "trips", None),
    ("trip_count_by_time_of_day", "time_of_day", "trips", None, None),
    ("avg_passengers_by_time_of_day", "time_of_day", "passengers", "trips", None),
    ("avg_distance_by_time_of_day", "time_of_day", "distance", "trips", None),
    ("trips_per_week", "week", "trips", None, None),
    ("revenue_by_week", "week", "revenue", None, None),
    ("revenue_per_mile_by_week", "week", "revenue", "distance", 0.0),
    ("trips_last_h", "last_hour", "trips", None, None),
    ("revenue_last_h", "last_hour", "revenue", None, None),
    ("avg_price_last_h", "last_hour", "revenue", "trips", None),
)


def value_of(statistic: str, divisor: str | None, at_zero: float | None) -> Column:
    if divisor is None:
        return F.col(statistic).cast("double")
    return ratio(F.col(statistic), F.col(divisor)) if at_zero is None else ratio_or_zero(F.col(statistic), F.col(divisor))


@dataclass(frozen=True)
class Grain:
    """Window shape and dimension."""

    name: str
    size_seconds: int
    slide_seconds: int | None = None      # None: tumbling
    offset_seconds: int = 0
    dimension: str | None = None          # column of the trips; None: constant
    constant: str = "all"
    label_from_window: Callable[[Column], Column] | None = None  # dimension derived from window start

    @property
    def metrics(self) -> dict[str, Column]:
        return {name: value_of(*how) for name, of, *how in METRICS if of == self.name}


def grains(rules: Rules = DEFAULT_RULES) -> list[Grain]:
    day, week = 24 * 3600, 7 * 24 * 3600
    return [
        Grain("borough", day, dimension="dropoff_borough"),
        Grain("time_of_day", day, dimension="time_of_day"),
        # 7-day windows shifted 4 days from the epoch (a Thursday) start on Monday; the
        # ISO week label is a function of the window, so it is not a grouping key
        Grain("week", week, offset_seconds=4 * 24 * 3600, label_from_window=iso_week_label),
        Grain("last_hour", rules.last_hour_window_minutes * 60, slide_seconds=rules.last_hour_slide_minutes * 60),
    ]


def grain(name: str, rules: Rules = DEFAULT_RULES) -> Grain:
    return next(g for g in grains(rules) if g.name == name)


# statistics per window and the trip column each one sums
SUMMED = {"passengers": "passenger_count", "distance": "trip_distance", "revenue": "total_amount"}
STATS = ("trips", *SUMMED)
BANDS = [f"{name}_band" for name in SUMMED]


def banded(trips: DataFrame) -> DataFrame:
    """trips with the band of each summed column, by which sums are grouped."""
    return trips.withColumns({f"{name}_band": band(F.col(c)) for name, c in SUMMED.items()})


def sum_columns() -> list[Column]:
    """Aggregates of one window, key and bands."""
    return [F.count(F.lit(1)).alias("trips"),
            *(f for name, c in SUMMED.items() for f in (F.sum(amount(F.col(c))).alias(f"{name}_total"), F.sum(special(F.col(c))).alias(f"{name}_special")))]


def gathered_columns() -> list[Column]:
    """Aggregates over the rows of one window and key, a few per band."""
    of = lambda name: F.collect_list(F.struct(F.col(f"{name}_band").alias("band"), F.col(f"{name}_total").alias("total")))
    return [F.sum("trips").alias("trips"), *(f for name in SUMMED for f in (of(name).alias(f"{name}_bands"), F.sum(f"{name}_special").alias(f"{name}_special")))]


def finished(stats: DataFrame) -> DataFrame:
    """Statistics with the bands of each sum put together as one double."""
    return stats.select("window_start", "window_end", "dimension", "trips",
                        *[F.coalesce(f"{name}_special", added(F.col(f"{name}_bands"))).alias(name) for name in SUMMED])


def _dim(g: Grain) -> Column:
    return F.col(g.dimension) if g.dimension else F.lit(g.constant)


def window_stats(trips: DataFrame, g: Grain, rules: Rules = DEFAULT_RULES,
                 time_col: str = "event_time", bound: Column | None = None) -> DataFrame:
    """window_start, window_end, dimension, trips, passengers, distance, revenue (A0).

    ``bound``: windows are kept only when ``window_end <= bound`` (closed by
    the watermark); None keeps every window. Streams may use it too: both
    aggregations are by windows of the event time.
    """
    size, slide, offset = f"{g.size_seconds} seconds", f"{g.slide_seconds or g.size_seconds} seconds", f"{g.offset_seconds} seconds"
    # one row per slide, key and bands first: a trip is in one slide, also if its windows overlap
    by_slide = g.slide_seconds is not None and g.size_seconds % g.slide_seconds == 0 and not g.offset_seconds
    first = F.window(time_col, slide, slide, offset) if by_slide or g.slide_seconds is None else F.window(time_col, size, slide, offset)
    sums = banded(trips).groupBy(first.alias("s"), _dim(g).alias("dimension"), *BANDS).agg(*sum_columns())
    w = F.window(F.window_time("s"), size, slide).alias("w") if by_slide else F.col("s").alias("w")
    stats = sums.groupBy(w, "dimension").agg(*gathered_columns()).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
    if g.label_from_window is not None:
        stats = stats.withColumn("dimension", g.label_from_window(F.col("window_start")))
    if bound is not None:
        stats = stats.where(F.col("window_end") <= bound)
    return finished(stats)


def to_metric_rows(stats: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """One statistics row -> one row per metric (A0b): metric_name, window_start, window_end, dimension, value."""
    args = [x for name, value in metrics.items() for x in (F.lit(name), value)]
    return stats.select(
        F.stack(F.lit(len(metrics)), *args).alias("metric_name", "value"),
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "dimension",
    ).select("metric_name", "window_start", "window_end", "dimension", "value")


def grain_metrics(trips: DataFrame, g: Grain, rules: Rules = DEFAULT_RULES,
                  bound: Column | None = None, only: str | None = None) -> DataFrame:
    metrics = g.metrics if only is None else {only: g.metrics[only]}
    return to_metric_rows(window_stats(trips, g, rules, bound=bound), metrics)


def all_metrics(trips: DataFrame, rules: Rules = DEFAULT_RULES, bound: Column | None = None) -> DataFrame:
    """Every windowed metric (U3 without the gauge), grain by grain.

    Each grain reads its own columns of the trips; give it a written table
    where making the trips is dear.
    """
    return reduce(DataFrame.unionByName, (grain_metrics(trips, g, rules, bound) for g in grains(rules)))


def metric(trips: DataFrame, name: str, rules: Rules = DEFAULT_RULES, bound: Column | None = None) -> DataFrame:
    """Rows of one named metric."""
    for g in grains(rules):
        if name in g.metrics:
            return grain_metrics(trips, g, rules, bound, only=name)
    raise KeyError(name)


def stats_as_doubles(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "dimension", F.col("trips").cast("bigint").alias("trips"),
        *[F.col(c).cast("double").alias(c) for c in ("passengers", "distance", "revenue")],
    )

"""Open-trips gauge (G1, A13) on an event-time tick grid.

A pickup at ``p`` with dropoff ``d`` (or none) is open at tick ``t`` iff
``p <= t <= p + 3h`` and it was not dropped off by ``t``; a dropoff more than 3 h
before its pickup is forgotten, and a pickup that another one of its trip id
replaces is open until then. Instead of testing every trip at every tick (a range
join), each trip adds 1 at the first tick >= p and takes it away at the tick where
it closes; the deltas are summed per tick (partial aggregation, so a busy minute is
not one hot task) and turned into counts by prefix sums.

Ticks are emitted while a pickup lies in their window [t - 3h, t], zeros included,
and not in idle times: output follows the pickups, not the distance between
the first and the last one. Prefix sums run per block of ticks (a day at one-minute
ticks). A trip spans two blocks at most, and one that goes on into the next block
counts there from its first tick on, so no sum crosses blocks. With a final
watermark (``bound``) the last tick is the one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripcast.config import DEFAULT_RULES, Rules


def _floor_tick(us: Column, tick_us: int) -> Column:
    return us - F.pmod(us, F.lit(tick_us))


def _ceil_tick(us: Column, tick_us: int) -> Column:
    return _floor_tick(us + F.lit(tick_us - 1), tick_us)


def trip_intervals(pairs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """start, end (both open), seen (end of the window), in epoch microseconds, per pickup; ends are exclusive."""
    tick_us = rules.gauge_tick_seconds * 1_000_000
    span_us = rules.gauge_window_seconds * 1_000_000
    p, d = F.unix_micros("p.t"), F.unix_micros("d.t")
    seen = _floor_tick(p + F.lit(span_us), tick_us) + F.lit(tick_us)
    closed = F.when(d >= p - F.lit(span_us), _ceil_tick(d, tick_us))
    replaced = _ceil_tick(F.unix_micros("replaced_at"), tick_us)
    return pairs.where(F.col("p.t").isNotNull()).select(
        _ceil_tick(p, tick_us).alias("start"), F.least(seen, closed, replaced).alias("end"), seen.alias("seen"))


def open_trips(pairs: DataFrame, rules: Rules = DEFAULT_RULES, bound: Column | None = None) -> DataFrame:
    """metric_name='open_trips', window_start=t-3h, window_end=t, dimension='all', value."""
    tick_us = rules.gauge_tick_seconds * 1_000_000
    span_us = rules.gauge_window_seconds * 1_000_000
    block_us = tick_us * rules.gauge_block_ticks
    if block_us < span_us + tick_us:
        raise ValueError("a block of ticks must be longer than the gauge's window")
    iv = trip_intervals(pairs, rules).withColumn("next", _floor_tick(F.col("start"), block_us) + F.lit(block_us))
    start, end, seen, after = (F.col(c) for c in ("start", "end", "seen", "next"))

    def delta(when: Column, tick: Column, opened: Column, covered: Column) -> Column:
        return F.when(when, F.struct(tick.alias("tick"), opened.cast("int").alias("opened"), covered.cast("int").alias("covered")))

    opened = end > start
    deltas = F.array(
        delta(F.lit(True), start, opened, F.lit(1)),
        delta(seen > after, after, end > after, F.lit(1)),  # goes on in the next block
        delta(opened & (end != after), end, F.lit(-1), F.lit(0)),
        delta(seen != after, seen, F.lit(0), F.lit(-1)))
    per_tick = (iv.select(F.inline(F.filter(deltas, lambda x: x.isNotNull())))
                .groupBy("tick").agg(F.sum("opened").alias("opened"), F.sum("covered").alias("covered"))
                .withColumn("block", _floor_tick(F.col("tick"), block_us)))
    of_block = Window.partitionBy("block").orderBy("tick")
    runs = per_tick.select(
        "tick", F.sum("opened").over(of_block).alias("open"), F.sum("covered").over(of_block).alias("covered"),
        (F.lead("tick", 1).over(of_block)).alias("until"), (F.col("block") + F.lit(block_us)).alias("block_end"))
    last = F.coalesce("until", "block_end") - F.lit(tick_us)
    if bound is not None:
        runs = runs.withColumn("limit", _floor_tick(F.unix_micros(bound) - F.lit(1), tick_us))
        last = F.least(last, F.col("limit"))
    ticks = runs.withColumn("last", last).where((F.col("covered") > 0) & (F.col("tick") <= F.col("last")))
    ticks = ticks.select(F.explode(F.sequence("tick", "last", F.lit(tick_us))).alias("tick"), "open")
    return tick_rows(ticks, rules)


def tick_rows(ticks: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Metric rows of ticks (epoch microseconds) and their open trips."""
    span_us = rules.gauge_window_seconds * 1_000_000
    return ticks.select(
        F.lit("open_trips").alias("metric_name"),
        F.timestamp_micros(F.col("tick") - F.lit(span_us)).cast("timestamp_ntz").alias("window_start"),
        F.timestamp_micros(F.col("tick")).cast("timestamp_ntz").alias("window_end"),
        F.lit("all").alias("dimension"),
        F.col("open").cast("double").alias("value"),
    )

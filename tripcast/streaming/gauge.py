"""Open-trips gauge in the streaming job (G1, T10, T12) on bounded state.

Signals are keyed by a bucket of their trip id. A bucket's state holds the trips that are
open, the dropoffs whose pickup has not come yet, and per tick what opens and closes
there; each of them goes when its three hours of event time are over. Event-time
timers emit a bucket's open trips for every tick that the watermark has passed, once, so
that a micro-batch costs its signals and the ticks it passes, whatever came
before. All buckets pass a tick in the same micro-batch, where the sink adds them up
and upserts the rows; a replayed micro-batch writes the same rows again.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.operators import gauge
from tripcast.sinks import writers
from tripcast.streaming.join_processor import micros

BUCKETS = 64
TICKS = "tick long, open long"


class OpenTripsProcessor(StatefulProcessor):
    """The trips of one bucket that are open at each tick; the rules are those of ``operators.gauge``."""

    def __init__(self, rules: Rules = DEFAULT_RULES):
        self.tick = rules.gauge_tick_seconds * 1_000_000
        self.span = rules.gauge_window_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "trip_id string", "p long, until long")
        self.dropped = handle.getMapState("dropped", "trip_id string", "d long")
        # what changes at a tick, and the trips whose state ends there
        self.changes = handle.getMapState("changes", "tick long", "opened long, covered long, over array<string>")
        # open and covering trips before the tick that comes next
        self.level = handle.getValueState("level", "opened long, covered long, next long")

    def _ceil(self, t: int) -> int:
        return -(-t // self.tick) * self.tick

    def _seen(self, p: int) -> int:
        return (p + self.span) // self.tick * self.tick + self.tick

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, list] = {}

        def change(at: int, opened: int = 0, covered: int = 0, over: str | None = None) -> None:
            entry = new.setdefault(at, [0, 0, []])
            entry[0] += opened
            entry[1] += covered
            if over is not None:
                entry[2].append(over)

        def move(start: int, end: int, to: int) -> None:
            """An interval that ended at end now ends at to, but not before its start."""
            to = max(start, min(end, to))
            if to != end:
                change(end, opened=1)
                change(to, opened=-1)

        for t, signal, trip in sorted((micros(r.event_time), r.signal != "pickup", r.trip_id) for r in rows):
            k = (trip,)
            held = tuple(self.open.getValue(k)) if self.open.containsKey(k) else None
            if signal:  # a dropoff
                if held and t >= held[0] - self.span:
                    move(self._ceil(held[0]), held[1], self._ceil(t))
                    self.open.removeKey(k)
                else:
                    self.dropped.updateValue(k, (t,))
                    change(self._ceil(t + self.span) + self.tick, over=trip)
                continue
            start, end = self._ceil(t), self._seen(t)
            change(start, opened=1, covered=1)
            change(end, opened=-1, covered=-1)
            before = self.dropped.getValue(k)[0] if self.dropped.containsKey(k) else None
            if before is not None and before >= t - self.span:
                move(start, end, self._ceil(before))
                self.dropped.removeKey(k)
            elif held and held[0] > t:  # the one that replaces it came first
                move(start, end, self._ceil(held[0]))
            else:
                if held:
                    move(self._ceil(held[0]), held[1], start)
                self.open.updateValue(k, (t, end))
                change(end, over=trip)
        for at, (opened, covered, over) in new.items():
            if self.changes.containsKey((at,)):
                was = self.changes.getValue((at,))
                opened, covered, over = was[0] + opened, was[1] + covered, list(was[2]) + over
            self.changes.updateValue((at,), (opened, covered, over))
        if new:
            self.handle.registerTimer(min(new) // 1000)
        return iter(())

    def _forget(self, trips: list[str], at: int) -> None:
        for trip in trips:
            k = (trip,)
            if self.open.containsKey(k) and self.open.getValue(k)[1] <= at:
                self.open.removeKey(k)
            if self.dropped.containsKey(k) and self.dropped.getValue(k)[0] + self.span < at:
                self.dropped.removeKey(k)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        opened, covered, at = tuple(self.level.get()) if self.level.exists() else (0, 0, 0)
        pending = sorted(k[0] for k in self.changes.keys())
        passed = [t for t in pending if t < watermark]
        for t in [*passed, None]:
            stop = self._ceil(watermark) if t is None else t
            if covered > 0:
                for tick in range(at, stop, self.tick):
                    yield Row(tick=tick, open=opened)
            at = max(at, stop)
            if t is not None:
                change = self.changes.getValue((t,))
                opened, covered = opened + change[0], covered + change[1]
                self._forget(list(change[2]), t)
                self.changes.removeKey((t,))
        rest = pending[len(passed):]
        if covered > 0 or rest:
            self.level.update((opened, covered, at))
            due = min([at] * (covered > 0) + rest[:1]) // 1000
            self.handle.registerTimer(max(due, watermark // 1000 + 1))
        else:
            self.level.clear()

    def close(self) -> None:
        pass


def bucket_ticks(signals: DataFrame, rules: Rules = DEFAULT_RULES, buckets: int = BUCKETS) -> DataFrame:
    """Lifecycle signals with a watermark to (tick, open): one row per bucket and tick with a pickup in its window."""
    keyed = signals.select("signal", "trip_id", "event_time", F.pmod(F.xxhash64("trip_id"), F.lit(buckets)).alias("bucket"))
    return keyed.groupBy("bucket").transformWithState(OpenTripsProcessor(rules), TICKS, "Append", "EventTime")


def gauge_sink(out_dir: str, rules: Rules = DEFAULT_RULES):
    """foreachBatch function: add up the buckets and upsert the ticks."""
    path = os.path.join(out_dir, "aggregates")

    def write(batch: DataFrame, epoch_id: int) -> None:
        ticks = batch.groupBy("tick").agg(F.sum("open").alias("open"))
        writers.upsert_partitions(gauge.tick_rows(ticks, rules), path)

    return write

"""Streaming trip join (J1-J3, T9, T11) as a ``StatefulProcessor``.

Used with ``groupBy("trip_id").transformWithState(..., timeMode="EventTime")``
over the union of valid pickups and dropoffs (with a 30 s watermark each).
Per trip_id the state holds at most one pickup and one dropoff:

* an event whose counterpart is held completes the trip at once (rows of a
  key inside one micro-batch arrive in no guaranteed order, so both orders
  are matched immediately; the trip's event time is the dropoff's);
* a held counterpart more than 48 h away is not matched: it times out on
  its own, as in batch (J1.6), whatever the micro-batch boundaries;
* otherwise the event is held (a newer event of the same side within 48 h replaces
  it, with its timer; one that comes later releases it) and an event-time timer at
  event time + 48 h is registered;
* when a timer fires, the held event it belongs to is released as an
  orphan: ``missing_dropoff`` for a pickup, ``missing_pickup`` for a dropoff.

Events that arrive in event-time order are paired by the rule of batch
(``operators.pairing``), repeated ones too; those of one micro-batch are put in that order
first. Repeated events that arrive out of order in different micro-batches meet in
the order of their arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, TimestampType

from tripcast.config import DEFAULT_RULES, Rules

PICKUP_STATE = StructType([
    StructField("t", TimestampType()),
    StructField("pickup_zone", IntegerType()),
    StructField("passenger_count", DoubleType()),
])
DROPOFF_STATE = StructType([
    StructField("t", TimestampType()),
    StructField("dropoff_zone", IntegerType()),
    StructField("trip_distance", DoubleType()),
    StructField("total_amount", DoubleType()),
])

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _utc(t: datetime | None) -> datetime | None:
    """Aware UTC datetime; Spark hands naive values in the worker's local time."""
    return None if t is None else t.astimezone(timezone.utc)


def micros(t: datetime) -> int:
    return (_utc(t) - _EPOCH) // timedelta(microseconds=1)


def _ms(t: datetime) -> int:
    return (_utc(t) - _EPOCH) // timedelta(milliseconds=1)


def _from_ms(ms: int) -> datetime:
    return _EPOCH + timedelta(milliseconds=ms)


def _order(r: Row) -> tuple:
    """Event order, ties as in batch: pickups first, then by content."""
    return (r.event_time, r.side != "pickup", *(x if x is not None else 0 for x in (r.zone, r.passenger_count, r.trip_distance, r.total_amount)))


class TripJoinProcessor(StatefulProcessor):
    def __init__(self, rules: Rules = DEFAULT_RULES):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pickup = handle.getValueState("pickup", PICKUP_STATE)
        self.dropoff = handle.getValueState("dropoff", DROPOFF_STATE)

    # -- rows ---------------------------------------------------------------
    def _trip(self, trip_id, p, d) -> Row:
        p = (_utc(p[0]),) + tuple(p[1:])
        d = (_utc(d[0]),) + tuple(d[1:])
        duration = (d[0] - p[0]) / timedelta(seconds=1)
        if duration <= 0:
            reason = "non_positive_duration"
        elif duration > self.rules.max_duration_seconds:
            reason = "duration_over_3h"
        else:
            reason = None
        return Row(trip_id=trip_id, pickup_zone=p[1], dropoff_zone=d[1], pickup_datetime=p[0],
                   dropoff_datetime=d[0], duration_seconds=duration, trip_distance=d[2],
                   passenger_count=p[2], total_amount=d[3], is_valid=reason is None,
                   invalid_reason=reason, event_time=d[0])

    def _orphan_pickup(self, trip_id, p, at) -> Row:
        return Row(trip_id=trip_id, pickup_zone=p[1], dropoff_zone=None, pickup_datetime=p[0],
                   dropoff_datetime=None, duration_seconds=None, trip_distance=None,
                   passenger_count=p[2], total_amount=None, is_valid=False,
                   invalid_reason="missing_dropoff", event_time=at)

    def _orphan_dropoff(self, trip_id, d, at) -> Row:
        return Row(trip_id=trip_id, pickup_zone=None, dropoff_zone=d[1], pickup_datetime=None,
                   dropoff_datetime=d[0], duration_seconds=None, trip_distance=d[2],
                   passenger_count=None, total_amount=d[3], is_valid=False,
                   invalid_reason="missing_pickup", event_time=at)

    def _timeout(self, t: datetime) -> int:
        return _ms(t) + self.rules.timeout_seconds * 1000

    # -- callbacks ----------------------------------------------------------
    def _release(self, trip_id, side: str, held: tuple) -> Row:
        at = _from_ms(self._timeout(held[0]))
        return self._orphan_pickup(trip_id, held, at) if side == "pickup" else self._orphan_dropoff(trip_id, held, at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        trip_id = key[0]
        limit = timedelta(seconds=self.rules.timeout_seconds)
        for r in sorted(rows, key=_order):
            t = _utc(r.event_time)
            if r.side == "pickup":
                side, mine, other = "pickup", self.pickup, self.dropoff
                ev = (t, r.zone, r.passenger_count)
            else:
                side, mine, other = "dropoff", self.dropoff, self.pickup
                ev = (t, r.zone, r.trip_distance, r.total_amount)
            if other.exists():
                held = tuple(other.get())
                ht = _utc(held[0])
                if abs(t - ht) <= limit:  # counterpart still waiting: complete the trip
                    yield self._trip(trip_id, ev, held) if side == "pickup" else self._trip(trip_id, held, ev)
                    other.clear()
                    self.handle.deleteTimer(self._timeout(ht))
                    continue
                # farther than 48 h: no match; each side times out on its own timer (J1.6)
            if mine.exists():
                held = tuple(mine.get())
                self.handle.deleteTimer(self._timeout(held[0]))
                if t - _utc(held[0]) > limit:  # its time was over before this one came
                    yield self._release(trip_id, side, held)
            mine.update(ev)
            self.handle.registerTimer(self._timeout(t))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        trip_id = key[0]
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        for side, state in (("pickup", self.pickup), ("dropoff", self.dropoff)):
            if state.exists():
                held = tuple(state.get())
                if self._timeout(held[0]) <= expiry:
                    yield self._release(trip_id, side, held)
                    state.clear()

    def close(self) -> None:
        pass

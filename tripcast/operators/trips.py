"""Trip join in batch.

The keyed full outer join of pickups and dropoffs is a co-group: both sides
are unioned and grouped once by ``trip_id``. One shuffle serves both sides, and
partial aggregation before the shuffle keeps a hot trip_id from landing whole
in one task. Trip ids with one event a side, nearly all, are paired by that
alone; those with more are paired in event order (``pairing``). The join never needs a
sort-merge of the two sides.

Release rules (``close``):
* ``"watermark"`` (default, parity with a finite replay): the final
  watermark is ``least(max pickup time, max dropoff time) - 30 s``; an
  orphan is released when its timeout timer (event time + 48 h) lies before
  it; windows downstream close when their end is at or before it.
* ``"all"``: the stream is complete, every orphan is released.

Matching rule: a pickup and a dropoff of one trip_id match when they are at
most 48 h apart (inclusive); farther apart each side times out on its own
(J1.6), giving ``missing_dropoff`` and ``missing_pickup`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.operators import pairing

_P = T.StructType([
    T.StructField("t", T.TimestampType()),
    T.StructField("pickup_zone", T.IntegerType()),
    T.StructField("passenger_count", T.DoubleType()),
])
_D = T.StructType([
    T.StructField("t", T.TimestampType()),
    T.StructField("dropoff_zone", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])


def both_sides(pickup_events: DataFrame, dropoff_events: DataFrame) -> DataFrame:
    """trip_id, p, d: the events of both sides in one shape, the other side null."""
    p = pickup_events.select(
        "trip_id",
        F.struct(F.col("event_time").alias("t"), "pickup_zone", "passenger_count").cast(_P).alias("p"),
        F.lit(None).cast(_D).alias("d"),
    )
    d = dropoff_events.select(
        "trip_id",
        F.lit(None).cast(_P).alias("p"),
        F.struct(F.col("event_time").alias("t"), "dropoff_zone", "trip_distance", "total_amount").cast(_D).alias("d"),
    )
    return p.unionByName(d)


def cogrouped(sides: DataFrame) -> DataFrame:
    """trip_id, p, d, pickup_events, dropoff_events; p and d are only meant for trip ids with one event a side.

    Each field is aggregated by itself: fixed-width buffers keep this a hash aggregation
    without a sort, which a maximum of structs would need.
    """
    fields = [(side, f.name) for side, of in (("p", _P), ("d", _D)) for f in of.fields]
    g = sides.groupBy("trip_id").agg(*[F.max(f"{side}.{name}").alias(f"{side}_{name}") for side, name in fields],
                                     F.count("p").alias("pickup_events"), F.count("d").alias("dropoff_events"))

    def packed(side: str, events: str) -> Column:
        return F.when(F.col(events) > 0, F.struct(*[F.col(f"{side}_{name}").alias(name) for of, name in fields if of == side])).alias(side)

    return g.select("trip_id", packed("p", "pickup_events"), packed("d", "dropoff_events"), "pickup_events", "dropoff_events")


def pair_sides(pickup_events: DataFrame, dropoff_events: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """trip_id, p, d, replaced_at: the events of both sides, paired (J1, J1.5)."""
    sides = both_sides(pickup_events, dropoff_events)
    return pairing.pairs(cogrouped(sides), sides, rules)


def final_watermark(pairs: DataFrame, rules: Rules = DEFAULT_RULES) -> Column:
    """Scalar: least(max pickup time, max dropoff time) - out-of-orderness."""
    return pairs.agg(
        F.least(F.max("p.t"), F.max("d.t")) - F.make_dt_interval(secs=F.lit(rules.out_of_orderness_seconds))
    ).scalar()


def duration_reason(duration: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Duration rule (J3): <= 0 non_positive_duration, > 3 h duration_over_3h, else NULL."""
    return (
        F.when(duration <= 0, F.lit("non_positive_duration"))
        .when(duration > rules.max_duration_seconds, F.lit("duration_over_3h"))
    )


def trips_from_pairs(g: DataFrame, rules: Rules = DEFAULT_RULES, close: str = "watermark",
                       bound: Column | None = None) -> DataFrame:
    """Trip rows (matched trips and released orphans) from pairs."""
    if close not in ("watermark", "all"):
        raise ValueError("close must be 'watermark' or 'all'")
    pt, dt_ = F.col("p.t"), F.col("d.t")
    timeout = F.make_dt_interval(secs=F.lit(rules.timeout_seconds))
    gap_us = F.unix_micros(dt_) - F.unix_micros(pt)
    matched = F.coalesce(F.abs(gap_us) <= F.lit(rules.timeout_seconds * 1_000_000), F.lit(False))
    duration = gap_us / F.lit(1_000_000.0)
    reason = duration_reason(duration, rules)
    if close == "all":
        def released(t: Column) -> Column:
            return F.lit(True)
    else:
        b = bound if bound is not None else final_watermark(g, rules)

        def released(t: Column) -> Column:
            return F.coalesce(t + timeout < b, F.lit(False))

    null_i, null_d, null_t = (F.lit(None).cast(x) for x in ("int", "double", "timestamp"))
    trip = F.struct(
        F.col("trip_id"), F.col("p.pickup_zone").alias("pickup_zone"),
        F.col("d.dropoff_zone").alias("dropoff_zone"), pt.alias("pickup_datetime"),
        dt_.alias("dropoff_datetime"), duration.alias("duration_seconds"),
        F.col("d.trip_distance").alias("trip_distance"), F.col("p.passenger_count").alias("passenger_count"),
        F.col("d.total_amount").alias("total_amount"), reason.isNull().alias("is_valid"),
        reason.alias("invalid_reason"), dt_.alias("event_time"),
    )
    no_dropoff = F.struct(
        F.col("trip_id"), F.col("p.pickup_zone").alias("pickup_zone"), null_i.alias("dropoff_zone"),
        pt.alias("pickup_datetime"), null_t.alias("dropoff_datetime"), null_d.alias("duration_seconds"),
        null_d.alias("trip_distance"), F.col("p.passenger_count").alias("passenger_count"),
        null_d.alias("total_amount"), F.lit(False).alias("is_valid"),
        F.lit("missing_dropoff").alias("invalid_reason"), (pt + timeout).alias("event_time"),
    )
    no_pickup = F.struct(
        F.col("trip_id"), null_i.alias("pickup_zone"), F.col("d.dropoff_zone").alias("dropoff_zone"),
        null_t.alias("pickup_datetime"), dt_.alias("dropoff_datetime"), null_d.alias("duration_seconds"),
        F.col("d.trip_distance").alias("trip_distance"), null_d.alias("passenger_count"),
        F.col("d.total_amount").alias("total_amount"), F.lit(False).alias("is_valid"),
        F.lit("missing_pickup").alias("invalid_reason"), (dt_ + timeout).alias("event_time"),
    )
    # release flags first: a scalar subquery may not sit inside the higher-order filter
    flagged = g.where("replaced_at is null").select("*", released(pt).alias("_rel_p"), released(dt_).alias("_rel_d"))
    rows = F.array(
        F.when(matched, trip),
        F.when(pt.isNotNull() & ~matched & F.col("_rel_p"), no_dropoff),
        F.when(dt_.isNotNull() & ~matched & F.col("_rel_d"), no_pickup),
    )
    return flagged.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


def join_trips(pickup_events: DataFrame, dropoff_events: DataFrame, rules: Rules = DEFAULT_RULES,
               close: str = "watermark") -> DataFrame:
    """Pickups ⟗ dropoffs on trip_id -> trips with duration rule and orphans."""
    return trips_from_pairs(pair_sides(pickup_events, dropoff_events, rules), rules, close)


def valid_trips(trips: DataFrame) -> DataFrame:
    """(V10)"""
    return trips.where(F.col("is_valid"))


def invalid_trips(trips: DataFrame) -> DataFrame:
    """(V10)"""
    return trips.where(~F.col("is_valid"))


def orphans(trips: DataFrame) -> DataFrame:
    """Trips missing one side."""
    return trips.where(F.col("invalid_reason").isin("missing_dropoff", "missing_pickup"))

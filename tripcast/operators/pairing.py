"""One pairing rule for repeated events of a trip id (J1.5), as windows over ordered events.

Events of a trip id are taken in time order (at the same time a pickup before a
dropoff, equal sides by content). An event waits for the next one: the other side within the
time limit completes a trip and both are used up; the same side within the limit
replaces it; otherwise it stays alone. So an event is paired with the next one if it
stands at an odd place of its run, where a run ends before an event that repeats its
predecessor's side or comes after the limit (gaps and islands).

A blank id may hold a third of all events. Events are therefore numbered per trip id
and block of time, so that no task sorts all events of an id; a second pass over one
row per block carries the place in a run that goes on from one block to the next.

Most trip ids have one event a side. These come from the co-group's counts as they
are; only the others are numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripcast.config import DEFAULT_RULES, Rules

BLOCK_SECONDS = 3600
PAIR_COLUMNS = ("trip_id", "p", "d", "replaced_at")


def repeats(cogrouped: DataFrame) -> Column:
    return (F.col("pickup_events") > 1) | (F.col("dropoff_events") > 1)


def single_pairs(cogrouped: DataFrame) -> DataFrame:
    """Pairs of the trip ids with at most one event a side."""
    return cogrouped.where(~repeats(cogrouped)).select("trip_id", "p", "d", F.lit(None).cast("timestamp").alias("replaced_at"))


def _us(t: Column) -> Column:
    return F.unix_micros(t)


def ordered_pairs(events: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """events(trip_id, p, d), one side null each, to pairs (trip_id, p, d, replaced_at).

    A pair has both sides, or one that found no counterpart; ``replaced_at`` is the time
    of the pickup that replaced this one. A replaced dropoff leaves no row.
    """
    limit = F.lit(rules.timeout_seconds * 1_000_000)

    def breaks(before: Column, after: Column) -> Column:
        return (before.side == after.side) | (_us(after.t) - _us(before.t) > limit)

    e = events.select("trip_id", F.struct(F.coalesce("p.t", "d.t").alias("t"), F.col("d").isNotNull().alias("side"), "p", "d").alias("e"))
    e = e.withColumn("block", F.floor(F.unix_seconds("e.t") / F.lit(BLOCK_SECONDS)))
    inside = Window.partitionBy("trip_id", "block").orderBy("e")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumns({"n": F.row_number().over(inside), "before": F.lag("e").over(inside), "after": F.lead("e").over(inside)})
    e = e.withColumn("opens", F.coalesce(breaks(F.col("before"), F.col("e")), F.lit(False)))
    e = e.withColumn("start", F.max(F.when(F.col("opens"), F.col("n"))).over(so_far))

    # one row per block: how far a run reaches into the next block
    blocks = e.groupBy("trip_id", "block").agg(F.count("*").alias("size"), F.min("e").alias("first"), F.max("e").alias("last"), F.max("start").alias("broke"))
    across = Window.partitionBy("trip_id").orderBy("block")
    blocks = blocks.withColumns({"before": F.lag(F.struct("last", "broke", "size")).over(across), "next": F.lead("first").over(across)})
    cut = F.coalesce(breaks(F.col("before.last"), F.col("first")), F.lit(True))
    blocks = blocks.withColumn("base", F.when(cut, F.lit(0)).otherwise(F.col("before.size") - F.coalesce("before.broke", F.lit(1)) + 1))
    blocks = blocks.withColumn("run", F.sum((cut | F.col("before.broke").isNotNull()).cast("int")).over(across))
    of_run = Window.partitionBy("trip_id", "run").orderBy("block")
    # the run's first block takes over its base, the blocks between are whole parts of the run
    blocks = blocks.withColumn("carried", F.first("base").over(of_run) + F.coalesce(
        F.sum("size").over(of_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    e = e.join(blocks.select("trip_id", "block", "carried", "next"), ["trip_id", "block"])
    place = F.when(F.col("start").isNull(), F.col("carried") + F.col("n")).otherwise(F.col("n") - F.col("start") + 1)
    odd = e.where(place % 2 == 1).withColumn("after", F.coalesce("after", "next"))
    met = F.col("after").isNotNull() & ~breaks(F.col("e"), F.col("after"))
    again = (F.col("e.side") == F.col("after.side")) & (_us(F.col("after.t")) - _us(F.col("e.t")) <= limit)
    out = odd.withColumns({"met": F.coalesce(met, F.lit(False)), "again": F.coalesce(again, F.lit(False))})
    out = out.where(~(F.col("again") & F.col("e.side")))
    return out.select("trip_id", F.when(F.col("met"), F.coalesce("e.p", "after.p")).otherwise(F.col("e.p")).alias("p"),
                      F.when(F.col("met"), F.coalesce("e.d", "after.d")).otherwise(F.col("e.d")).alias("d"),
                      F.when(F.col("again"), F.col("after.t")).alias("replaced_at"))


def repeated_pairs(cogrouped: DataFrame, events: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Pairs of the trip ids with more than one event on a side."""
    ids = cogrouped.where(repeats(cogrouped)).select("trip_id")
    return ordered_pairs(events.join(ids, "trip_id", "left_semi"), rules)


def pairs(cogrouped: DataFrame, events: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """All pairs of the co-grouped sides and the events they were made from."""
    return single_pairs(cogrouped).unionByName(repeated_pairs(cogrouped, events, rules))

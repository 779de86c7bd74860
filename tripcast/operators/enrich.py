"""Trip enrichment (J4, F5): dropoff borough lookup and time-of-day bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.functions.timefn import time_of_day
from tripcast.sources.zones import zone_lookup


def enrich_trips(trips: DataFrame, zones: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """trips + dropoff_borough (default "Unknown") + time_of_day of the dropoff.

    The zone dimension is a lookup table keyed by location_id; Spark
    broadcasts it while its size is under the threshold and shuffles
    both sides beyond.
    """
    lookup = zone_lookup(zones).select(
        F.col("location_id").alias("_zone_id"), F.col("borough").alias("_borough"))
    joined = trips.join(lookup, trips["dropoff_zone"] == lookup["_zone_id"], "left")
    return joined.select(
        *[F.col(c) for c in trips.columns],
        F.coalesce(F.col("_borough"), F.lit(rules.unknown_borough)).alias("dropoff_borough"),
        time_of_day(F.col("dropoff_datetime")).alias("time_of_day"),
    )

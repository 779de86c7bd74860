"""Batch cleaning of raw trip rows.

The reference validates row by row and inserts one row at a time; here the
first failing rule is one chained CASE over the whole table, zone
membership is two lookups into the set of valid zone ids (broadcast by
Spark while it is small), and the load summary is one rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripcast.config import DEFAULT_RULES, Rules
from tripcast.functions.numeric import truncate_int
from tripcast.functions.timefn import coerce_timestamp
from tripcast.sources.zones import valid_zone_ids

# Fixed rule names, in the order they are checked.
CLEANING_REASONS = ("missing_values", "time_order", "distance", "price", "passengers", "invalid_zones")


def _missing(name: str, dtype: str):
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if dtype in ("double", "float") else c.isNull()


def clean_trips(raw: DataFrame, zones: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """raw rows + pickup_ts, dropoff_ts (coerced, V2) + reason (NULL = accepted) (V1)."""
    ids = valid_zone_ids(zones)
    pick_ids = ids.select(F.col("location_id").alias("_pz_id"), F.lit(True).alias("_pz_ok"))
    drop_ids = ids.select(F.col("location_id").alias("_dz_id"), F.lit(True).alias("_dz_ok"))
    base = raw.select(
        *raw.columns,
        coerce_timestamp(F.col("pickup_datetime").cast("string")).alias("pickup_ts"),
        coerce_timestamp(F.col("dropoff_datetime").cast("string")).alias("dropoff_ts"),
        truncate_int(F.col("pickup_location_id")).alias("_pz"),
        truncate_int(F.col("dropoff_location_id")).alias("_dz"),
    )
    joined = (base.join(pick_ids, base["_pz"] == pick_ids["_pz_id"], "left")
              .join(drop_ids, base["_dz"] == drop_ids["_dz_id"], "left"))
    dtypes = dict(raw.dtypes)
    missing = (
        F.col("pickup_ts").isNull() | F.col("dropoff_ts").isNull()
        | _missing("passenger_count", dtypes["passenger_count"])
        | _missing("trip_distance", dtypes["trip_distance"])
        | _missing("total_amount", dtypes["total_amount"])
        | _missing("pickup_location_id", dtypes["pickup_location_id"])
        | _missing("dropoff_location_id", dtypes["dropoff_location_id"])
    )
    reason = (
        F.when(missing, F.lit("missing_values"))
        .when(F.col("pickup_ts") >= F.col("dropoff_ts"), F.lit("time_order"))
        .when(F.col("trip_distance") <= 0, F.lit("distance"))
        .when(F.col("total_amount") <= 0, F.lit("price"))
        .when(~F.col("passenger_count").between(1, rules.max_passengers), F.lit("passengers"))
        .when(F.col("_pz_ok").isNull() | F.col("_dz_ok").isNull(), F.lit("invalid_zones"))
    )
    return joined.select(*raw.columns, "pickup_ts", "dropoff_ts", reason.alias("reason"))


def accepted_trips(cleaned: DataFrame) -> DataFrame:
    """Accepted rows in the raw_trips shape, ints truncated (V3)."""
    return cleaned.where(F.col("reason").isNull()).select(
        F.col("pickup_ts").alias("pickup_datetime"),
        F.col("dropoff_ts").alias("dropoff_datetime"),
        truncate_int(F.col("pickup_location_id")).alias("pickup_zone"),
        truncate_int(F.col("dropoff_location_id")).alias("dropoff_zone"),
        truncate_int(F.col("passenger_count")).alias("passenger_count"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
    )


def load_summary(cleaned: DataFrame) -> DataFrame:
    """status (processed / inserted / rejected), reason, rows (V4).

    One rollup: the grand total is 'processed', accepted rows 'inserted',
    rejected rows in total and per reason 'rejected'.
    """
    status = F.when(F.col("reason").isNull(), F.lit("inserted")).otherwise(F.lit("rejected"))
    rolled = (cleaned.select(status.alias("status"), "reason")
              .rollup("status", "reason").agg(F.count(F.lit(1)).alias("rows"),
                                               F.grouping_id().alias("_gid")))
    return rolled.where(
        # drop the (inserted, NULL reason) detail row: it repeats the inserted subtotal
        ~((F.col("status") == "inserted") & (F.col("_gid") == 0))
    ).select(
        F.coalesce(F.col("status"), F.lit("processed")).alias("status"),
        F.col("reason"), F.col("rows").cast("bigint").alias("rows"),
    )


def counted(cleaned: DataFrame) -> tuple[DataFrame, Observation]:
    """cleaned with counters that fill while it is read, e.g. by the write of its accepted rows (V4)."""
    seen = Observation()
    per_reason = [F.count_if(F.col("reason") == r).alias(r) for r in CLEANING_REASONS]
    return cleaned.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("reason").isNull()).alias("inserted"), *per_reason), seen


def observed_summary(spark: SparkSession, seen: Observation) -> DataFrame:
    """The rows of load_summary from the counters of a finished read."""
    n = seen.get
    rows = [("processed", None, n["processed"]), ("inserted", None, n["inserted"]), ("rejected", None, n["processed"] - n["inserted"])]
    rows += [("rejected", r, n[r]) for r in CLEANING_REASONS if n[r]]
    return spark.createDataFrame([r for r in rows if r[0] == "processed" or r[2]], "status string, reason string, rows long")


def zone_semi(raw: DataFrame, zones: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows whose pickup and dropoff zone ids are both valid zones (J5, semi join)."""
    ids = valid_zone_ids(zones)
    pz = truncate_int(F.col("pickup_location_id"))
    dz = truncate_int(F.col("dropoff_location_id"))
    base = raw.withColumn("_pz", pz).withColumn("_dz", dz)
    out = base.join(ids, base["_pz"] == ids["location_id"], "left_semi")
    out = out.join(ids, out["_dz"] == ids["location_id"], "left_semi")
    return out.drop("_pz", "_dz")


def zone_anti(raw: DataFrame, zones: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows with at least one unknown (or missing) zone id (J5, anti join)."""
    ids = valid_zone_ids(zones)
    base = (raw.withColumn("_pz", truncate_int(F.col("pickup_location_id")))
            .withColumn("_dz", truncate_int(F.col("dropoff_location_id"))))
    p_ok = ids.select(F.col("location_id").alias("_p_id"), F.lit(True).alias("_p_ok"))
    d_ok = ids.select(F.col("location_id").alias("_d_id"), F.lit(True).alias("_d_ok"))
    j = base.join(p_ok, base["_pz"] == p_ok["_p_id"], "left").join(d_ok, base["_dz"] == d_ok["_d_id"], "left")
    return j.where(F.col("_p_ok").isNull() | F.col("_d_ok").isNull()).select(*raw.columns)

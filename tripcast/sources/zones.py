"""Zone dimension sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripcast.schemas import ZONES_CSV
from tripcast.sources.csv import by_header

# a null marker that never occurs in the file, so "N/A" and "" stay text
_NO_NULL_MARKER = "\u0000"


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with header LocationID,Borough,Zone,service_zone."""
    raw = (
        by_header(spark, path, ZONES_CSV)
        .option("nullValue", _NO_NULL_MARKER)
        .option("emptyValue", "")
        .csv(path)
    ).select(*ZONES_CSV.fieldNames())
    return raw.withColumnsRenamed(
        {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    )


def zones_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone dimension derived from the test tables: nations as zones, regions as boroughs."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Zone "), F.col("r_regionkey").cast("string")).alias("service_zone"),
    )


def zone_lookup(zones: DataFrame) -> DataFrame:
    """location_id -> borough, the two columns the enrichment needs."""
    return zones.select("location_id", "borough")


def valid_zone_ids(zones: DataFrame) -> DataFrame:
    """Set of valid zone ids."""
    return zones.select("location_id").where(F.col("location_id").isNotNull()).distinct()

"""CSV files whose columns are found by their header."""

from __future__ import annotations

from pyspark.sql import DataFrameReader, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def by_header(spark: SparkSession, path: str, schema: StructType) -> DataFrameReader:
    """A reader for files with the header of ``path``: known columns typed as in ``schema``, wherever they stand.

    A file whose header differs from the first one's makes the read fail, and so does a missing column when selected.
    """
    known = {f.name: f for f in schema.fields}
    header = spark.read.option("header", True).csv(path).columns
    fields = [known.get(c, StructField(c, StringType())) for c in header]
    return spark.read.schema(StructType(fields)).option("header", True).option("enforceSchema", False)

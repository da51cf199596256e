"""Lookup files (CSV) read with an explicit schema and no tolerance for bad rows.

``FAILFAST`` makes a row of the wrong shape an error instead of a null row;
literal ``N/A`` text stays text (only an empty field would be null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The zone lookup layout.
ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_lookup_csv(spark: SparkSession, path: str, schema: str = ZONE_SCHEMA) -> DataFrame:
    return (spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST")
            .option("enforceSchema", "false").csv(path))


def write_lookup_csv(df: DataFrame, path: str) -> None:
    """Writes a lookup table as headed CSV (small dimension tables only)."""
    df.write.mode("errorifexists").option("header", "true").csv(path)

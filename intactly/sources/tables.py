"""Strict Parquet scans of the input tables.

Every read goes through ``spark.read`` so Catalyst can prune columns and push
filters into the scan; corrupt or missing files raise instead of being skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables of the test data set.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

MONTH_FORMAT = "yyyy-MM"


def strict_reader(spark: SparkSession):
    return (spark.read.option("ignoreCorruptFiles", "false")
            .option("ignoreMissingFiles", "false")
            .option("mergeSchema", "false"))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Strict scan of one table (A1/A2: the URI may name any Hadoop file system); never shuffled here."""
    return strict_reader(spark).parquet(table_path(sf_dir, name))


def month_of(ts_col: str) -> F.Column:
    """Timestamp → month label ``YYYY-MM``."""
    return F.date_format(F.col(ts_col), MONTH_FORMAT)


def read_months(spark: SparkSession, path: str, months: Sequence[str]) -> DataFrame:
    """Month-restricted scan of a ``month=``-partitioned zone (A10).

    The filter is on the partition column, so Catalyst prunes whole
    directories before any file is opened.
    """
    return strict_reader(spark).parquet(path).where(F.col("month").isin(list(months)))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip-like fact: lineitem joined to its order, with a month label.

    A left join: a line whose order is missing is kept (its order columns are
    null) so validation can reject it with a reason instead of losing it.
    The join is on the order key; at scale both sides shuffle on it (or are
    read from tables bucketed by it) and AQE splits skewed keys.
    """
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders")
    return (li.join(od, li.l_orderkey == od.o_orderkey, "left")
            .withColumn("month", month_of("l_shipdate")))

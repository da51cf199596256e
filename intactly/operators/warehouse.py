"""Dimensional model: dimensions, role-playing lookups and the fact table.

Broadcasts are used only behind a size check (``checked_broadcast``): the
side is counted up to a bound with ``limit(bound + 1)``, which stops as soon
as the bound is exceeded; above it the join is left to AQE, which picks a
shuffle join and splits skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intactly.operators.ordered import numbered

UNKNOWN_KEY = -1

# Size bound for broadcasting a base dimension table.
NATION_BOUND = 1_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops reading past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows) else df


def geography(nation: DataFrame, region: DataFrame) -> tuple[DataFrame, bool]:
    """nation → region snowflake collapsed to one small dimension.

    Returns the dimension and whether it may be broadcast: both base tables
    are checked once, and the joined result is bounded by their product.
    """
    small = fits(nation, NATION_BOUND) and fits(region, NATION_BOUND)
    side = F.broadcast(region) if small else region
    geo = (nation.join(side, nation.n_regionkey == region.r_regionkey, "left")
           .select("n_nationkey", "n_name", F.coalesce("r_name", F.lit("UNKNOWN")).alias("r_name")))
    return geo, small


def role(dim: DataFrame, prefix: str) -> DataFrame:
    """The same dimension under another role (pick-up vs drop-off, customer vs supplier)."""
    return dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])


def date_dimension(dates: DataFrame, col: str = "d") -> DataFrame:
    """Calendar rows in use, with a surrogate key in date order (bounded: one row per day)."""
    days = dates.select(F.to_date(col).alias("date")).distinct()
    return days.select(
        F.dense_rank().over(Window.orderBy("date")).alias("date_sk"),
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
        (F.weekday("date") + 1).alias("iso_dow"),
        (F.weekday("date") >= 5).alias("is_weekend"))


def surrogate(dim: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """Dense surrogate keys over a bounded dimension's natural key (1-based)."""
    order = [F.col(c) for c in natural]
    return dim.select(*natural).distinct().withColumn(name, F.dense_rank().over(Window.orderBy(*order)))


def key_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored keys of a dimension; empty before its first load."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def assign_keys(members: DataFrame, natural: Sequence[str], path: str, name: str) -> DataFrame:
    """Natural key → surrogate key for good: members without one get the next numbers and are stored.

    Keys given once never change, whatever is inserted before or between them
    later. New members are numbered in natural order by range partitions with
    carried counts, so neither a global window nor a single task sees them
    all. Null is a member like others. One load at a time may append to
    ``path``; a rerun finds its members there and adds nothing.
    """
    spark = members.sparkSession
    wanted = members.select(*natural).distinct()
    schema = T.StructType([*wanted.schema.fields, T.StructField(name, T.LongType())])
    known = key_table(spark, path, schema)
    seen = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural])
    last = known.agg(F.max(name)).first()[0] or 0
    fresh = numbered(wanted.join(seen, same, "left_anti"), [F.col(c).asc_nulls_first() for c in natural], "_number")
    fresh = fresh.select(*natural, (F.col("_number") + last).alias(name))
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(path)
    return key_table(spark, path, schema)


def lookup(fact: DataFrame, dim: DataFrame, on: Column | Sequence[str], key: str,
           bound: int | None = None) -> DataFrame:
    """Left join to a dimension; a missing member maps to the unknown key −1.

    With ``bound`` the dimension is broadcast behind ``checked_broadcast``;
    without it (dimensions derived from the facts) the join is left to AQE,
    which broadcasts only after measuring the materialised side at run time.
    """
    side = checked_broadcast(dim, bound) if bound is not None else dim
    joined = fact.join(side, on, "left")
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY)))

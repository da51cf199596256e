"""Indicator helpers over aggregated data.

Windows here always run on already-aggregated rows (months × members), whose
size is bounded by the calendar and the dimension, never on raw facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL = "ALL"


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Top-k rows; planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def rank_within(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(group).orderBy(*order)))


def units(amount: Column, scale: int) -> Column:
    """Exact integer units of a decimal amount with the given scale."""
    return (amount * F.lit(10 ** scale)).cast("decimal(38,0)")


def share_trend(df: DataFrame, period: str, member: str, amount: str, scale: int) -> DataFrame:
    """Share of period (parts per million), previous period and 3-period moving mean.

    Integer arithmetic on exact units keeps the result independent of
    floating-point order; ``div`` is integral division.
    """
    last3 = (f"OVER (PARTITION BY {member} ORDER BY {period} "
             f"ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
    series = Window.partitionBy(member).orderBy(period)
    return (df.withColumn("_u", units(F.col(amount), scale))
            .withColumn("share_ppm",
                        F.expr(f"(_u * 1000000) div sum(_u) OVER (PARTITION BY {period})"))
            .withColumn(f"prev_{amount}", F.lag(amount).over(series))
            .withColumn("ma3_units", F.expr(f"sum(_u) {last3} div count(1) {last3}"))
            .drop("_u"))

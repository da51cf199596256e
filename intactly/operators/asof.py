"""Point-in-time features: for each row the newest feature known at its time (L1).

Both sides are united, sorted by key and time with features before the rows
of the same moment, and the last feature is carried forward. So nothing
that is dated after a row can reach it, a key of any size is spread over
ranges, and no pairs of rows and features are ever made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intactly.operators.ordered import carried_forward


def as_of(rows: DataFrame, features: DataFrame, key: str, row_time: str, feature_time: str,
          values: Sequence[str], tie: Sequence[str] = (), within: str | None = None) -> DataFrame:
    """``rows`` with ``feature_time`` and ``values`` of the newest feature of the key that is not dated later.

    Both sides have the column ``key``; null keys have no features. Of
    features of one moment the one highest in ``tie`` wins. ``within`` (an
    interval, such as '7 days') makes older features count as none. Rows
    without a time have no features; features without one are never used.
    """
    taken = [feature_time, *values]
    row = F.struct(*rows.columns)
    feature = F.struct(*taken)
    order = F.struct(*tie) if tie else F.struct(F.lit(0))
    kind_r, kind_f, kind_o = (T.simpleString() for T in (rows.select(row.alias("x")).schema["x"].dataType,
                                                          features.select(feature.alias("x")).schema["x"].dataType,
                                                          features.select(order.alias("x")).schema["x"].dataType))
    left = rows.select(F.col(key).alias("_key"), F.col(row_time).alias("_time"), F.lit(1).alias("_side"),
                       F.lit(None).cast(kind_o).alias("_tie"), row.alias("_row"), F.lit(None).cast(kind_f).alias("_feature"))
    right = (features.where(F.col(key).isNotNull() & F.col(feature_time).isNotNull())
             .select(F.col(key).alias("_key"), F.col(feature_time).alias("_time"), F.lit(0).alias("_side"),
                     order.alias("_tie"), F.lit(None).cast(kind_r).alias("_row"), feature.alias("_feature")))
    # Rows without a time come first, where no feature stands before them.
    known = carried_forward(left.unionByName(right), "_key", [
        F.col("_time").asc_nulls_first(), F.col("_side"), F.col("_tie").asc_nulls_first()], "_feature")
    found = known.where(F.col("_side") == 1)
    newest = F.col("_last")
    if within:
        newest = F.when(F.col(f"_last.{feature_time}") >= F.col("_time") - F.expr(f"INTERVAL {within}"), newest)
    return (found.withColumn("_last", newest)
            .select("_row.*", *[F.col(f"_last.{c}").alias(f"feature_{c}" if c in rows.columns else c) for c in taken]))

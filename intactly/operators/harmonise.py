"""Schema harmonisation across monthly inputs whose columns drift (H1, H2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def casefold(df: DataFrame) -> DataFrame:
    """Lower-cases column names; two names that collide after folding are an error."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"columns collide after case folding: {df.columns}")
    return df.toDF(*lowered)


def harmonise(frames: list[DataFrame]) -> DataFrame:
    """Union by (case-folded) name; columns missing from a month become null."""
    folded = [casefold(f) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), folded)


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A DataFrame's schema as rows (name, folded name, type); metadata only."""
    rows = [(f.name, f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "name string, column_name string, data_type string")


def value_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column in one aggregation pass: (name, values)."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "name string, values bigint")
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (name, values)")


def schema_drift(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Column-level difference between two inputs, matched case-insensitively.

    Each column carries its type and its number of non-null values on each
    side, so a column that exists but arrives empty is visible too.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        rows = schema_rows(spark, df).join(value_counts(df), "name", "left")
        return rows.select("column_name", F.col("name").alias(f"{tag}_name"),
                           F.col("data_type").alias(f"{tag}_type"), F.col("values").alias(f"{tag}_values"))
    change = (F.when(F.col("left_name").isNull(), F.lit("only_right"))
              .when(F.col("right_name").isNull(), F.lit("only_left"))
              .when(F.col("left_type") != F.col("right_type"), F.lit("type_changed"))
              .when(F.col("left_name") != F.col("right_name"), F.lit("case_changed"))
              .otherwise(F.lit("same")))
    return side(left, "left").join(side(right, "right"), "column_name", "full_outer").withColumn("change", change)

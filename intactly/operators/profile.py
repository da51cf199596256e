"""Column and lookup profiles computed in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup_profile(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows, distinct keys, null keys, blank names, key range and a duplicate flag."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col(name).isNull() | (F.trim(F.col(name)) == "")).alias("blank_names"),
        F.min(key).cast("bigint").alias("min_key"),
        F.max(key).cast("bigint").alias("max_key"),
        (F.count_distinct(key) != F.count(key)).alias("has_duplicates"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls, blank strings, distinct non-null values.

    All columns are profiled in a single aggregation. Distinct counts of
    strings are taken over their SHA-256, so the shuffle carries 32-byte
    digests instead of whole texts.
    """
    aggs, names = [], []
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        is_text = isinstance(field.dataType, T.StringType)
        blank = F.count_if(F.trim(c) == "") if is_text else F.lit(0).cast("bigint")
        distinct_of = F.sha2(c, 256) if is_text else c
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), blank.alias(f"b{i}"),
                 F.count_distinct(distinct_of).alias(f"d{i}")]
        names.append(field.name)
    wide = df.agg(*aggs)
    stacked = ", ".join(f"'{n}', n{i}, b{i}, d{i}" for i, n in enumerate(names))
    return wide.selectExpr(
        f"stack({len(names)}, {stacked}) AS (column_name, nulls, blanks, distinct_values)")


#: Size of the sketches: 2**HLL_BITS registers (relative error near 1.04 / 2**(HLL_BITS / 2)); KLL_K bounds the rank error
#: of quantiles (1.33 % at 200).
HLL_BITS, KLL_K = 12, 200
PART_FIELDS = ("column_name string, rows bigint, nulls bigint, blanks bigint, distinct_sketch binary, "
               "value_sketch binary")


def _sketched(field: T.StructField) -> Column:
    """The column as a distinct sketch takes it: integers and text as they are, anything else as text."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return c
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(c)
    return c.cast("string")


def profile_parts(df: DataFrame, by: str) -> DataFrame:
    """``by`` and ``PART_FIELDS``: each group's profile of every other column, in a form that can be merged.

    One aggregation without an Expand: counts are exact, distinct values and
    the distribution of numbers are kept as sketches.
    """
    fields = [f for f in df.schema.fields if f.name != by]
    aggs, stacked = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text, number = isinstance(f.dataType, T.StringType), isinstance(f.dataType, T.NumericType)
        aggs += [F.count_if(c.isNull()).alias(f"_n{i}"),
                 (F.count_if(F.trim(c) == "") if text else F.lit(0).cast("bigint")).alias(f"_b{i}"),
                 F.hll_sketch_agg(_sketched(f), F.lit(HLL_BITS)).alias(f"_d{i}"),
                 (F.kll_sketch_agg_double(c.cast("double"), KLL_K) if number else F.lit(None).cast("binary")).alias(f"_v{i}")]
        name = f.name.replace("'", "\\'")
        stacked.append(f"'{name}', _rows, _n{i}, _b{i}, _d{i}, _v{i}")
    wide = df.groupBy(by).agg(*aggs)
    names = ", ".join(c.split()[0] for c in PART_FIELDS.split(", "))
    return wide.selectExpr(f"`{by}`", f"stack({len(fields)}, {', '.join(stacked)}) AS ({names})")


def store_profiles(df: DataFrame, by: str, path: str) -> None:
    """Writes the profile of each group in ``df``; a group's earlier profile is replaced, others are not touched."""
    (profile_parts(df, by).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .partitionBy(by).parquet(path))


def read_profiles(spark: SparkSession, path: str, by: str) -> DataFrame:
    return spark.read.schema(f"{PART_FIELDS}, `{by}` string").parquet(path)


def merged_profile(parts: DataFrame, ranks: tuple[float, ...] = (0.5,)) -> DataFrame:
    """column_name, groups, rows, nulls, blanks, distinct (estimated) and quantiles at ``ranks``, from stored profiles.

    Nothing but the stored parts is read. Columns that hold no numbers have no quantiles.
    """
    merged = parts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("groups"), *[F.sum(c).alias(c) for c in ("rows", "nulls", "blanks")],
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.kll_merge_agg_double("value_sketch", KLL_K).alias("_values"))
    some = F.coalesce(F.kll_sketch_get_n_double("_values"), F.lit(0)) > 0
    quantiles = F.when(some, F.kll_sketch_get_quantile_double("_values", F.array(*[F.lit(float(r)) for r in ranks])))
    return merged.withColumn("quantiles", quantiles).drop("_values")

"""Where two copies of a table differ, by a tree of fingerprints over key ranges.

A copy is stored in folders of key ranges (``2**leaf_bits`` keys each, cut at
the same keys in every copy) with a tree beside it: one row per range with
its row count, fingerprint and folder, and above it one row per
``2**fan_bits`` ranges, up to the top. Fingerprints are sums, so a node's is
added up from its children's and the data is read once.

Up to ``FOLDERS`` ranges have a folder each. Of more, neighbours share one,
sorted by range in its files, so that the number of files to write, list and
open does not grow with the number of ranges.

Two copies are compared from the top: only children of nodes that differ are
looked at on the next level, and only folders with ranges that differ at the
bottom are read at all; the others' files are never opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intactly.functions import fingerprint as fp
from intactly.operators.ordered import staged

#: A folder is named by RANGE, the lowest range it may hold; its rows have their own range in LEAF.
RANGE, LEAF, FOLDER, LEVEL, NODE = "_range", "_leaf", "folder", "level", "node"
#: Keys of one range, and ranges under one node, as powers of two.
LEAF_BITS, FAN_BITS = 16, 4
#: Folders of one copy at most.
FOLDERS = 256
#: Ranges whose numbers are written into the scan's filter; more are joined.
LISTED_RANGES = 10_000
#: The range of rows without a key.
NO_KEY = -(1 << 62)


def range_of(key: Column, leaf_bits: int = LEAF_BITS) -> Column:
    """Number of the key's range; keys are integral, negative ones too."""
    return F.coalesce(F.shiftright(key.cast("bigint"), leaf_bits), F.lit(NO_KEY))


def write_copy(df: DataFrame, key: str, root: str, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> None:
    """Writes ``df`` by key ranges under ``root/data`` and its tree under ``root/tree`` (both must not exist yet).

    The tree is made from what was written, read back. A folder with very many
    rows is split over several files.
    """
    spark = df.sparkSession
    leaf = range_of(F.col(key), leaf_bits)
    bits = _folder_bits(df.select(leaf.alias(LEAF)))
    (df.withColumn(LEAF, leaf).withColumn(RANGE, _folder(F.col(LEAF), bits)).hint("rebalance", RANGE)
     .sortWithinPartitions(RANGE, LEAF)
     .write.mode("errorifexists").partitionBy(RANGE).parquet(f"{root}/data"))
    data = stored(spark, root, df)
    level = data.groupBy(F.col(LEAF).alias(NODE)).agg(*fp.fingerprint_aggs(df), F.min(RANGE).alias(FOLDER))
    number = 0
    while True:
        level.write.mode("errorifexists").parquet(f"{root}/tree/{LEVEL}={number}")
        below = spark.read.schema(level.schema).parquet(f"{root}/tree/{LEVEL}={number}")
        if below.count() <= 1 << fan_bits:
            return
        level = below.groupBy(_above(fan_bits).alias(NODE)).agg(
            F.sum("rows").alias("rows"), fp.added(F.col("fingerprint")).alias("fingerprint"),
            F.lit(None).cast("bigint").alias(FOLDER))
        number += 1


def _folder(leaf: Column, bits: int) -> Column:
    return F.shiftleft(F.shiftright(leaf, bits), bits)


def _folder_bits(leaves: DataFrame) -> int:
    """Smallest power of two of ranges to a folder that makes ``FOLDERS`` folders at most.

    A bit more halves the number of folders at best, so no smaller power than the next one tried would do.
    """
    ranges = staged(leaves.distinct(), "ranges")
    bits, folders = 0, ranges.count()
    while folders > FOLDERS:
        bits += (-(-folders // FOLDERS) - 1).bit_length()
        folders = ranges.select(_folder(F.col(LEAF), bits)).distinct().count()
    return bits


def _above(fan_bits: int) -> Column:
    return F.when(F.col(NODE) == NO_KEY, F.lit(NO_KEY)).otherwise(F.shiftright(NODE, fan_bits))


def stored(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The rows of a copy with their range and folder, in the columns of ``like``."""
    schema = like.drop(LEAF, RANGE).schema.add(LEAF, T.LongType()).add(RANGE, T.LongType())
    return spark.read.schema(schema).parquet(f"{root}/data")


def tree(spark: SparkSession, root: str) -> DataFrame:
    """level, node, rows, fingerprint and (on level 0) folder of every node."""
    return (spark.read.schema(f"{NODE} bigint, rows bigint, fingerprint string, {FOLDER} bigint, {LEVEL} int")
            .parquet(f"{root}/tree"))


def differing_ranges(spark: SparkSession, a: str, b: str, fan_bits: int = FAN_BITS) -> DataFrame:
    """``_range`` of the key ranges in which two copies differ, found level by level."""
    trees = [tree(spark, root) for root in (a, b)]
    top = min(t.agg(F.max(LEVEL)).first()[0] or 0 for t in trees)
    suspects = None
    for level in range(top, -1, -1):
        sides = []
        for t, tag in zip(trees, "ab", strict=True):
            side = t.where(F.col(LEVEL) == level)
            if suspects is not None:
                side = side.join(suspects.select(F.col(NODE).alias("_up")), _above(fan_bits) == F.col("_up"), "left_semi")
            sides.append(side.select(NODE, F.struct("rows", "fingerprint").alias(tag)))
        differ = sides[0].join(sides[1], NODE, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(NODE)
        suspects = staged(differ, "differing")
        if suspects.isEmpty():
            break
    return suspects.select(F.col(NODE).alias(RANGE))


def rows_in(spark: SparkSession, root: str, like: DataFrame, ranges: DataFrame) -> DataFrame:
    """A copy's rows of some ranges; folders without any of them are pruned before any file is opened."""
    data = stored(spark, root, like)
    bottom = tree(spark, root).where(F.col(LEVEL) == 0)
    folders = [r[FOLDER] for r in bottom.join(ranges, F.col(NODE) == F.col(RANGE), "left_semi")
               .select(FOLDER).distinct().collect()]
    if not folders:
        return data.where(F.lit(False))
    data = data.where(F.col(RANGE).isin(folders))
    listed = [r[RANGE] for r in ranges.limit(LISTED_RANGES + 1).collect()]
    if len(listed) <= LISTED_RANGES:
        return data.where(F.col(LEAF).isin(listed))
    return data.join(ranges.select(F.col(RANGE).alias(LEAF)), LEAF, "left_semi")


def changed_keys(like: DataFrame, key: str, a: str, b: str, columns: Sequence[str] | None = None,
                 fan_bits: int = FAN_BITS) -> DataFrame:
    """key and change (added, removed or changed from ``a`` to ``b``) of every key that differs.

    A key's rows are compared as a multiset over ``columns`` (all by default),
    which are those of ``like``; the null key is a key, too.
    """
    spark = like.sparkSession
    ranges = differing_ranges(spark, a, b, fan_bits)
    names = list(columns or like.columns)
    sides = []
    for root, tag in ((a, "a"), (b, "b")):
        rows = rows_in(spark, root, like, ranges)
        aggs = F.struct(F.count(F.lit(1)).alias("rows"), fp.digest_sum(fp.canonical_row(like, names)).alias("sum"))
        sides.append(rows.groupBy(F.col(key).alias(f"_{tag}")).agg(aggs.alias(tag)))
    both = sides[0].join(sides[1], F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
    change = (F.when(F.col("a").isNull(), F.lit("added")).when(F.col("b").isNull(), F.lit("removed"))
              .when(~F.col("a").eqNullSafe(F.col("b")), F.lit("changed")))
    return both.select(F.coalesce("_a", "_b").alias(key), change.alias("change")).where("change IS NOT NULL")

"""A reference descriptor's ordered file list against the files that are staged.

The list is exploded with its positions and joined both ways: entries
without a file, files without an entry, and entries that stand where the
expected order has another one are statuses of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Statuses, in order of precedence.
STATUSES = ("surplus", "missing", "repeated", "unexpected", "reordered", "changed_size", "changed_digest", "accepted")


def entries(descriptor: DataFrame) -> DataFrame:
    """snapshot_id, position (from 0) and the fields of every listed file; an empty list has one row without a name."""
    listed = descriptor.select(F.col("snapshotId").alias("snapshot_id"), F.posexplode_outer("files").alias("position", "f"))
    return listed.select("snapshot_id", "position", F.col("f.filename").alias("filename"),
                         F.col("f.sourceUrl").alias("source_url"), F.col("f.bytes").alias("bytes"),
                         F.col("f.sha256").alias("sha256"), F.col("f.revision").alias("revision"))


def matched(descriptor: DataFrame, files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """filename, position, expected_position and status of every listed, staged or expected file.

    ``files``: filename, bytes and sha256 of what is staged. ``expected``
    names the files in the order the descriptor must list them. A name that
    is listed twice is repeated wherever it stands.
    """
    spark = descriptor.sparkSession
    listed = entries(descriptor).where("filename IS NOT NULL").select(
        "filename", "position", F.col("bytes").alias("rec_bytes"), F.col("sha256").alias("rec_sha256"))
    copies = listed.groupBy("filename").agg(F.count(F.lit(1)).alias("copies"))
    order = spark.createDataFrame(list(enumerate(expected)), "expected_position int, filename string")
    staged = files.groupBy("filename").agg(F.min(F.struct("bytes", "sha256")).alias("s"))
    every = (listed.join(copies, "filename").join(staged, "filename", "full_outer").join(order, "filename", "full_outer"))
    status = (F.when(F.col("position").isNull() & F.col("s").isNotNull(), F.lit("surplus"))
              .when(F.col("position").isNull() | F.col("s").isNull(), F.lit("missing"))
              .when(F.col("copies") > 1, F.lit("repeated"))
              .when(F.col("expected_position").isNull(), F.lit("unexpected"))
              .when(F.col("position") != F.col("expected_position"), F.lit("reordered"))
              .when(~F.col("s.bytes").eqNullSafe(F.col("rec_bytes")), F.lit("changed_size"))
              .when(~F.col("s.sha256").eqNullSafe(F.col("rec_sha256")), F.lit("changed_digest"))
              .otherwise(F.lit("accepted")))
    return every.select("filename", "position", "expected_position", status.alias("status"))

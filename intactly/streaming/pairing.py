"""Data files and their sidecars, arriving in any order, paired by a stream-stream join.

Both arrival logs are streams with a watermark. A full outer join on the key
holds whichever half came first in keyed state until the other arrives, at
most ``wait`` apart in event time; a half that stayed alone is reported once
the watermark says that its partner can no longer come, and its state is
dropped. So state is bounded by what arrives within ``wait`` and ``lateness``.

Each micro-batch is evaluated once, into the shared folder, and its verdicts
are written under the stream's id and the epoch: a replayed epoch replaces
its own output. A digest that an earlier epoch took in is a duplicate,
whatever its name.

A heartbeat is an arrival without a key: it moves the watermark on when
nothing else arrives, and is no file.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.operators.ordered import staged

# Columns of the two arrival logs and of the verdicts, and the verdicts.
DATA_SCHEMA = "key string, sha256 string, arrived_at timestamp"
SIDE_SCHEMA = "key string, rec_sha256 string, arrived_at timestamp"
VERDICT_SCHEMA = "key string, sha256 string, rec_sha256 string, status string, stream string, epoch bigint"
INGESTED, DUPLICATE, MISMATCH = "ingested", "duplicate", "digest_mismatch"
DATA_ONLY, SIDECAR_ONLY = "data_only", "sidecar_only"
#: How late an arrival may be logged, and how far apart the halves of a pair may be.
LATENESS, WAIT = "1 hour", "2 hours"
MAX_FILES = 64


def paired_arrivals(data: DataFrame, sidecars: DataFrame, lateness: str = LATENESS, wait: str = WAIT) -> DataFrame:
    """key, sha256 and rec_sha256 of pairs and of halves left alone, from two streams of arrivals."""
    d = data.select(F.col("key").alias("data_key"), "sha256", F.col("arrived_at").alias("data_at")).withWatermark(
        "data_at", lateness)
    s = sidecars.select(F.col("key").alias("side_key"), "rec_sha256", F.col("arrived_at").alias("side_at")).withWatermark(
        "side_at", lateness)
    near = F.expr(f"side_at BETWEEN data_at - INTERVAL {wait} AND data_at + INTERVAL {wait}")
    return d.join(s, (F.col("data_key") == F.col("side_key")) & near, "full_outer").select(
        F.coalesce("data_key", "side_key").alias("key"), "sha256", "rec_sha256",
        F.col("data_key").isNotNull().alias("has_data"), F.col("side_key").isNotNull().alias("has_sidecar"))


def verdicts(spark: SparkSession, out_root: str) -> DataFrame:
    """All verdicts so far: key, sha256, rec_sha256, status, stream and epoch."""
    try:
        return spark.read.schema(VERDICT_SCHEMA).parquet(out_root)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERDICT_SCHEMA)


def judged(halves: DataFrame, earlier: DataFrame) -> DataFrame:
    """key, sha256, rec_sha256 and status of one epoch's pairs and halves, given the verdicts before it.

    Of several names with one new digest the first by name is ingested.
    Repeated arrivals of a pair count once.
    """
    rows = halves.where("key IS NOT NULL").distinct()
    whole = F.col("has_data") & F.col("has_sidecar")
    agrees = whole & F.coalesce(F.col("sha256") == F.col("rec_sha256"), F.lit(False))
    taken = earlier.where(F.col("status") == INGESTED).select("sha256").distinct().withColumn("_taken", F.lit(True))
    first = rows.where(agrees).groupBy("sha256").agg(F.min("key").alias("_first"))
    status = (F.when(~F.col("has_sidecar"), F.lit(DATA_ONLY)).when(~F.col("has_data"), F.lit(SIDECAR_ONLY))
              .when(~agrees, F.lit(MISMATCH))
              .when(F.col("_taken").isNotNull() | (F.col("key") != F.col("_first")), F.lit(DUPLICATE))
              .otherwise(F.lit(INGESTED)))
    return (rows.join(first, "sha256", "left").join(taken, "sha256", "left")
            .select("key", "sha256", "rec_sha256", status.alias("status")))


def pair_available(spark: SparkSession, data_landing: str, side_landing: str, out_root: str, checkpoint: str,
                   lateness: str = LATENESS, wait: str = WAIT, max_files: int = MAX_FILES) -> int:
    """Pairs what has landed since the last run; returns the number of micro-batches."""
    seen: list[int] = []

    def per_batch(batch: DataFrame, epoch: int) -> None:
        # The stream's own id: a new checkpoint counts epochs from 0 again.
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        halves = staged(batch, "pairs")
        own = (F.col("stream") == stream) & (F.col("epoch") >= epoch)
        judged(halves, verdicts(spark, out_root).where(~own)).write.mode("overwrite").parquet(
            f"{out_root.rstrip('/')}/stream={stream}/epoch={epoch}")
        seen.append(epoch)

    def landed(path: str, schema: str) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)

    query = (paired_arrivals(landed(data_landing, DATA_SCHEMA), landed(side_landing, SIDE_SCHEMA), lateness, wait)
             .writeStream.foreachBatch(per_batch).outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(seen)

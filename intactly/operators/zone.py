"""Month-partitioned cleaned zone with commit rows.

Layout under ``root``::

    data/batch=<id>/month=YYYY-MM/part-*.parquet   written by executors
    _commits/part-*.parquet                       one row per (month, batch)

A batch becomes visible only after its commit row is appended, so a job
that dies mid-write leaves nothing readers can see. Re-running a month
writes a new batch and commits it; readers take the latest committed batch
per month, so a rerun never duplicates rows and earlier batches stay as
history. A batch is a folder: writing one and reading it back lists nothing
else, and readers open only folders that commit rows name. Dynamic partition overwrite (``write_months``) is the simpler
alternative when the storage gives atomic directory replacement.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import fingerprint as fp
from intactly.operators import history

COMMIT_SCHEMA = ("month string, batch string, rows bigint, fingerprint string, "
                 "committed_at timestamp")


def _balanced(df: DataFrame, cols: list[str]) -> DataFrame:
    """Groups rows of a partition value into few files without one task per value.

    The ``rebalance`` hint shuffles by the partition columns and lets AQE split
    a large value over several tasks and merge small ones, so a month holding
    a third of the data is still written in parallel.
    """
    return df.hint("rebalance", *cols)


def write_months(df: DataFrame, path: str) -> None:
    """Replaces exactly the months present in ``df`` (dynamic partition overwrite)."""
    (_balanced(df, ["month"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def _folder(root: str, batch: str) -> str:
    return f"{root}/data/batch={batch}"


def _written(spark: SparkSession, df: DataFrame, root: str, batch: str, cols: list[str]) -> DataFrame:
    """Writes a batch's folder (in place of an earlier attempt's); rows and fingerprint per month, read back."""
    _balanced(df, ["month"]).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "month").parquet(_folder(root, batch))
    # The columns of the partition are last when read.
    schema = df.select(*[c for c in df.columns if c != "month"], F.col("month").cast("string")).schema
    written = spark.read.schema(schema).parquet(_folder(root, batch))
    return written.groupBy("month").agg(*fp.fingerprint_aggs(written, cols))


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """All commit rows; none before the first commit. Only a missing folder counts as that."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/_commits")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def _rows_of(spark: SparkSession, root: str, heads: DataFrame, schema: str | None = None) -> DataFrame:
    """Rows of committed (month, batch) pairs; only their batches' folders are listed.

    The names of these batches come to the driver, as the paths of any scan
    do. A zone whose batches are all empty needs ``schema``.
    """
    names = [r["batch"] for r in heads.where("rows > 0").select("batch").distinct().collect()]
    shown = names or [r["batch"] for r in _commits(spark, root).where("rows > 0").select("batch").limit(1).collect()]
    if not shown:
        if schema is None:
            raise ValueError(f"no rows were ever committed under {root}: give a schema")
        return spark.createDataFrame([], schema)
    data = spark.read.option("basePath", f"{root}/data").parquet(*[_folder(root, b) for b in shown])
    data = data.select(*[c for c in data.columns if c not in ("month", "batch")], "month", "batch")
    return _semi_null_safe(data, heads.select("month", "batch"))


def write_batch(spark: SparkSession, df: DataFrame, root: str,
                fingerprint_cols: list[str] | None = None, months: DataFrame | None = None) -> str:
    """Writes ``df`` (with a ``month`` column) as a new batch, then commits it per month.

    ``months`` (a one-column frame) names every month the run covers; each
    gets a commit row even when it wrote no rows, so a re-run that leaves a
    month empty (say, no rejects any more) hides that month's older rows.
    Commit rows count and fingerprint what was written, read back.
    """
    batch = "b" + uuid.uuid4().hex  # never inferred as a number
    cols = fingerprint_cols or [c for c in df.columns if c != "month"]
    stats = _written(spark, df, root, batch, cols)
    if months is not None:
        m = months.select(F.col("month").alias("_m")).distinct()
        stats = (m.join(stats, m["_m"].eqNullSafe(stats["month"]), "left")
                 .select(F.col("_m").alias("month"), F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
                         F.coalesce("fingerprint", F.lit(fp.ZERO)).alias("fingerprint")))
    (stats.withColumn("batch", F.lit(batch)).withColumn("committed_at", F.current_timestamp())
     .select("month", "batch", "rows", "fingerprint", "committed_at")
     .write.mode("append").parquet(f"{root}/_commits"))
    return batch


def committed(spark: SparkSession, root: str) -> DataFrame:
    """Latest committed batch per month."""
    latest = history.latest_version(_commits(spark, root), "month", "committed_at",
                                    ["batch", "rows", "fingerprint"])
    return latest.drop("versions")


def _semi_null_safe(data: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of committed (month, batch) pairs; a null month (no ship date) is a month too."""
    h = heads.select(F.col("month").alias("_m"), F.col("batch").alias("_b"))
    return data.join(h, data["month"].eqNullSafe(h["_m"]) & (data["batch"] == h["_b"]), "left_semi")


def read_committed(spark: SparkSession, root: str, months: list[str] | None = None,
                   schema: str | None = None) -> DataFrame:
    """Zone rows of the latest committed batch of each month; uncommitted data is invisible.

    With ``months`` only those partitions are listed and read (A10): the
    filter is on the partition column, so whole directories are pruned.
    ``schema`` (with ``month`` and ``batch``) lets a zone that never received
    a row read as an empty table.
    """
    heads = committed(spark, root)
    if months is not None:
        heads = heads.where(F.col("month").isin(list(months)))
    rows = _rows_of(spark, root, heads, schema)
    return rows if months is None else rows.where(F.col("month").isin(list(months)))


def write_epoch(spark: SparkSession, df: DataFrame, root: str, epoch_id: int,
                fingerprint_cols: list[str] | None = None, stream: str = "") -> None:
    """Idempotent write of one stream micro-batch as batch ``e<epoch>`` of the stream named ``stream``.

    ``stream`` tells the epochs of different streams (or of one begun anew) apart: each counts from 0.

    A replayed epoch (after a failure) replaces only its own ``batch=e<epoch>...``
    folder, then commits again; readers de-duplicate commit rows, so a replay
    never doubles data.
    """
    if df.isEmpty():  # an empty micro-batch branch writes and commits nothing
        return
    batch = f"e{epoch_id:012d}{stream}"
    cols = fingerprint_cols or [c for c in df.columns if c != "month"]
    (_written(spark, df, root, batch, cols).withColumn("batch", F.lit(batch))
     .withColumn("committed_at", F.current_timestamp())
     .select("month", "batch", "rows", "fingerprint", "committed_at")
     .write.mode("append").parquet(f"{root}/_commits"))


def read_all_committed(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every committed batch (append-style zones fed by a stream)."""
    pairs = _commits(spark, root).groupBy("month", "batch").agg(F.max("rows").alias("rows"))
    return _rows_of(spark, root, pairs)

"""Create-only publication with read-back verification, gate and receipt (M3).

Outcomes are computed from keys and digests, never from control flow, so a
retried or repeated run reaches the same answer:

* key absent in the target            → write, read back, ``uploaded``
* present, same size and digest       → ``reused`` (nothing written)
* present, different size             → ``conflict_size`` (never overwritten)
* present, same size, different digest → ``conflict_digest``

The row path appends only the ``left_anti`` creates, then re-reads the
target and joins it back to the manifest, so acceptance rests on an
independent read. A receipt is written only when every item is accepted.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import fingerprint as fp
from intactly.functions import rules

# Outcomes and receipt format.
ACCEPTED = ("uploaded", "reused")
CONFLICTS = ("conflict_size", "conflict_digest")
RECEIPT_VERSION = 1
RUN_ID_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def object_manifest(df: DataFrame, key: Column, payload: str) -> DataFrame:
    """key, bytes, sha256 (and the payload) per object, digested in one pass."""
    return df.select(key.alias("key"), F.col(payload).alias("payload"),
                     F.octet_length(payload).cast("bigint").alias("bytes"),
                     F.sha2(F.col(payload), 256).alias("sha256"))


def outcomes(manifest: DataFrame, target: DataFrame, absent: str = "uploaded") -> DataFrame:
    """Outcome per manifest key against what the target holds (B1, B2, D3).

    Before a write an absent key is one to upload (``absent='uploaded'``);
    after a write the same test is the read-back, where an absent key is a
    failure (``absent='missing_after_write'``).
    """
    # One stored object per key (the smallest, deterministically), so copies never pair up.
    t = (target.groupBy("key").agg(F.min(F.struct("bytes", "sha256")).alias("_t"))
         .select("key", F.col("_t.bytes").alias("t_bytes"), F.col("_t.sha256").alias("t_sha256")))
    outcome = (F.when(F.col("t_bytes").isNull() & F.col("t_sha256").isNull(), F.lit(absent))
               .when(~F.col("t_bytes").eqNullSafe(F.col("bytes")), F.lit("conflict_size"))
               .when(~F.col("t_sha256").eqNullSafe(F.col("sha256")), F.lit("conflict_digest"))
               .otherwise(F.lit("reused")))
    return manifest.join(t, "key", "left").withColumn("outcome", outcome).drop("t_bytes", "t_sha256")


def summary(result: DataFrame) -> DataFrame:
    """One row: counts per outcome, passed, failed, all-success gate and status."""
    o = F.col("outcome")
    return result.agg(
        F.count_if(o == "uploaded").alias("uploaded"),
        F.count_if(o == "reused").alias("reused"),
        F.count_if(o == "conflict_size").alias("conflict_size"),
        F.count_if(o == "conflict_digest").alias("conflict_digest"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(o.isin(*ACCEPTED)).alias("passed"),
        F.count_if(~o.isin(*ACCEPTED)).alias("failed"),
    ).withColumn("all_success", F.col("failed") == 0).withColumn(
        "status", F.when(F.col("all_success"), F.lit(0)).otherwise(F.lit(1)))


def _read_target(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


TARGET_SCHEMA = "key string, payload string, run_id string, written_at timestamp"


def publish_rows(spark: SparkSession, manifest: DataFrame, target_path: str) -> DataFrame:
    """Create-only publish of manifest rows into a Parquet object table.

    Only keys absent from the target are appended, each row tagged with this
    run's id and write time; existing keys are never rewritten, and a run
    with nothing to create writes nothing. Outcomes come from re-reading the
    target: per key the first writer (earliest write, then run id) is the
    stored object, so a concurrent run that appended the same key sees it as
    reused or as a conflict, never as its own upload.
    """
    run_id = uuid.uuid4().hex
    key_ok = F.coalesce(rules.all_pass(rules.storage_key_rules(F.col("key"))), F.lit(False))
    refused = manifest.where(~key_ok).drop("payload").withColumn("outcome", F.lit("invalid_key"))
    manifest = manifest.where(key_ok)
    before = _read_target(spark, target_path, TARGET_SCHEMA)
    creates = (manifest.join(before.select("key"), "key", "left_anti")
               .groupBy("key").agg(F.min_by(F.col("payload"), F.col("sha256")).alias("payload"))
               .withColumn("run_id", F.lit(run_id))
               .withColumn("written_at", F.current_timestamp()))
    if not creates.isEmpty():
        creates.write.mode("append").parquet(target_path)
    stored = _read_target(spark, target_path, TARGET_SCHEMA)
    first = (stored.groupBy("key")
             .agg(F.min_by(F.struct("payload", "run_id"), F.struct("written_at", "run_id")).alias("w"))
             .select("key", F.octet_length("w.payload").cast("bigint").alias("bytes"),
                     F.sha2(F.col("w.payload"), 256).alias("sha256"), F.col("w.run_id").alias("_run")))
    result = outcomes(manifest.drop("payload"), first.drop("_run"), absent="missing_after_write").join(
        first.select("key", "_run"), "key", "left")
    checked = result.withColumn(
        "outcome",
        F.when((F.col("outcome") == "reused") & (F.col("_run") == run_id), F.lit("uploaded"))
        .otherwise(F.col("outcome"))).drop("_run")
    return checked.unionByName(refused)


def provenance_records(objects: DataFrame, fields: list[Column]) -> DataFrame:
    """Version-1 provenance JSON per object, addressed by its own SHA-256.

    Field order is the order of ``fields``; null fields are left out of the JSON.
    """
    text = F.to_json(F.struct(F.lit(RECEIPT_VERSION).alias("formatVersion"), *fields))
    key = F.concat(F.lit("provenance/"), F.sha2(text, 256), F.lit(".json"))
    return objects.select("*", key.alias("provenance_key"), text.alias("provenance_json"))


def write_provenance(records: DataFrame, root: str) -> None:
    """Appends provenance documents as JSON lines; earlier documents are kept."""
    records.select(F.col("provenance_json").alias("value")).write.mode("append").text(root)


def receipt_entries(objects: DataFrame, verification: Column | None = None) -> DataFrame:
    """One JSON entry per accepted object with a fixed field order.

    ``verification`` (a struct, null for non-Parquet objects) is omitted from
    the JSON when null, as the format requires an absent, not null, field.
    """
    fields = [F.col("key"), F.col("bytes"), F.col("sha256"), F.col("action")]
    if verification is not None:
        fields.append(verification.alias("verification"))
    return objects.withColumn("entry", F.to_json(F.struct(*fields)))


def receipt_header(entries: DataFrame, group: list[str]) -> DataFrame:
    """Per receipt: objects, bytes, and an order-insensitive digest of the entries."""
    aggs = [F.count(F.lit(1)).alias("objects"), F.sum("bytes").alias("bytes"),
            fp.digest_sum(F.col("entry")).alias("entries_digest")]
    return entries.groupBy(*group).agg(*aggs) if group else entries.agg(*aggs)


def write_receipt(spark: SparkSession, result: DataFrame, entries: DataFrame,
                  receipts_root: str) -> str | None:
    """Writes a receipt only when every item was accepted; returns its path.

    The receipt id is ``UTC-timestamp-UUID`` and the folder is created with
    ``errorifexists`` so a receipt is never replaced. Entries are written by
    the executors as JSON lines; nothing is gathered on the driver except
    the one-row gate.
    """
    gate = summary(result).select("all_success").first()
    if not gate or not gate["all_success"]:
        return None
    rid = spark.range(1).select(F.concat(
        F.date_format(F.current_timestamp(), RUN_ID_FORMAT), F.lit("-"),
        F.expr("uuid()")).alias("id")).first()["id"]
    path = f"{receipts_root.rstrip('/')}/{rid}"
    (entries.select(F.lit(RECEIPT_VERSION).alias("formatVersion"), F.lit(rid).alias("publicationId"),
                    "*")
     .write.mode("errorifexists").json(path))
    return path


def read_receipt(spark: SparkSession, path: str) -> DataFrame:
    """Receipt reader: one row per object entry."""
    return spark.read.json(path)

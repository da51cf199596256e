"""One publication run as a transaction (M3): objects, read-back, provenance, decode of the stored copies, receipt.

1. The object sink creates each object and its provenance, reads both back,
   and commits what it did (``sources/objects.py``).
2. Stored Parquet copies are decoded by Spark's reader; their rows and both
   schemas must be those recorded before publication.
3. The receipt sink writes one entry per object. Its commit writes the
   receipt only if every entry is accepted; otherwise the entries go, too.

Items fail independently, but one failed item withholds the receipt. What
was accepted stays, and a rerun finds it there and reuses it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intactly.functions import rules
from intactly.functions.schema import embedded, same_schema
from intactly.functions.sidecar import runtime_versions
from intactly.operators import integrity
from intactly.operators.ordered import staged
from intactly.operators.publish import ACCEPTED, RECEIPT_VERSION, RUN_ID_FORMAT
from intactly.sources import files as file_sources
from intactly.sources import objects

#: Statuses besides the sink's actions.
INVALID_KEY, NOT_PROVEN, OTHER_DECODE = "invalid_key", "provenance_failed", "verification_mismatch"
ACCEPTED_ACTIONS = list(ACCEPTED)


@dataclass
class Report:
    """Outcome of every item (``results``), and the id of the receipt, None unless all were accepted."""
    results: DataFrame
    receipt: str | None


def _verified(done: DataFrame, recorded: DataFrame, root: str) -> DataFrame:
    """key, and whether the decoded copy is the recorded one, for stored objects with a recorded Spark schema."""
    wanted = done.where(F.col("action").isin(ACCEPTED_ACTIONS)).join(
        recorded.where("spark_schema IS NOT NULL").select("key", "rows", "parquet_schema", "spark_schema"), "key")
    stored = wanted.select(F.concat(F.lit(root.rstrip("/") + "/"), "key").alias("path"), F.col("key").alias("filename"),
                           F.col("bytes").alias("length"))
    seen = integrity.verify_files(stored).select(F.col("filename").alias("key"), "decoded_rows", "status",
                                                 F.col("parquet_schema").alias("p"), F.col("spark_schema").alias("s"))
    same = ((F.col("status") == integrity.STATUS_OK) & F.col("rows").eqNullSafe(F.col("decoded_rows"))
            & F.col("parquet_schema").eqNullSafe(F.col("p")) & same_schema(F.col("spark_schema"), F.col("s")))
    return wanted.join(seen, "key").select("key", same.alias("same"))


def publish(items: DataFrame, root: str, header: dict | None = None, secrets: Sequence[str] = ()) -> Report:
    """Publishes ``items`` under ``root`` (a URI or an absolute path) and writes a receipt if all are accepted.

    ``items``: key, source (URI), bytes, sha256, provenance (JSON text or
    null), and rows, parquet_schema and spark_schema as recorded (null for
    objects that are not Parquet). ``header`` holds the receipt's leading
    fields. Error texts never show ``secrets``.
    """
    spark = items.sparkSession
    root = root if "://" in root else f"file://{root}"
    objects.register(spark)
    key_ok = F.coalesce(rules.all_pass(rules.relative_path_rules(F.col("key"))), F.lit(False))
    work = staged(items.withColumn("_ok", key_ok), "items")
    run = uuid.uuid4().hex
    (file_sources.spread(work.where("_ok").select("key", "source", "bytes", "sha256", "provenance"), "key")
     .write.format("intactly_objects").mode("append").option("root", root).option("run", run)
     .option("secrets", json.dumps(list(secrets))).save())
    done = objects.committed(spark, root, run)
    checks = staged(_verified(done, work, root), "verified")
    refused = work.where("NOT _ok").select("key", "bytes", "sha256", F.lit(INVALID_KEY).alias("action"))
    every = done.unionByName(refused, allowMissingColumns=True).join(checks, "key", "left")
    outcome = (F.when(~F.col("action").isin(ACCEPTED_ACTIONS), F.col("action"))
               .when(F.col("provenance_action").isNotNull() & ~F.col("provenance_action").isin(ACCEPTED_ACTIONS),
                     F.lit(NOT_PROVEN))
               .when(~F.coalesce("same", F.lit(True)), F.lit(OTHER_DECODE)).otherwise(F.col("action")))
    results = staged(every.withColumn("outcome", outcome).drop("same"), "results")
    if not results.where(~F.col("outcome").isin(ACCEPTED_ACTIONS)).isEmpty():
        return Report(results, None)
    return Report(results, _receipt(results, work, root, header or {}))


def _receipt(results: DataFrame, work: DataFrame, root: str, header: dict) -> str:
    """Writes the receipt of an accepted run, and returns its id."""
    spark = results.sparkSession
    now = F.current_timestamp()
    moment = spark.range(1).select(F.date_format(now, RUN_ID_FORMAT).alias("id"),
                                   F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
                                   F.to_json(runtime_versions(spark)).alias("versions")).first()
    receipt_id = f"{moment['id']}-{uuid.uuid4()}"
    at = F.lit(moment["at"])
    proof = F.struct(F.col("provenance_key").alias("key"), F.col("provenance_bytes").alias("bytes"),
                     F.col("provenance_sha256").alias("sha256"), F.col("provenance_action").alias("action"))
    decoded = F.struct(F.col("rows").alias("rowCount"), F.col("parquet_schema").alias("parquetSchema"),
                       at.alias("verifiedAt"), embedded(F.col("spark_schema")).alias("sparkSchema"),
                       runtime_versions(spark).alias("versions"))
    entry = F.to_json(F.struct(
        "key", "bytes", "sha256", "action", at.alias("verifiedAt"), F.try_parse_json("provenance").alias("source"),
        F.when(F.col("provenance_key").isNotNull(), proof).alias("provenance"),
        F.when(F.col("spark_schema").isNotNull(), decoded).alias("verification")))
    recorded = work.select("key", "provenance", "rows", "parquet_schema", "spark_schema")
    entries = results.join(recorded, "key").select(entry.alias("entry"),
                                                   F.col("outcome").isin(ACCEPTED_ACTIONS).alias("accepted"))
    head = {"formatVersion": RECEIPT_VERSION, **header, "completedAt": moment["at"],
            "versions": json.loads(moment["versions"])}
    (entries.write.format("intactly_receipt").mode("append").option("root", root).option("run", receipt_id)
     .option("header", json.dumps(head)).save())
    return receipt_id

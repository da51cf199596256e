"""Provenance sidecar (format version 1) as JSON text, and its field rules.

The JSON type of a field matters: ``1.0`` and ``"1"`` are not integral
numbers. Text is parsed once to a VARIANT, and ``schema_of_variant`` of each
field gives its JSON type, so the checks run JVM-side with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import rules
from intactly.functions.rules import Rule
from intactly.functions.schema import embedded

# Sidecar format.
FORMAT_VERSION = 1
TEXT_FIELDS = ("month", "filename", "sourceUrl", "finalUrl")

# Fields checked as integral numbers, as non-empty text, as objects.
INTEGRAL_FIELDS = {"version": "$.formatVersion", "bytes": "$.bytes", "rows": "$.verification.rowCount"}
STRING_FIELDS = {"month": "$.month", "filename": "$.filename", "source_url": "$.sourceUrl",
                 "final_url": "$.finalUrl", "sha256": "$.sha256", "retrieved_at": "$.retrievedAt",
                 "verified_at": "$.verification.verifiedAt",
                 "parquet_schema": "$.verification.parquetSchema", "java": "$.verification.versions.java",
                 "scala": "$.verification.versions.scala", "spark": "$.verification.versions.spark"}
OBJECT_FIELDS = {"root": "$", "spark_schema": "$.verification.sparkSchema"}


def sidecar_fields(df: DataFrame, json_col: str) -> DataFrame:
    """Parses each sidecar once and extracts every checked field once.

    Adds ``t_<f>`` (JSON type of the field: BIGINT for integral numbers that fit
    a long, STRING, OBJECT<..>, …), ``n_<f>`` for integral fields and ``s_<f>``
    for text fields, and ``j_spark_schema``, the recorded schema as JSON text.
    The parse is its own projection, so it is not repeated per rule.
    """
    parsed = df.withColumn("_v", F.try_parse_json(F.col(json_col)))
    v = F.col("_v")
    fields = []
    for name, path in {**INTEGRAL_FIELDS, **STRING_FIELDS, **OBJECT_FIELDS}.items():
        fields.append(F.schema_of_variant(F.try_variant_get(v, F.lit(path), "variant")).alias(f"t_{name}"))
    for name, path in INTEGRAL_FIELDS.items():
        fields.append(F.try_variant_get(v, F.lit(path), "bigint").alias(f"n_{name}"))
    for name, path in STRING_FIELDS.items():
        fields.append(F.try_variant_get(v, F.lit(path), "string").alias(f"s_{name}"))
    schema = F.try_variant_get(v, F.lit(OBJECT_FIELDS["spark_schema"]), "variant")
    return parsed.select(*[c for c in df.columns], *fields, F.to_json(schema).alias("j_spark_schema"))


def field_rules(complete: bool = False) -> list[Rule]:
    """Field rules of a version-1 sidecar over ``sidecar_fields`` output, in check order.

    With ``complete`` the verification must also name its physical schema and
    the runtime versions it was made with, as full verification records do.
    """
    c = F.col

    def integral(name: str) -> Column:
        return c(f"t_{name}") == "BIGINT"

    def text(name: str) -> Column:
        return (c(f"t_{name}") == "STRING") & (F.length(c(f"s_{name}")) > 0)

    text_ok = text("month") & text("filename") & text("source_url") & text("final_url")
    checks = [
        Rule("json_object", c("t_root").startswith("OBJECT")),
        Rule("format_version", integral("version") & (c("n_version") == FORMAT_VERSION)),
        Rule("text_fields", text_ok),
        Rule("bytes_positive", integral("bytes") & (c("n_bytes") > 0)),
        Rule("sha256_hex", (c("t_sha256") == "STRING") & rules.sha256_ok(c("s_sha256"))),
        Rule("timestamps", rules.iso_instant_ok(c("s_retrieved_at"))
             & rules.iso_instant_ok(c("s_verified_at"))),
        Rule("row_count", integral("rows") & (c("n_rows") >= 0)),
        Rule("spark_schema_object", c("t_spark_schema").startswith("OBJECT")),
    ]
    if complete:
        checks.append(Rule("verification_text",
                           text("parquet_schema") & text("java") & text("scala") & text("spark")))
    return checks


def runtime_versions(spark: SparkSession) -> Column:
    """java, scala and spark versions of this session, as a struct."""
    jvm = spark.sparkContext._jvm
    found = {"java": jvm.java.lang.System.getProperty("java.version"),
             "scala": jvm.scala.util.Properties.versionNumberString(), "spark": spark.version}
    return F.struct(*[F.lit(v).alias(k) for k, v in found.items()])


def document(spark: SparkSession, month: Column, source_url: Column, final_url: Column, stamp: Column) -> Column:
    """Version-1 sidecar JSON of a full verification record (columns of ``integrity.verification_records``).

    The Spark schema is re-embedded as an object (I15, I16); field order is
    that of the format.
    """
    return F.to_json(F.struct(
        F.lit(FORMAT_VERSION).alias("formatVersion"), month.alias("month"), F.col("filename"),
        source_url.alias("sourceUrl"), final_url.alias("finalUrl"), stamp.alias("retrievedAt"), F.col("bytes"),
        F.col("sha256"),
        F.struct(stamp.alias("verifiedAt"), F.col("parquet_schema").alias("parquetSchema"),
                 F.col("rows").alias("rowCount"), embedded(F.col("spark_schema")).alias("sparkSchema"),
                 runtime_versions(spark).alias("versions")).alias("verification")))


def read_sidecars(spark: SparkSession, path: str, complete: bool = False) -> DataFrame:
    """One row per sidecar file (whole file as text), with failing rules (A5)."""
    raw = (spark.read.text(path, wholetext=True)
           .withColumn("path", F.input_file_name()))
    return sidecar_fields(raw, "value").withColumn("reasons", rules.reasons(field_rules(complete)))


def read_descriptor(spark: SparkSession, path: str, expected_files: list[str],
                    snapshot_id: str | None = None) -> DataFrame:
    """Reference descriptor: version 1 and filenames equal to an expected ordered list.

    With ``snapshot_id`` the descriptor must be the one of that snapshot;
    ``operators/descriptor.py`` says file by file what differs.
    """
    schema = ("formatVersion long, snapshotId string, retrievedAt string, "
              "files array<struct<filename string, sourceUrl string, bytes long, "
              "sha256 string, revision string>>")
    doc = spark.read.schema(schema).option("multiLine", "true").json(path)
    names = F.transform(F.col("files"), lambda f: f["filename"])
    return doc.withColumn("reasons", rules.reasons([
        Rule("format_version", F.col("formatVersion") == FORMAT_VERSION),
        Rule("retrieved_at", rules.iso_instant_ok(F.col("retrievedAt"))),
        Rule("file_list", names == F.array(*[F.lit(n) for n in expected_files])),
        *([Rule("snapshot_id", F.col("snapshotId") == snapshot_id)] if snapshot_id is not None else []),
    ]))

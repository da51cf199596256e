"""Isolation by Spark's own reader, full verification records, schemas as data."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intactly.functions import schema, sidecar
from intactly.operators import integrity, manifest
from intactly.sources import files


def _zero_chunk(path, group, column):
    chunk = pq.ParquetFile(path).metadata.row_group(group).column(column)
    data = bytearray(open(path, "rb").read())
    data[chunk.data_page_offset:chunk.data_page_offset + chunk.total_compressed_size] = bytes(chunk.total_compressed_size)
    open(path, "wb").write(bytes(data))


def _folder(root, damaged=True):
    os.makedirs(root)
    write = lambda name, table: pq.write_table(
        table, os.path.join(root, name), row_group_size=4, compression="none", use_dictionary=False)
    plain = pa.table({"k": list(range(12)), "v": [f"word {i}" for i in range(12)]})
    write("a.parquet", plain)
    write("odd name+%20[1].parquet", plain)
    write("nested.parquet", pa.table({"_metadata": [1, 2], "s": [{"a": [1, 2], "b.c": None}, None],
                                      "m": pa.array([[("x", 1)], None], pa.map_(pa.string(), pa.int32()))}))
    if damaged:
        write("late.parquet", plain)
        _zero_chunk(os.path.join(root, "late.parquet"), 2, 1)     # the last of three row groups
        write("early.parquet", plain)
        _zero_chunk(os.path.join(root, "early.parquet"), 0, 0)
        open(os.path.join(root, "text.parquet"), "w").write("no parquet at all")
        open(os.path.join(root, "nothing.parquet"), "w").close()
    return files


def test_bad_files_are_found_and_all_others_counted(spark, workdir):
    root = os.path.join(workdir, "scan")
    _folder(root)
    rows = {r["filename"]: r for r in integrity.verify_files(files.inventory(spark, root, "*.parquet")).collect()}
    assert {n: r["status"] for n, r in rows.items()} == {
        "a.parquet": "verified", "odd name+%20[1].parquet": "verified", "nested.parquet": "verified",
        "late.parquet": "unreadable", "early.parquet": "unreadable", "text.parquet": "unreadable",
        "nothing.parquet": "unreadable"}
    assert rows["a.parquet"]["decoded_rows"] == rows["odd name+%20[1].parquet"]["decoded_rows"] == 12
    assert rows["late.parquet"]["footer_rows"] == 12 and rows["late.parquet"]["error"] == "decoded 8 of 12 rows"
    assert rows["early.parquet"]["decoded_rows"] == 0
    assert rows["text.parquet"]["decoded_rows"] is None and rows["text.parquet"]["error"]
    record = {r["filename"]: r for r in integrity.verification_records(files.inventory(spark, root, "*.parquet")).collect()}
    assert record["late.parquet"]["rows"] is None and record["late.parquet"]["spark_schema"] is None
    assert len(record["a.parquet"]["sha256"]) == 64 and record["a.parquet"]["rows"] == 12
    assert record["a.parquet"]["parquet_schema"].splitlines()[0].split()[:2] == ["k", "INT64"]


def test_a_sound_folder_takes_one_strict_scan(spark, workdir, monkeypatch):
    root, tries = os.path.join(workdir, "scan"), []
    _folder(root, damaged=False)
    plain = integrity._scan
    monkeypatch.setattr(integrity, "_scan", lambda *a: tries.append(a[3]) or plain(*a))
    got = integrity.verify_files(files.inventory(spark, root, "*.parquet"))
    assert {r["status"] for r in got.collect()} == {"verified"} and tries == [False, False]
    assert integrity.verify_files(files.inventory(spark, root, "*.absent")).count() == 0


def test_the_content_hash_reads_every_column(spark):
    a = spark.createDataFrame([(1, "x", {"k": 1})], "a long, b string, c map<string,int>")
    b = spark.createDataFrame([(1, "x", {"k": 2})], "a long, b string, c map<string,int>")
    one = lambda d: d.select(integrity.content_hash(d.schema)).first()[0]
    assert one(a) != one(b)


NESTED = "a long not null, b struct<c: array<struct<d: int, e: map<string, double>>>, f: string>, g decimal(10,2)"


def test_flattened_paths(spark):
    text = T._parse_datatype_string(NESTED).json()
    df = spark.createDataFrame([(1, text), (2, text), (3, "no schema"), (4, None)], "k int, schema string")
    got = schema.flattened(df).collect()
    assert {(r.path, r.position, r.type, r.nullable) for r in got if r.schema == text} == {
        ("", 0, "struct", False), ("a", 0, "long", False), ("b", 1, "struct", True), ("b.c", 0, "array", True),
        ("b.c.element", 0, "struct", True), ("b.c.element.d", 0, "integer", True), ("b.c.element.e", 1, "map", True),
        ("b.c.element.e.key", 0, "string", False), ("b.c.element.e.value", 1, "double", True),
        ("b.f", 1, "string", True), ("g", 2, "decimal(10,2)", True)}
    assert [(r.path, r.type) for r in got if r.schema == "no schema"] == [("", None)]


def test_differences_name_the_outermost_path(spark):
    old = T._parse_datatype_string(NESTED).json()
    changes = {
        "same": old, "spaced": json.dumps(json.loads(old), indent=3, sort_keys=True),
        "nested": T._parse_datatype_string(NESTED.replace("d: int", "d: bigint")).json(),
        "nullable": T._parse_datatype_string(NESTED.replace(" not null", "")).json(),
        "swapped": T._parse_datatype_string("b " + NESTED.split(", b ", 1)[1].rsplit(", g", 1)[0]
                                            + ", a long not null, g decimal(10,2)").json(),
        "gone": T._parse_datatype_string("a long not null, g decimal(10,2)").json(),
        "text": "no schema"}
    pairs = spark.createDataFrame([(k, old, v) for k, v in changes.items()], "k string, recorded string, observed string")
    got = sorted((r.k, r.path, r.change, r.recorded_type, r.observed_type) for r in schema.differences(pairs, "k").collect())
    assert got == [("gone", "b", "removed", "struct", None), ("gone", "g", "moved", "decimal(10,2)", "decimal(10,2)"),
                   ("nested", "b.c.element.d", "retyped", "integer", "long"),
                   ("nullable", "a", "renullable", "long", "long"),
                   ("swapped", "a", "moved", "long", "long"), ("swapped", "b", "moved", "struct", "struct"),
                   ("text", "", "retyped", "struct", None)]
    same = {r.k for r in pairs.where(schema.same_schema(F.col("recorded"), F.col("observed"))).collect()}
    assert same == {"same", "spaced"}


def test_document_embeds_the_schema_and_passes_the_complete_rules(spark):
    text = T._parse_datatype_string(NESTED).json()
    record = spark.createDataFrame([("f.parquet", 5, "a" * 64, "k INT64", text, 3)],
                                   "filename string, bytes long, sha256 string, parquet_schema string, "
                                   "spark_schema string, rows long")
    url, stamp = F.lit("https://x/f"), F.lit("2026-05-01T00:00:00Z")
    made = record.select(sidecar.document(spark, F.lit("2026-05"), url, url, stamp).alias("j"))
    doc = json.loads(made.first()["j"])
    assert list(doc) == ["formatVersion", "month", "filename", "sourceUrl", "finalUrl", "retrievedAt", "bytes", "sha256",
                         "verification"]
    assert doc["verification"]["sparkSchema"] == json.loads(text)
    assert list(doc["verification"]["versions"]) == ["java", "scala", "spark"]
    from intactly.functions import rules
    stub = made.select(F.regexp_replace("j", '"parquetSchema":"k INT64",', "").alias("j"))
    checked = sidecar.sidecar_fields(made.unionAll(stub), "j").select(
        rules.reasons(sidecar.field_rules(complete=True)).alias("r"), "j_spark_schema").collect()
    assert [r.r for r in checked] == [[], ["verification_text"]]
    assert json.loads(checked[0].j_spark_schema) == json.loads(text)


def test_reconcile_needs_rows_and_both_schemas(spark):
    keys = ["same", "rows", "physical", "spark"]
    wanted = spark.createDataFrame([(k, False) for k in keys], "key string, refresh boolean")
    stored = spark.createDataFrame([(k, 1, "h", "i", 5, "p", '{"a": 1}') for k in keys],
                                   "key string, bytes long, sha256 string, identity string, rows long, "
                                   "parquet_schema string, spark_schema string")
    noted = spark.createDataFrame([(k, 1, "h", "i", True, 6 if k == "rows" else 5, "q" if k == "physical" else "p",
                                    '{"a":2}' if k == "spark" else '{"a":1}') for k in keys],
                                  "key string, rec_bytes long, rec_sha256 string, rec_identity string, "
                                  "metadata_ok boolean, rec_rows long, rec_parquet_schema string, rec_spark_schema string")
    none = spark.createDataFrame([], "key string")
    got = {r.key: r.status for r in manifest.reconcile(wanted, stored, noted, none, "key", True, True).collect()}
    assert got == {"same": "accepted", "rows": "verification_mismatch", "physical": "verification_mismatch",
                   "spark": "verification_mismatch"}

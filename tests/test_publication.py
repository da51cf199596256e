"""Publication as a transaction: objects, provenance, stored decode, receipt; and descriptors against files."""

from __future__ import annotations

import glob
import hashlib
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from intactly.functions import sidecar
from intactly.operators import descriptor, integrity, publication
from intactly.sources import files, objects

ITEM = ("key string, source string, bytes long, sha256 string, provenance string, rows long, parquet_schema string, "
        "spark_schema string")


def _text(workdir, name, body, **other):
    path = os.path.join(workdir, name)
    open(path, "wb").write(body)
    row = dict(key=f"ref/{name}", source="file://" + path, bytes=len(body), sha256=hashlib.sha256(body).hexdigest(),
               provenance=json.dumps({"of": name}), rows=None, parquet_schema=None, spark_schema=None)
    return tuple((row | other).values())


def _parquet(spark, workdir, **other):
    os.makedirs(os.path.join(workdir, "p"), exist_ok=True)
    pq.write_table(pa.table({"id": [1, 2, 3], "v": ["a", None, "c"]}), os.path.join(workdir, "p", "t.parquet"))
    r = integrity.verification_records(files.inventory(spark, os.path.join(workdir, "p"), "*.parquet")).first()
    row = dict(key="trips/t.parquet", source=r.path, bytes=r.bytes, sha256=r.sha256, provenance="{}", rows=r.rows,
               parquet_schema=r.parquet_schema, spark_schema=r.spark_schema)
    return tuple((row | other).values())


def _run(spark, rows, root, **kw):
    report = publication.publish(spark.createDataFrame(rows, ITEM), root, **kw)
    return {r.key: (r.outcome, r.provenance_action) for r in report.results.collect()}, report


def _receipts(root):
    return glob.glob(f"{root}/receipts/*/receipt.json")


def test_a_rerun_reuses_everything_and_repairs_lost_provenance(spark, workdir):
    root = os.path.join(workdir, "store")
    rows = [_parquet(spark, workdir), _text(workdir, "zones.csv", b"1,a"), _text(workdir, "bare", b"x", provenance=None)]
    got, report = _run(spark, rows, root, header={"bucket": "inbox", "months": ["2026-05"]})
    assert got == {"trips/t.parquet": ("uploaded", "uploaded"), "ref/zones.csv": ("uploaded", "uploaded"),
                   "ref/bare": ("uploaded", None)}
    head = objects.receipt(root, report.receipt)
    assert list(head) == ["formatVersion", "bucket", "months", "completedAt", "versions", "objects", "publicationId"]
    assert head["objects"]["count"] == 3 and head["publicationId"] == report.receipt
    entries = {(e := json.loads(r.value))["key"]: e for r in objects.receipt_entries(spark, root, report.receipt).collect()}
    trip = entries["trips/t.parquet"]
    assert list(trip) == ["key", "bytes", "sha256", "action", "verifiedAt", "source", "provenance", "verification"]
    assert trip["verification"]["rowCount"] == 3 and trip["verification"]["sparkSchema"]["type"] == "struct"
    assert entries["ref/zones.csv"]["source"] == {"of": "zones.csv"} and "verification" not in entries["ref/zones.csv"]
    proof = entries["ref/zones.csv"]["provenance"]
    stored = open(f"{root}/{proof['key']}", "rb").read()
    assert hashlib.sha256(stored).hexdigest() == proof["sha256"] and proof["sha256"] in proof["key"]

    os.unlink(f"{root}/{proof['key']}")
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/ref/*") + glob.glob(f"{root}/trips/*")}
    got, _ = _run(spark, rows, root)
    assert got == {"trips/t.parquet": ("reused", "reused"), "ref/zones.csv": ("reused", "uploaded"), "ref/bare": ("reused", None)}
    assert {p: os.stat(p).st_mtime_ns for p in before} == before  # data is not rewritten
    assert len(_receipts(root)) == 2 and not glob.glob(f"{root}/**/*.part-*", recursive=True)


def test_one_bad_item_fails_alone_but_withholds_the_receipt(spark, workdir):
    root = os.path.join(workdir, "store")
    os.makedirs(os.path.join(root, "ref"))
    open(os.path.join(root, "ref", "taken"), "wb").write(b"old")
    rows = [_text(workdir, "good", b"fine"), _text(workdir, "taken", b"new"),
            _text(workdir, "moved", b"1234", sha256="0" * 64), _text(workdir, "out", b"x", key="../out"),
            _text(workdir, "absent", b"y", source="file:///no/s3cr3t/place"),
            _parquet(spark, workdir, rows=4)]
    got, report = _run(spark, rows, root, secrets=["s3cr3t"])
    assert {k: o for k, (o, _) in got.items()} == {
        "ref/good": "uploaded", "ref/taken": "conflict", "ref/moved": "source_changed", "../out": "invalid_key",
        "ref/absent": "failed", "trips/t.parquet": "verification_mismatch"}
    assert report.receipt is None and _receipts(root) == []
    errors = {r.key: r.error for r in report.results.collect()}
    assert "s3cr3t" not in errors["ref/absent"] and "***" in errors["ref/absent"]
    assert open(os.path.join(root, "ref", "taken"), "rb").read() == b"old"
    assert not os.path.exists(os.path.join(root, "ref", "moved")) and not os.path.exists(os.path.join(workdir, "store.out"))
    assert not glob.glob(f"{root}/**/*.part-*", recursive=True)


def test_an_aborted_job_leaves_no_receipt(spark, workdir):
    objects.register(spark)
    rows = spark.range(40).select(F.format_string("{\"key\":\"%d\"}", "id").alias("entry"), F.lit(True).alias("accepted"),
                                  "id").repartition(4)

    def write(df, run):
        (df.select("entry", "accepted").write.format("intactly_receipt").mode("append")
         .option("root", f"file://{workdir}").option("run", run).option("header", "{}").save())

    with pytest.raises(Exception):   # the commit refuses
        write(rows.withColumn("accepted", F.col("id") != 7), "refused")
    with pytest.raises(Exception):   # a task dies
        write(rows.withColumn("entry", F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("entry"))), "died")
    assert _receipts(workdir) == [] and os.listdir(os.path.join(workdir, "receipts")) == []
    write(rows, "whole")
    assert objects.receipt(f"file://{workdir}", "whole")["objects"]["count"] == 40
    with pytest.raises(Exception):   # a receipt is never written over, and the first one stays
        rows.select("entry", "accepted").write.format("intactly_receipt").mode("overwrite").option(
            "root", f"file://{workdir}").option("run", "whole").option("header", "{}").save()
    assert objects.receipt_entries(spark, f"file://{workdir}", "whole").count() == 40
    with pytest.raises(Exception):   # a run that was not committed has no results
        objects.committed(spark, f"file://{workdir}", "never")


def test_stores_without_an_exclusive_create_are_refused(workdir):
    from pyarrow import fs
    other = fs.SubTreeFileSystem(workdir, fs.LocalFileSystem())
    with pytest.raises(NotImplementedError):
        objects.claim(other, "a", "b")


def _descriptor(spark, workdir, names, snapshot="s1"):
    doc = {"formatVersion": 1, "snapshotId": snapshot, "retrievedAt": "2026-05-01T00:00:00Z",
           "files": [{"filename": n, "sourceUrl": "https://x/" + n, "bytes": 1, "sha256": n, "revision": "r"} for n in names]}
    path = os.path.join(workdir, f"{snapshot}-{len(names)}.json")
    open(path, "w").write(json.dumps(doc, indent=2))
    return sidecar.read_descriptor(spark, path, ["a", "b", "c"], "s1")


def test_descriptor_entries_and_files_both_ways(spark, workdir):
    there = spark.createDataFrame([("a", 1, "a"), ("b", 1, "other"), ("c", 2, "c"), ("x", 1, "x"), ("n", 1, "n")],
                                  "filename string, bytes long, sha256 string")

    def got(names):
        return sorted((r.filename, r.position, r.status) for r in descriptor.matched(
            _descriptor(spark, workdir, names), there, ["a", "b", "c"]).collect())

    assert got(["a", "b", "c"]) == [("a", 0, "accepted"), ("b", 1, "changed_digest"), ("c", 2, "changed_size"),
                                    ("n", None, "surplus"), ("x", None, "surplus")]
    assert got(["b", "a", "gone", "n"]) == [("a", 1, "reordered"), ("b", 0, "reordered"), ("c", None, "surplus"),
                                            ("gone", 2, "missing"), ("n", 3, "unexpected"), ("x", None, "surplus")]
    assert got(["a", "a"])[:2] == [("a", 0, "repeated"), ("a", 1, "repeated")]
    assert [s for *_, s in got([])] == ["surplus"] * 5
    none = there.limit(0)
    lost = descriptor.matched(_descriptor(spark, workdir, ["a"]), none, ["a", "b", "c"]).collect()
    assert {r.status for r in lost} == {"missing"} and len(lost) == 3
    assert _descriptor(spark, workdir, ["a", "b", "c"]).first()["reasons"] == []
    assert _descriptor(spark, workdir, ["a", "b", "c"], "s2").first()["reasons"] == ["snapshot_id"]

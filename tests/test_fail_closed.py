"""Fingerprints of awkward values, and cases that must not pass as good."""

from __future__ import annotations

import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from intactly.functions import fingerprint as fp
from intactly.functions import rules
from intactly.operators import history, integrity, retrieval, zone
from intactly.sources import files


def _print(spark, row, schema):
    return fp.fingerprint(spark.createDataFrame([row], schema)).first()["fingerprint"]


def test_fingerprint_tells_close_doubles_apart_and_never_throws(spark):
    values = [1.00000011, 1.00000019, -1e-7, 1e-7, 1e14, 9.3e12, float("nan"), float("inf"), float("-inf"), 0.0, None]
    found = [_print(spark, (v,), "x double") for v in values]
    assert len(set(found)) == len(values)
    assert _print(spark, (0.0,), "x double") == _print(spark, (-0.0,), "x double")


def test_fingerprint_tells_nulls_and_borders_apart(spark):
    rows = [(None, "N"), ("N", None), ("\\N", ""), ("a\x1fb", "c"), ("a", "b\x1fc"), ("1:a", ""), ("", "1:a"), (None, None)]
    assert len({_print(spark, r, "a string, b string") for r in rows}) == len(rows)


def test_fingerprint_of_parts_adds_up(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS part", "CAST(id AS STRING) AS v")
    whole = fp.fingerprint(df).first()
    parts = fp.fingerprint(df, by=["part"])
    assert parts.agg(fp.added(F.col("fingerprint"))).first()[0] == whole["fingerprint"]
    assert all(int(w) > 0 for w in whole["fingerprint"].split("-"))
    assert fp.fingerprint(df.limit(0)).first()["fingerprint"] == fp.ZERO


def test_instants_may_have_a_fraction(spark):
    rows = [("2026-05-01T20:42:14Z", True), ("2026-05-01T20:42:14.123456Z", True), ("2026-05-01T20:42:14.Z", False),
            ("2026-05-01T20:42:14.1234567890Z", False), ("2026-13-01T20:42:14.5Z", False), ("2026-05-01", False)]
    got = spark.createDataFrame(rows, "t string, want boolean").withColumn("ok", rules.iso_instant_ok(F.col("t"))).collect()
    assert all(r.ok == r.want for r in got)


def test_a_repeating_writer_conflicts_with_itself(spark):
    rows = [("k", 1, "w", "aa"), ("k", 2, "w", "bb"), ("k", 3, "v", "aa"), ("k", 4, "w", "aa")]
    df = spark.createDataFrame(rows, "k string, t int, writer string, body string")
    got = {r.t: r.write_status for r in history.first_writer(df, ["k"], ["t"], "writer", F.col("body")).collect()}
    assert got == {1: "created", 2: "conflict", 3: "reused", 4: "reused"}


def test_unlistable_folder_raises_and_a_missing_one_is_empty(spark, workdir):
    plain = os.path.join(workdir, "plain")
    open(plain, "w").close()
    with pytest.raises(OSError):
        files.existing_inventory(spark, plain)
    assert files.existing_inventory(spark, os.path.join(workdir, "absent")).count() == 0
    requests = spark.createDataFrame([("2026-05", "a.parquet", "u", False)],
                                     "month string, filename string, source_url string, refresh boolean")
    with pytest.raises(OSError):
        retrieval.reconcile_directory(spark, plain, requests)


def test_a_file_without_row_groups_has_counts(spark, workdir):
    pq.ParquetWriter(os.path.join(workdir, "none.parquet"), pa.schema([("x", pa.int64())])).close()
    row = integrity.verify_files(files.inventory(spark, workdir)).first()
    assert (row.status, row.footer_rows, row.decoded_rows) == (integrity.STATUS_OK, 0, 0)


def test_file_work_goes_to_as_many_tasks_as_asked_for(spark):
    work = spark.range(2000).selectExpr("concat('/none/', id) AS path")
    tasks = files.spread(work, "path", tasks=40).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == 40
    assert files.file_digests(work, parallelism=40).rdd.getNumPartitions() == 40


def test_a_bad_refresh_keeps_the_accepted_pair_and_names_stay_in_the_root(spark, workdir):
    root, source = os.path.join(workdir, "raw"), os.path.join(workdir, "new")
    os.makedirs(root)
    for path, body in ((f"{root}/a", b"old"), (source, b"new")):
        with open(path, "wb") as f:
            f.write(body)
    rows = [("a", source, 3, "0" * 64, "{}"), ("../esc", source, 3, hashlib.sha256(b"new").hexdigest(), "{}"),
            ("b", source + "-absent", 3, "0" * 64, "{}")]
    df = spark.createDataFrame(rows, "filename string, source string, bytes long, sha256 string, sidecar string")
    got = {r.filename: r.outcome for r in retrieval.promote_files(df, "file://" + root).collect()}
    assert got == {"a": "source_changed", "../esc": "failed", "b": "failed"}
    assert sorted(os.listdir(root)) == ["a"] and sorted(os.listdir(workdir)) == ["new", "raw"]
    with open(f"{root}/a", "rb") as f:
        assert f.read() == b"old"
    docs = df.select("filename", "sidecar").where("filename LIKE '../%'")
    assert retrieval.write_sidecars(docs, "file://" + root).first().error


def test_epochs_of_two_streams_do_not_replace_each_other(spark, workdir):
    df = spark.createDataFrame([(1, "2026-05")], "x long, month string")
    for stream in ("s1", "s2"):
        zone.write_epoch(spark, df, workdir, 0, stream=stream)
    zone.write_epoch(spark, df, workdir, 0, stream="s2")
    assert zone.read_all_committed(spark, workdir).count() == 2

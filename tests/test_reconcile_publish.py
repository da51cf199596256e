"""Damage matrix, create-only publication, rerun idempotence, receipts, committed zone."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from intactly.operators import manifest, publish, zone


def test_damage_matrix(spark):
    requests = spark.createDataFrame(
        [(k, k == "d2") for k in ["ok", "no_sidecar", "bad_meta", "d", "d2", "marker", "no_data",
                                  "absent", "marker_only", "other_source", "dup"]],
        "key string, refresh boolean")
    files = spark.createDataFrame([
        ("ok", 10, "h", "2026-05"), ("no_sidecar", 10, "h", "2026-05"), ("bad_meta", 10, "h", "2026-05"),
        ("d", 10, "CHANGED", "2026-05"), ("d2", 10, "CHANGED", "2026-05"), ("marker", 10, "h", "2026-05"),
        ("other_source", 10, "h", "2026-06"), ("dup", 10, "h", "2026-05")],
        "key string, bytes long, sha256 string, identity string")
    sidecars = spark.createDataFrame([
        ("ok", 10, "h", "2026-05", True), ("bad_meta", 10, "h", "2026-05", False),
        ("d", 10, "h", "2026-05", True), ("d2", 10, "h", "2026-05", True), ("marker", 10, "h", "2026-05", True),
        ("no_data", 10, "h", "2026-05", True), ("other_source", 10, "h", "2026-05", True),
        ("dup", 10, "h", "2026-05", True), ("dup", 11, "h2", "2026-05", True)],
        "key string, rec_bytes long, rec_sha256 string, rec_identity string, metadata_ok boolean")
    markers = spark.createDataFrame([("marker",), ("marker_only",)], "key string")
    got = {r["key"]: (r["status"], r["action"])
           for r in manifest.reconcile(requests, files, sidecars, markers, "key").collect()}
    assert got == {
        "ok": ("accepted", "reused"),
        "no_sidecar": ("incomplete", "blocked"),
        "bad_meta": ("bad_metadata", "blocked"),
        "d": ("digest_mismatch", "blocked"),
        "d2": ("digest_mismatch", "refreshed"),
        "marker": ("pending", "blocked"),
        "no_data": ("incomplete", "blocked"),
        "absent": ("absent", "downloaded"),
        "marker_only": ("pending", "blocked"),
        "other_source": ("identity_mismatch", "blocked"),
        "dup": ("duplicate", "blocked"),  # two sidecars for one file fail closed, no pairing
    }


def _manifest(spark, rows):
    df = spark.createDataFrame(rows, "key string, payload string")
    return publish.object_manifest(df, F.col("key"), "payload")


def test_publish_create_only_and_idempotent(spark, workdir):
    target = os.path.join(workdir, "objects")
    m = _manifest(spark, [("a", "alpha"), ("b", "beta"), ("c", "gamma")])
    first = {r["key"]: r["outcome"] for r in publish.publish_rows(spark, m, target).collect()}
    assert first == {"a": "uploaded", "b": "uploaded", "c": "uploaded"}
    files_before = sorted(os.listdir(target))

    again = {r["key"]: r["outcome"] for r in publish.publish_rows(spark, m, target).collect()}
    assert again == {"a": "reused", "b": "reused", "c": "reused"}
    assert spark.read.parquet(target).count() == 3
    data_files = [f for f in os.listdir(target) if f.endswith(".parquet")]
    assert len(data_files) == len([f for f in files_before if f.endswith(".parquet")])


def test_publish_conflicts_never_overwrite(spark, workdir):
    target = os.path.join(workdir, "objects")
    publish.publish_rows(spark, _manifest(spark, [("a", "alpha"), ("b", "beta")]), target)
    changed = _manifest(spark, [("a", "alphA"), ("b", "beta!"), ("n", "new")])
    got = {r["key"]: r["outcome"] for r in publish.publish_rows(spark, changed, target).collect()}
    assert got == {"a": "conflict_digest", "b": "conflict_size", "n": "uploaded"}
    stored = {r["key"]: r["payload"] for r in spark.read.parquet(target).collect()}
    assert stored == {"a": "alpha", "b": "beta", "n": "new"}


def test_receipt_only_when_all_accepted(spark, workdir):
    target = os.path.join(workdir, "objects")
    receipts = os.path.join(workdir, "receipts")
    m = _manifest(spark, [("a", "alpha"), ("b", "beta")])
    result = publish.publish_rows(spark, m, target)
    entries = publish.receipt_entries(result.withColumnRenamed("outcome", "action"))
    path = publish.write_receipt(spark, result, entries, receipts)
    assert path is not None
    back = publish.read_receipt(spark, path)
    assert back.count() == 2 and set(back.columns) >= {"formatVersion", "publicationId", "entry"}
    # the entry JSON keeps its field order and carries no secret or null field
    entry = back.orderBy("key").first()["entry"]
    assert entry.startswith('{"key":"a","bytes":5,"sha256":')

    bad = publish.publish_rows(spark, _manifest(spark, [("a", "other")]), target)
    assert publish.write_receipt(spark, bad, publish.receipt_entries(
        bad.withColumnRenamed("outcome", "action")), receipts) is None
    assert len(os.listdir(receipts)) == 1  # one receipt, never replaced

    # a clean rerun adds exactly one more receipt and changes nothing else
    rerun = publish.publish_rows(spark, m, target)
    assert {r["outcome"] for r in rerun.collect()} == {"reused"}
    publish.write_receipt(spark, rerun, publish.receipt_entries(
        rerun.withColumnRenamed("outcome", "action")), receipts)
    assert len(os.listdir(receipts)) == 2


def test_summary_gate(spark):
    df = spark.createDataFrame([("uploaded",), ("reused",), ("conflict_size",)], "outcome string")
    row = publish.summary(df).first()
    assert (row["passed"], row["failed"], row["all_success"], row["status"]) == (2, 1, False, 1)


def test_zone_rerun_and_uncommitted_batches(spark, workdir):
    root = os.path.join(workdir, "zone")
    rows = spark.createDataFrame([(i, "2026-05" if i < 6 else "2026-06") for i in range(10)],
                                 "id long, month string")
    zone.write_batch(spark, rows, root)
    zone.write_batch(spark, rows.where("month = '2026-05'"), root)
    counts = {r["month"]: r["count"] for r in zone.read_committed(spark, root).groupBy("month").count().collect()}
    assert counts == {"2026-05": 6, "2026-06": 4}
    # data written without a commit row (a crash between the two steps) stays invisible
    rows.withColumn("batch", F.lit("bcrashed")).write.mode("append").partitionBy("month", "batch") \
        .parquet(f"{root}/data")
    assert zone.read_committed(spark, root).count() == 10
    # commits record row counts and fingerprints of what was written
    heads = {r["month"]: r["rows"] for r in zone.committed(spark, root).collect()}
    assert heads == {"2026-05": 6, "2026-06": 4}


def test_month_restricted_read_prunes_partitions(spark, workdir):
    root = os.path.join(workdir, "zone")
    rows = spark.createDataFrame([(i, f"2026-0{5 + i % 3}") for i in range(30)], "id long, month string")
    zone.write_batch(spark, rows, root)
    picked = zone.read_committed(spark, root, ["2026-06"])
    assert picked.count() == 10
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2026-06" in plan


def test_publish_refuses_invalid_keys_and_never_reappends(spark, workdir):
    target = os.path.join(workdir, "objects")
    m = spark.createDataFrame([(None, "x"), ("", "y"), ("/abs", "z"), ("ok", "w")], "key string, payload string")
    m = publish.object_manifest(m, F.col("key"), "payload")
    for _ in range(2):
        got = sorted((r["key"] or "<null>", r["outcome"]) for r in publish.publish_rows(spark, m, target).collect())
        assert [o for _, o in got if _ != "ok"] == ["invalid_key"] * 3
        assert publish.summary(publish.publish_rows(spark, m, target)).first()["all_success"] is False
    assert spark.read.parquet(target).count() == 1


def test_rerun_hides_rejects_of_a_fixed_month(spark, workdir):
    from intactly.functions.rules import Rule
    from intactly.operators import ingest
    paths = ingest.IngestPaths(*(os.path.join(workdir, n) for n in ("zone", "rejects", "fact")))
    bad = spark.createDataFrame([(1, "2026-05", -1), (2, "2026-05", 5), (3, "2026-06", 7)],
                                "id long, month string, v long")
    checks = [Rule("positive", F.col("v") > 0)]
    keep = lambda d: d
    ingest.ingest(spark, [bad], checks, keep, keep, paths)
    assert zone.read_committed(spark, paths.rejects).count() == 1
    fixed = spark.createDataFrame([(1, "2026-05", 4), (2, "2026-05", 5)], "id long, month string, v long")
    ingest.ingest(spark, [fixed], checks, keep, keep, paths)
    assert zone.read_committed(spark, paths.rejects).count() == 0          # May's old reject is hidden
    assert sorted(r["id"] for r in zone.read_committed(spark, paths.zone).collect()) == [1, 2, 3]


def test_first_batch_with_no_rows_commits_empty_months(spark, workdir):
    root = os.path.join(workdir, "zone")
    empty = spark.createDataFrame([], "id long, month string")
    months = spark.createDataFrame([("2026-05",)], "month string")
    zone.write_batch(spark, empty, root, months=months)
    assert {r["month"]: r["rows"] for r in zone.committed(spark, root).collect()} == {"2026-05": 0}
    assert zone.read_committed(spark, root, schema="id long, month string, batch string").count() == 0


def test_cleaned_reader_binds_the_contract(spark, workdir):
    from intactly.operators import ingest
    root = os.path.join(workdir, "zone")
    rows = spark.createDataFrame([(1, "2026-05", "7.5", "extra")], "id int, month string, v string, junk string")
    zone.write_batch(spark, rows, root)
    got = ingest.read_cleaned(spark, root, "id bigint, month string, v decimal(10,2)")
    assert got.dtypes == [("id", "bigint"), ("month", "string"), ("v", "decimal(10,2)")]
    assert [tuple(r) for r in got.collect()] == [(1, "2026-05", __import__("decimal").Decimal("7.50"))]

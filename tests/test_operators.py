"""Smaller operator contracts: epoch replay, checked broadcast, harmonise, receipts, profiles."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from intactly.operators import harmonise, olap, profile, publish, warehouse, zone


def test_epoch_replay_is_idempotent(spark, workdir):
    root = os.path.join(workdir, "zone")
    batch = spark.createDataFrame([(i, "2026-05") for i in range(5)], "id long, month string")
    zone.write_epoch(spark, batch, root, 7)
    zone.write_epoch(spark, batch, root, 7)        # replay after a failure
    zone.write_epoch(spark, batch.limit(2), root, 8)
    assert zone.read_all_committed(spark, root).count() == 7


def test_empty_epoch_commits_nothing(spark, workdir):
    root = os.path.join(workdir, "zone")
    zone.write_epoch(spark, spark.createDataFrame([(1, "2026-05")], "id long, month string"), root, 1)
    zone.write_epoch(spark, spark.createDataFrame([], "id long, month string"), root, 2)
    assert zone.read_all_committed(spark, root).count() == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_respects_the_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100_000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = big.join(warehouse.checked_broadcast(small, 100), "k")
        assert "BroadcastHashJoin" in _plan(joined)
        not_hinted = big.join(warehouse.checked_broadcast(big.select("k"), 100), "k")
        assert "BroadcastHashJoin" not in _plan(not_hinted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_harmonise_case_and_missing_columns(spark):
    may = spark.createDataFrame([(1, 2.5)], "VendorID int, Airport_fee double")
    june = spark.createDataFrame([(2, 1.0, "app")], "vendorid int, airport_fee double, request_source string")
    out = harmonise.harmonise([may, june])
    assert out.columns == ["vendorid", "airport_fee", "request_source"]
    assert sorted(out.collect()) == sorted([(1, 2.5, None), (2, 1.0, "app")])
    with pytest.raises(ValueError):
        harmonise.casefold(spark.createDataFrame([(1, 2)], "a int, A int"))


def test_schema_drift_rows(spark):
    may = spark.createDataFrame([(1, 2.5)], "VendorID int, Airport_fee double")
    june = spark.createDataFrame([(2, 1.0, "app")], "VendorID long, airport_fee double, request_source string")
    got = {r["column_name"]: r["change"] for r in harmonise.schema_drift(spark, may, june).collect()}
    assert got == {"vendorid": "type_changed", "airport_fee": "case_changed", "request_source": "only_right"}


def test_receipt_header_is_order_insensitive(spark):
    rows = [("a", 1, "x", "uploaded"), ("b", 2, "y", "reused")]
    df = spark.createDataFrame(rows, "key string, bytes long, sha256 string, action string")
    rev = spark.createDataFrame(list(reversed(rows)), "key string, bytes long, sha256 string, action string")
    h1 = publish.receipt_header(publish.receipt_entries(df), []).first()
    h2 = publish.receipt_header(publish.receipt_entries(rev), []).first()
    assert h1 == h2 and h1["objects"] == 2 and h1["bytes"] == 3


def test_duplicate_keys_and_lookup_profile(spark):
    zones = spark.createDataFrame([(1, "EWR"), (2, " "), (2, "Queens"), (265, "N/A")],
                                  "LocationID int, Zone string")
    assert [tuple(r) for r in profile.duplicate_keys(zones, ["LocationID"]).collect()] == [(2, 2)]
    p = profile.lookup_profile(zones, "LocationID", "Zone").first()
    assert (p["rows"], p["distinct_keys"], p["blank_names"], p["min_key"], p["max_key"],
            p["has_duplicates"]) == (4, 3, 1, 1, 265, True)


def test_share_trend_integer_arithmetic(spark):
    df = spark.createDataFrame([("2026-01", "a", 1.0), ("2026-01", "b", 3.0), ("2026-02", "a", 2.0),
                                ("2026-03", "a", 4.0)], "month string, member string, amount double")
    df = df.withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    got = {(r["month"], r["member"]): (r["share_ppm"], r["ma3_units"])
           for r in olap.share_trend(df, "month", "member", "amount", 4).collect()}
    assert got[("2026-01", "a")] == (250_000, 10_000)
    assert got[("2026-03", "a")] == (1_000_000, 23_333)


def test_month_partitioned_zone_read_is_pruned(spark, workdir):
    from intactly.sources.tables import read_months
    path = os.path.join(workdir, "clean")
    rows = spark.createDataFrame([(i, f"2026-0{5 + i % 3}") for i in range(30)], "id long, month string")
    zone.write_months(rows, path)
    zone.write_months(rows.where("month = '2026-05'").limit(3), path)  # rerun replaces only May
    assert read_months(spark, path, ["2026-05"]).count() == 3
    assert read_months(spark, path, ["2026-06", "2026-07"]).count() == 20
    assert "PartitionFilters" in _plan(read_months(spark, path, ["2026-06"]))


def test_checked_inventory_raises_for_unlistable_root(spark, workdir):
    from intactly.sources import files
    with pytest.raises(FileNotFoundError):
        files.checked_inventory(spark, os.path.join(workdir, "missing"))
    open(os.path.join(workdir, "empty.marker"), "w").close()
    inv = files.checked_inventory(spark, workdir, "*.marker")
    assert [(r["filename"], r["length"]) for r in inv.collect()] == [("empty.marker", 0)]


def test_provenance_documents_are_appended_and_content_addressed(spark, workdir):
    import hashlib
    import json
    root = os.path.join(workdir, "prov")
    objs = spark.createDataFrame([("k1", 10, None), ("k2", 20, "x")], "key string, bytes long, note string")
    recs = publish.provenance_records(objs, [F.col("key"), F.col("bytes"), F.col("note")])
    publish.write_provenance(recs, root)
    publish.write_provenance(recs, root)  # history is kept, never replaced
    docs = [r["value"] for r in spark.read.text(root).collect()]
    assert len(docs) == 4
    for r in recs.collect():
        assert r["provenance_key"] == f"provenance/{hashlib.sha256(r['provenance_json'].encode()).hexdigest()}.json"
        assert list(json.loads(r["provenance_json"]))[:2] == ["formatVersion", "key"]
    assert "note" not in json.loads(recs.where("key = 'k1'").first()["provenance_json"])


def test_hot_key_scan_is_partitioned_by_key_and_bucket(spark):
    from intactly.operators import history
    rows = [(i, 0 if i % 3 else i % 50, i) for i in range(3000)]   # key 0 holds two thirds
    df = spark.createDataFrame(rows, "id long, k long, t long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = history.ordered_scan(df, "k", ["t", "id"], F.floor(F.col("t") / 100), lead_of="t")
        plan = _plan(out)
        import re
        # the windows over raw rows are partitioned by (key, bucket), never by the key alone
        assert re.search(r"windowspecdefinition\(_kn#\d+, _kv#\d+L, _bn#\d+, _bv#\d+L", plan)
        assert re.search(r"hashpartitioning\(_kn#\d+, _kv#\d+L, _bn#\d+, _bv#\d+L", plan)
        # the per-row side joins on its own partitioning: besides the two row shuffles (row
        # branch, bucket-aggregate branch) only the small per-bucket table is exchanged (twice)
        assert plan.count("Exchange hashpartitioning(_kn") == 4
        assert out.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_month_rows_survive_the_committed_zone(spark, workdir):
    root = os.path.join(workdir, "zone")
    rows = spark.createDataFrame([(1, "2026-05"), (2, None)], "id long, month string")
    zone.write_batch(spark, rows, root)
    assert sorted(r["id"] for r in zone.read_committed(spark, root).collect()) == [1, 2]
    zone.write_epoch(spark, rows, os.path.join(workdir, "stream"), 1)
    assert zone.read_all_committed(spark, os.path.join(workdir, "stream")).count() == 2


def test_scale_settings():
    from intactly.session import scale_settings
    big = scale_settings(100 * 1024 ** 4, 8000)          # 100 TiB on 1000 executors × 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000
    mid = scale_settings(1024 ** 4, 8000)                # 1 TiB: 8192 by size, but two waves of 8000 cores
    assert int(mid["spark.sql.shuffle.partitions"]) == 16_000
    assert int(scale_settings(10 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"]) == 81_920
    small = scale_settings(10 * 1024 ** 2, 8)            # tiny input: at least two waves
    assert int(small["spark.sql.shuffle.partitions"]) == 16

"""Plans: only needed joins; zones: only named batches are listed; requested months and null dates are kept."""

from __future__ import annotations

import os
import re

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from intactly import plans
from intactly.functions.rules import Rule
from intactly.operators import ingest, publish, zone
from intactly.plans import ingest as ingest_plans
from intactly.sources import files


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted(re.findall(r"sf0\.001/(\w+)\.parquet", plan))


def test_indicators_scan_only_what_they_need(spark):
    run = lambda q: _scans(plans.queries()[q](spark, SF_SMALL))
    assert set(run("q44_month_totals")) == {"lineitem"} and len(run("q44_month_totals")) == 1
    assert set(run("q47_topk")) == {"lineitem", "nation", "supplier"}
    for q in ("q45_cube", "q46_grouping_sets", "q48_rank", "q49_share_trend"):
        assert "supplier" not in run(q) and "customer" in run(q)


def test_a_batch_lists_nothing_but_itself(spark, workdir):
    root = os.path.join(workdir, "zone")
    rows = spark.createDataFrame([(i, f"2026-0{1 + i % 3}") for i in range(30)], "id long, month string")
    first = zone.write_batch(spark, rows, root)
    # Another batch's folder cannot even be listed as Parquet: neither writing nor reading may touch it.
    os.makedirs(f"{root}/data/batch=broken/month=2026-01")
    open(f"{root}/data/batch=broken/month=2026-01/part-0.parquet", "w").write("no parquet")
    second = zone.write_batch(spark, rows.where("month = '2026-01'"), root)
    got = zone.read_committed(spark, root)
    assert got.columns == ["id", "month", "batch"] and got.count() == 30
    assert {(r.month, r.batch) for r in got.select("month", "batch").distinct().collect()} == {
        ("2026-01", second), ("2026-02", first), ("2026-03", first)}
    opened = [f for f in zone.read_committed(spark, root, ["2026-01"]).inputFiles() if "/data/" in f]
    assert opened and all(second in f for f in opened)
    with pytest.raises(ValueError):
        zone.read_committed(spark, os.path.join(workdir, "never"))


def test_a_requested_month_without_rows_hides_its_old_ones(spark, workdir):
    paths = ingest.IngestPaths(*(os.path.join(workdir, n) for n in ("zone", "rejects", "fact")))
    checks, keep = [Rule("positive", F.col("v") > 0)], lambda d: d
    rows = spark.createDataFrame([(1, "2026-05", 1), (2, "2026-06", 2)], "id long, month string, v long")
    ingest.ingest(spark, [rows], checks, keep, keep, paths)
    months = spark.createDataFrame([("2026-05",), ("2026-06",)], "month string")
    ingest.ingest(spark, [rows.where("id = 2")], checks, keep, keep, paths, requested=months)
    assert [r.id for r in zone.read_committed(spark, paths.zone).collect()] == [2]


def test_trips_without_a_ship_date_are_delivered(spark):
    early, late = ingest_plans._trip_months(spark, SF_SMALL)
    whole = ingest_plans.trips(spark, SF_SMALL).count()
    assert early.count() + late.count() == whole
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce" in plan.lower() or "isnull" in plan.lower()  # a null date does not fall between the halves


def test_only_a_missing_target_is_an_empty_one(spark, workdir):
    assert publish._read_target(spark, os.path.join(workdir, "absent"), "key string").count() == 0
    os.makedirs(os.path.join(workdir, "odd"))
    open(os.path.join(workdir, "odd", "x.parquet"), "w").write("no parquet")
    with pytest.raises(Exception):
        publish._read_target(spark, os.path.join(workdir, "odd"), "key string").count()


def test_names_of_the_s3_scheme():
    assert files._arrow_uri("s3a://bucket/a b") == "s3://bucket/a b" and files._arrow_uri("/s3a") == "/s3a"
    assert files._arrow_uri("hdfs://h/x") == "hdfs://h/x"

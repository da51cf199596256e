"""Skew-split ordered scans checked against plain windows and a brute-force replay."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from intactly.operators import history


def _log(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rnd.random() < 0.4 else rnd.randint(1, 20)   # user 0 is a hot key
        rows.append((i, user, rnd.randint(0, 5000), rnd.choice([200, 200, 404, 429, 500, 503, None]),
                     rnd.choice([None, None, "timeout"])))
    return spark.createDataFrame(rows, "id long, user long, t long, status int, kind string")


def test_ordered_scan_matches_plain_window(spark):
    df = _log(spark)
    flag = F.col("status") == 404
    scanned = history.ordered_scan(df, "user", ["t", "id"], F.floor(F.col("t") / 100), flag=flag,
                                   lead_of="t")
    w = Window.partitionBy("user").orderBy("t", "id")
    expected = (df.withColumn("_idx", F.row_number().over(w))
                .withColumn("_last_flag_idx", F.max(F.when(flag, F.row_number().over(w))).over(
                    w.rowsBetween(Window.unboundedPreceding, -1)))
                .withColumn("_next", F.lead("t").over(w)))
    cols = ["id", "_idx", "_last_flag_idx", "_next"]
    assert sorted(scanned.select(cols).collect()) == sorted(expected.select(cols).collect())


def _replay(events, max_attempts=3):
    """Brute-force run of the bounded-retry policy over one key's ordered log."""
    out, attempt = {}, 0
    for eid, status, kind in events:
        if status == 200:
            outcome = "success"
        elif kind in ("io", "timeout") or (status is not None and (status == 429 or 500 <= status <= 599)):
            outcome = "transient"
        else:
            outcome = "permanent"
        attempt += 1
        stop = outcome if outcome != "transient" else ("exhausted" if attempt == max_attempts else None)
        out[eid] = (outcome, attempt, 0 if attempt == 1 else min(30000, 1000 * (attempt - 1)), stop)
        if stop is not None:
            attempt = 0
    return out


def test_attempt_audit_against_replay(spark):
    df = _log(spark)
    got = {r["id"]: (r["outcome"], r["attempt_no"], r["wait_ms"], r["stop_reason"])
           for r in history.attempt_audit(df, "user", ["t", "id"], F.floor(F.col("t") / 250),
                                          F.col("status"), F.col("kind")).collect()}
    rows = sorted(df.collect(), key=lambda r: (r["user"], r["t"], r["id"]))
    expected = {}
    for user in {r["user"] for r in rows}:
        expected.update(_replay([(r["id"], r["status"], r["kind"]) for r in rows if r["user"] == user]))
    assert got == expected


def test_latest_version_and_intervals(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 3, "b"), (1, 1, "c"), (2, 5, "d")],
                               "k long, v long, x string")
    latest = {r["k"]: (r["v"], r["x"], r["versions"])
              for r in history.latest_version(df, "k", "v", ["x"]).collect()}
    assert latest == {1: (3, "b", 3), 2: (5, "d", 1)}
    iv = {(r["k"], r["v"]): (r["next_v"], r["is_open"])
          for r in history.validity_intervals(df, "k", "v", F.floor(F.col("v") / 2)).collect()}
    assert iv == {(1, 0): (1, False), (1, 1): (3, False), (1, 3): (None, True), (2, 5): (None, True)}


def test_first_writer(spark):
    df = spark.createDataFrame([(1, "k", 10, "x"), (2, "k", 5, "y"), (3, "k", 7, "y"), (4, "j", 1, "z")],
                               "w long, key string, t long, body string")
    got = {r["w"]: (r["winner"], r["write_status"]) for r in history.first_writer(
        df, ["key"], ["t", "w"], "w", F.sha2("body", 256)).collect()}
    assert got == {2: (2, "created"), 3: (2, "reused"), 1: (2, "conflict"), 4: (4, "created")}


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(1, None, 1, 200, None), (2, None, 2, 404, None), (3, 5, 1, 200, None)],
                               "id long, user long, t long, status int, kind string")
    scanned = history.ordered_scan(df, "user", ["t", "id"], F.floor(F.col("t") / 10), lead_of="t")
    assert sorted(r["id"] for r in scanned.collect()) == [1, 2, 3]
    audited = history.attempt_audit(df, "user", ["t", "id"], F.floor(F.col("t") / 10),
                                    F.col("status"), F.col("kind"))
    assert audited.count() == 3
    fw = history.first_writer(df, ["user"], ["t", "id"], "id", F.col("status").cast("string"))
    assert {r["id"]: r["winner"] for r in fw.collect()} == {1: 1, 2: 1, 3: 3}


def test_quantile_buckets_split_a_dense_hot_key(spark):
    # key 0 holds two thirds of the rows, all inside a narrow stretch of time
    rows = [(i, 0, 1000 + i % 50) if i % 3 else (i, i % 40 + 1, i * 7) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, k long, t long")
    b = history.with_quantile_bucket(df, "t", rows_per_bucket=500)
    per_bucket = b.where("k = 0").groupBy("_qbucket").count().collect()
    assert len(per_bucket) >= 4 and max(r["count"] for r in per_bucket) <= 1500
    # buckets never decrease with t, so the stitched scan equals a plain window
    scanned = history.ordered_scan(b, "k", ["t", "id"], F.col("_qbucket"), lead_of="t")
    w = Window.partitionBy("k").orderBy("t", "id")
    expected = df.withColumn("_idx", F.row_number().over(w)).withColumn("_next", F.lead("t").over(w))
    cols = ["id", "_idx", "_next"]
    assert sorted(scanned.select(cols).collect()) == sorted(expected.select(cols).collect())


def test_quantile_buckets_edge_cases(spark):
    import pytest
    nulls = spark.createDataFrame([(i, 1, None) for i in range(10)], "id long, k long, t long")
    b = history.with_quantile_bucket(nulls, "t", rows_per_bucket=3)
    assert b.where("_qbucket IS NULL").count() == 10
    scanned = history.ordered_scan(b, "k", ["t", "id"], F.col("_qbucket"))
    assert sorted(r["_idx"] for r in scanned.collect()) == list(range(1, 11))
    with pytest.raises(TypeError):
        history.with_quantile_bucket(spark.createDataFrame([("5",)], "t string"), "t")

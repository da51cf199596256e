"""Features as of a moment, rules from tables, profiles from stored sketches."""

from __future__ import annotations

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from intactly.operators import asof, profile, ruletable, validate


def _newest(rows, features, within=None):
    out = {}
    for row_id, key, t in rows:
        known = [f for f in features if key is not None and f[0] == key and f[1] is not None and t is not None
                 and f[1] <= t and (within is None or f[1] >= t - within)]
        best = max(known, key=lambda f: (f[1], f[2]), default=None)
        out[row_id] = (best[1], best[2]) if best else (None, None)
    return out


def test_newest_feature_not_later_against_brute_force(spark):
    rng = random.Random(12)
    key = lambda: rng.choice([None, 1, 1, 1, 1, 2, 3])
    when = lambda: rng.choice([None, *range(40)])
    rows = [(i, key(), when()) for i in range(300)]
    features = [(key(), when(), i) for i in range(120)] + [(9, 1, 500)]
    left = spark.createDataFrame(rows, "id long, k long, t long").repartition(6)
    right = spark.createDataFrame(features, "k long, at long, f long").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = asof.as_of(left, right, "k", "t", "at", ["f"], tie=["f"])
        assert got.columns == ["id", "k", "t", "at", "f"]
        assert {r.id: (r["at"], r.f) for r in got.collect()} == _newest(rows, features)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got.where("at > t").count() == 0
    none = asof.as_of(left, right.limit(0), "k", "t", "at", ["f"])
    assert none.count() == 300 and none.where("f IS NOT NULL").count() == 0
    assert asof.as_of(left.limit(0), right, "k", "t", "at", ["f"]).count() == 0


def test_old_features_count_as_none_and_names_may_clash(spark):
    left = spark.sql("SELECT 1 AS k, TIMESTAMP'2026-05-10' AS ts, 'a' AS v UNION ALL SELECT 1, TIMESTAMP'2026-06-10', 'b'")
    right = spark.sql("SELECT 1 AS k, TIMESTAMP'2026-05-08' AS ts, 'x' AS v")
    got = asof.as_of(left, right, "k", "ts", "ts", ["v"], within="7 days").orderBy("v")
    assert got.columns == ["k", "ts", "v", "feature_ts", "feature_v"]
    assert [(r.v, r.feature_v) for r in got.collect()] == [("a", "x"), ("b", None)]


RULES = [("length", 1, "v", "pattern", None, None, None, ["[a-z]{2}"]),
         ("code", 1, "v", "domain", None, None, None, ["zz"]), ("code", 2, "v", "domain", None, None, None, ["aa", "bb"]),
         ("low", 1, "n", "above", 0.0, None, None, None), ("order", 1, "n", "not_before", None, None, "m", None),
         ("there", 1, "m", "present", None, None, None, None)]


def _reasons(spark, rules, codes=None, inline=ruletable.INLINE_CODES):
    df = spark.createDataFrame([(1, "aa", 5, 3), (2, "cc", 0, 0), (3, "toolong", 1, None), (4, None, None, None)],
                               "id long, v string, n int, m int")
    loaded = ruletable.load(spark.createDataFrame(rules, ruletable.RULE_SCHEMA),
                            codes and spark.createDataFrame(codes, ruletable.CODE_SCHEMA), inline)
    rows, checks = loaded.applied(df)
    return {r.id: r.reasons for r in validate.with_reasons(rows, checks).collect()}, loaded


def test_rules_are_rows_with_versions(spark):
    got, loaded = _reasons(spark, RULES)
    assert got == {1: "", 2: "code@2,low@1", 3: "code@2,length@1,order@1,there@1",
                   4: "code@2,length@1,low@1,order@1,there@1"}
    assert not loaded.lookups
    joined, loaded = _reasons(spark, RULES, inline=1)          # the same list, by a lookup
    assert joined == got and set(loaded.lookups) == {"code"}
    more, _ = _reasons(spark, RULES, codes=[("code", "cc"), ("code", "cc"), ("code", None), ("other", "x")])
    assert more == {**got, 2: "low@1"}                         # copies of a code never multiply rows
    extra, _ = _reasons(spark, [*RULES, ("cap", 7, "n", "range", 0.0, 4.0, None, None)])  # a new rule is a new row
    assert extra[1] == "cap@7"
    with pytest.raises(ValueError):
        _reasons(spark, [("x", 1, "n", "magic", None, None, None, None)])


def test_stored_profiles_merge_and_a_new_month_reads_no_old_one(spark, workdir):
    rng = random.Random(3)
    rows = [(f"2026-0{1 + i % 3}", rng.choice([None, " ", "a", f"w{i}"]), rng.choice([None, i]), [i % 7]) for i in range(6000)]
    df = spark.createDataFrame(rows, "month string, v string, n int, l array<int>")
    path = os.path.join(workdir, "profiles")
    profile.store_profiles(df.where("month < '2026-03'"), "month", path)
    kept = {p: open(p, "rb").read() for p in glob.glob(f"{path}/month=*/*.parquet")}
    for p in kept:
        open(p, "wb").write(b"unreadable")                     # the update must not need them
    profile.store_profiles(df.where("month = '2026-03'"), "month", path)
    for p, data in kept.items():
        open(p, "wb").write(data)
    spark.catalog.refreshByPath(path)
    got = {r.column_name: r for r in profile.merged_profile(profile.read_profiles(spark, path, "month"), (0.25, 0.5)).collect()}
    exact = {r.column_name: r for r in profile.column_profile(df.drop("month")).collect()}
    assert set(got) == set(exact) == {"v", "n", "l"}
    for name, r in got.items():
        assert (r.groups, r.rows, r.nulls, r.blanks) == (3, 6000, exact[name].nulls, exact[name].blanks)
        assert abs(r.distinct - exact[name].distinct_values) <= 0.06 * exact[name].distinct_values
    values = sorted(r[2] for r in rows if r[2] is not None)
    for rank, q in zip((0.25, 0.5), got["n"].quantiles, strict=True):
        assert abs(sum(v <= q for v in values) / len(values) - rank) < 0.02
    assert got["v"].quantiles is None
    # a month stored again replaces itself only
    profile.store_profiles(df.where("month = '2026-03'").limit(10), "month", path)
    again = profile.merged_profile(profile.read_profiles(spark, path, "month")).first()
    assert again.rows == 4010


def test_nothing_stored_profiles_to_nothing(spark):
    df = spark.createDataFrame([], "month string, v string")
    assert profile.merged_profile(profile.profile_parts(df, "month")).count() == 0
    assert profile.profile_parts(df.select(F.lit("m").alias("month"), "v"), "month").count() == 0

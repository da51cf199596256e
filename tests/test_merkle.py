"""Change location by fingerprint trees, and keys that never change."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from intactly.operators import merkle, warehouse


def _copies(spark, workdir, before, after, schema="k long, v string", **bits):
    like = spark.createDataFrame(before, schema)
    roots = []
    for name, rows in (("a", before), ("b", after)):
        roots.append(os.path.join(workdir, name))
        merkle.write_copy(spark.createDataFrame(rows, schema), "k", roots[-1], **bits)
    return like, roots


def _changes(like, roots, **bits):
    return sorted((r.k is not None, r.k, r.change) for r in merkle.changed_keys(like, "k", *roots, **bits).collect())


def test_only_differing_ranges_are_opened(spark, workdir):
    before = [(k, f"v{k}") for k in range(0, 4000)] + [(None, "no key"), (-5, "below"), (10 ** 12, "far")]
    after = [(k, v) for k, v in before if k not in (77, 2048)] + [(5000, "new")]
    after = [(k, "other") if k == 1500 else (k, v) for k, v in after]
    bits = {"leaf_bits": 6, "fan_bits": 2}
    like, roots = _copies(spark, workdir, before, after, **bits)
    ranges = {r[merkle.RANGE] for r in merkle.differing_ranges(spark, *roots, fan_bits=2).collect()}
    assert ranges == {77 >> 6, 2048 >> 6, 5000 >> 6, 1500 >> 6}
    # Every file of the other ranges is destroyed: they must not be reopened.
    for root in roots:
        for path in glob.glob(f"{root}/data/{merkle.RANGE}=*/*.parquet"):
            if int(path.split(f"{merkle.RANGE}=")[1].split("/")[0]) not in ranges:
                open(path, "wb").write(b"gone")
    with pytest.raises(Exception):
        merkle.stored(spark, roots[0], like).agg(F.max("v")).collect()
    assert _changes(like, roots, fan_bits=2) == [(True, 77, "removed"), (True, 1500, "changed"),
                                                 (True, 2048, "removed"), (True, 5000, "added")]
    heights = [merkle.tree(spark, r).agg(F.max("level")).first()[0] for r in roots]
    assert heights[0] >= 3
    top = merkle.tree(spark, roots[0]).groupBy("level").agg(F.sum("rows").alias("n")).collect()
    assert {r.n for r in top} == {len(before)}  # every level stands for all rows


def test_many_ranges_are_joined_instead_of_listed(spark, workdir, monkeypatch):
    before = [(k, "x") for k in range(200)]
    like, roots = _copies(spark, workdir, before, [(k, "y" if k % 10 == 0 else "x") for k in range(200)], leaf_bits=2)
    monkeypatch.setattr(merkle, "LISTED_RANGES", 3)
    assert _changes(like, roots) == [(True, k, "changed") for k in range(0, 200, 10)]


def test_duplicates_nulls_and_empty_copies(spark, workdir):
    rows = [(1, "a"), (1, "a"), (None, "n"), (2, None)]
    like, roots = _copies(spark, os.path.join(workdir, "1"), rows, [(1, "a"), (None, "m"), (2, None)])
    assert _changes(like, roots) == [(False, None, "changed"), (True, 1, "changed")]
    like, roots = _copies(spark, os.path.join(workdir, "2"), rows, rows[::-1])
    assert _changes(like, roots) == []
    like, roots = _copies(spark, os.path.join(workdir, "3"), rows, [])
    assert _changes(like, roots) == [(False, None, "removed"), (True, 1, "removed"), (True, 2, "removed")]
    with pytest.raises(Exception):  # a copy is never written over
        merkle.write_copy(like, "k", roots[0])


def test_keys_are_stable_when_members_are_inserted(spark, workdir):
    path = os.path.join(workdir, "keys")
    table = lambda rows: {(r.a, r.b): r.sk for r in warehouse.assign_keys(
        spark.createDataFrame(rows, "a string, b int, x int"), ["a", "b"], path, "sk").collect()}
    first = table([("m", 1, 0), ("c", None, 0), ("m", 1, 5), ("z", 2, 0)])
    assert first == {("c", None): 1, ("m", 1): 2, ("z", 2): 3}
    files = sorted(os.listdir(path))
    assert table([("z", 2, 0), ("m", 1, 0)]) == first and sorted(os.listdir(path)) == files  # a rerun adds nothing
    second = table([("d", 0, 0), ("c", None, 0), (None, None, 0), ("a", 9, 0)])
    assert {k: v for k, v in second.items() if k in first} == first
    assert {k: v for k, v in second.items() if k not in first} == {(None, None): 4, ("a", 9): 5, ("d", 0): 6}
    df = spark.createDataFrame([("q", 1, 0)], "a string, b int, x int")
    import io
    from contextlib import redirect_stdout
    with redirect_stdout(io.StringIO()) as out:
        warehouse.assign_keys(df, ["a", "b"], path, "sk").explain()
    assert "Window" not in out.getvalue()


def test_many_ranges_share_folders(spark, workdir, monkeypatch):
    monkeypatch.setattr(merkle, "FOLDERS", 4, raising=False)
    # 130 ranges of 4 keys, far ones apart, a negative one and rows without a key.
    keys = [*range(0, 500), -9, *(10 ** 9 + 10 ** 6 * i for i in range(5)), None, None]
    before = [(k, f"v{k}") for k in keys]
    after = [(k, v) for k, v in before if k not in (7, 10 ** 9)] + [(901, "new"), (None, "n")]
    after = [(k, "other" if k == 250 else v) for k, v in after]
    like, roots = _copies(spark, os.path.join(workdir, "1"), before, after, leaf_bits=2)
    for root, rows in zip(roots, (before, after), strict=True):
        folders = glob.glob(f"{root}/data/{merkle.RANGE}=*")
        assert 2 <= len(folders) <= 4 and len(glob.glob(f"{root}/data/*/*.parquet")) <= 8
        leaves = merkle.tree(spark, root).where("level = 0").collect()
        assert sum(r.rows for r in leaves) == len(rows)
        assert {r.node for r in leaves if r.node != merkle.NO_KEY} == {k >> 2 for k, _ in rows if k is not None}
        assert {str(r.folder) for r in leaves} == {f.rsplit("=")[1] for f in folders}
        stored = merkle.stored(spark, root, like).collect()
        assert sorted((str(r.k), r.v) for r in stored) == sorted((str(k), v) for k, v in rows)
    changes = [(False, None, "changed"), (True, 7, "removed"), (True, 250, "changed"), (True, 901, "added"),
               (True, 10 ** 9, "removed")]
    assert _changes(like, roots) == changes
    # More differing ranges than are listed: the folders are pruned, the ranges joined.
    monkeypatch.setattr(merkle, "LISTED_RANGES", 2)
    assert _changes(like, roots) == changes
    # A copy cut into other folders is compared as well, and folders without a difference are not opened.
    monkeypatch.setattr(merkle, "FOLDERS", 1000)
    finer = os.path.join(workdir, "finer")
    merkle.write_copy(spark.createDataFrame([(k, "x" if k == 3 else v) for k, v in before], "k long, v string"), "k", finer,
                      leaf_bits=2)
    for path in glob.glob(f"{finer}/data/{merkle.RANGE}=*/*.parquet"):
        if f"{merkle.RANGE}=0/" not in path:
            open(path, "wb").write(b"gone")
    assert _changes(like, [roots[0], finer]) == [(True, 3, "changed")]

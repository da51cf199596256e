"""Pairs of arrivals in either order, late and lone halves, digests seen before, replayed epochs."""

from __future__ import annotations

import datetime
import os

from intactly.streaming import pairing

T0 = datetime.datetime(2026, 5, 1)


def _land(spark, root, rows, schema):
    rows = [(*r[:2], T0 + datetime.timedelta(minutes=r[2])) for r in rows]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)


class Arrivals:
    def __init__(self, spark, workdir):
        self.spark = spark
        self.data, self.sides, self.out, self.checkpoint = (os.path.join(workdir, n) for n in "dsoc")

    def land(self, data=(), sides=()):
        # both folders must exist for the stream; an arrival without a key is a heartbeat
        _land(self.spark, self.data, list(data), pairing.DATA_SCHEMA)
        _land(self.spark, self.sides, list(sides), pairing.SIDE_SCHEMA)
        return pairing.pair_available(self.spark, self.data, self.sides, self.out, self.checkpoint)

    def status(self):
        return sorted((r.key, r.status) for r in pairing.verdicts(self.spark, self.out).collect())


def test_either_order_late_lone_and_seen_before(spark, workdir):
    a = Arrivals(spark, workdir)
    a.land([("first", "h1", 0), ("lone", "h2", 1)], [("side_first", "h3", 2), ("orphan", "h9", 3)])
    assert a.status() == []                                  # nothing is settled yet: the other halves may come
    a.land([("side_first", "h3", 5)], [("first", "h1", 4), ("first", "h1", 4)])
    assert a.status() == [("first", "ingested"), ("side_first", "ingested")]
    a.land([("copy", "h1", 10), ("b2", "h5", 11), ("b1", "h5", 12), ("bad", "h6", 12)],
           [("copy", "h1", 10), ("b1", "h5", 11), ("b2", "h5", 11), ("bad", "other", 12)])
    assert a.status() == [("b1", "ingested"), ("b2", "duplicate"), ("bad", "digest_mismatch"), ("copy", "duplicate"),
                          ("first", "ingested"), ("side_first", "ingested")]
    a.land([(None, None, 2000)], [(None, None, 2000), ("lone", "h2", 1990)])  # its sidecar comes a day too late
    a.land([(None, None, 5000)], [(None, None, 5000)])
    assert [s for s in a.status() if s[1].endswith("_only")] == [
        ("lone", "data_only"), ("lone", "sidecar_only"), ("orphan", "sidecar_only")]
    assert a.land([(None, None, 5001)], []) >= 0
    assert len(a.status()) == 9


def test_a_replayed_epoch_replaces_its_own_output(spark, workdir):
    a = Arrivals(spark, workdir)
    a.land([("x", "h1", 0)], [("x", "h1", 1)])
    before = a.status()
    stream = next(d for d in os.listdir(a.out) if d.startswith("stream="))
    epoch = max(int(d.split("=")[1]) for d in os.listdir(os.path.join(a.out, stream)))
    # The last commit is lost: the epoch runs again and must see neither its own digests nor add to them.
    for folder in ("commits",):
        names = sorted(os.listdir(os.path.join(a.checkpoint, folder)))
        for n in names:
            if n.lstrip(".").startswith(str(epoch)):
                os.replace(os.path.join(a.checkpoint, folder, n), os.path.join(workdir, f"lost-{n}"))
    a.land([(None, None, 2)], [])
    assert a.status() == before == [("x", "ingested")]

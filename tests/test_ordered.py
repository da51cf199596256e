import random

from pyspark.sql import functions as F

from intactly.operators import history
from intactly.operators.ordered import numbered, sequenced


def test_dense_numbers_with_ties_nulls_and_equal_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice("ab")) for _ in range(300)] + [(2, "b")] * 700
    df = spark.createDataFrame(rows, "k long, v string").repartition(7)
    got = numbered(df, [F.col("k").asc_nulls_first(), F.col("v").desc()], partitions=6).collect()
    assert sorted(r.position for r in got) == list(range(1, 1001))
    ordered = [(r.k, r.v) for r in sorted(got, key=lambda r: r.position)]
    assert ordered == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -ord(r[1])))


def test_equal_rows_are_spread_and_empty_input_stays_empty(spark):
    same = spark.range(1000).select(F.lit(1).alias("k"))
    from intactly.operators.ordered import PART, range_sorted
    sizes = [r["count"] for r in range_sorted(same, [F.col("k")], partitions=8).groupBy(PART).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400
    assert numbered(same.limit(0), [F.col("k")]).count() == 0


def _brute(rows):
    """(key, order, id) -> position, last flagged position before, next order value, whether there is one."""
    out = {}
    first = lambda v: (v is not None, v or 0)
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (first(r[1]), r[2]))
        last = None
        for i, (_, t, row_id, flag) in enumerate(mine):
            after = mine[i + 1] if i + 1 < len(mine) else None
            out[row_id] = (i + 1, last, after[1] if after else None, after is not None)
            last = i + 1 if flag else last
    return out


def test_sequence_facts_of_hot_and_null_keys_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([None, None, *range(30)]), i, rng.random() < 0.2)
            for i in range(600)] + [(100 + i, 1, 1000 + i, True) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, t long, id long, stop boolean").repartition(5)
    for n in (1, 7):
        got = sequenced(df, "k", ["t", "id"], flag=F.col("stop"), lead_of="t", partitions=n)
        assert got.columns == ["k", "t", "id", "stop", "_idx", "_last_flag_idx", "_next", "_has_next"]
        assert {r.id: (r._idx, r._last_flag_idx, r._next, r._has_next) for r in got.collect()} == _brute(rows)


def test_repeated_null_starts_and_ties_keep_their_followers(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 5), (1, 7), (1, 7), (2, None)], "k long, v long")
    got = history.validity_intervals(df, "k", "v").collect()
    assert sorted((r.k, r.v or 0, r.next_v or 0, r.is_open) for r in got) == [
        (1, 0, 0, False), (1, 0, 5, False), (1, 5, 7, False), (1, 7, 0, True), (1, 7, 7, False), (2, 0, 0, True)]
    assert history.validity_intervals(df.limit(0), "k", "v").count() == 0

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from intactly.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, id string, v string, score string"


def brute(rows, k):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_against_brute_force(spark, block):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(400, None), (410, [0.1, None]), (401, [math.nan] * 8), (402, [math.inf] + [0.0] * 7), (None, [0.1] * 8),
             (420, []), (430, [0.5, -0.5]), (403, [1.0] * 12), (10, rows[10][1]), (11, rows[12][1])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    got = vectors.top_k(df, F.col("vec_id") % 10 == 0, k=5, block_queries=block).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == ranked_again(brute(rows, 5))


def ranked_again(rows):
    return sorted(rows)


def test_huge_components_and_few_rows(spark):
    rows = [(0, [3e38, -3e38]), (1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [1e20, 1e20])]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = vectors.top_k(df, F.col("vec_id") == 0, k=10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 3, 2] and got[0].score == 2 ** 63 - 1
    assert vectors.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert vectors.top_k(df, F.col("vec_id") == 99).count() == 0


def test_cells_hold_their_components():
    v = np.floor(np.random.default_rng(1).normal(0, 300, (200, 6)))
    v[:, 2] = 7
    lower, upper = vectors.cell_bounds(v, 16)
    assert (lower <= v).all() and (v <= upper).all()

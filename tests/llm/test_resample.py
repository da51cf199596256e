import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import documents, edge_rows, prose

from intactly.llm import resample

ITEMS = "item_id long, text string, bucket string, n string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def runs(text, widths):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(widths[0], widths[1] + 1) for i in range(len(w) - n + 1)]


def brute(docs, items, buckets, widths, least, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source = Counter(bucket(f) for _, t in docs for f in runs(t, widths))
    target = Counter(bucket(f) for _, t in items for f in runs(t, widths))
    s_all, t_all = sum(source.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))
            for b in range(buckets)]
    out = []
    for i, text in docs:
        found = [gain[bucket(f)] for f in runs(text, widths)]
        weight, score = sum(found) // len(found) if found else 0, None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        out.append([i, len(found), weight, score, None, len(words(text))])
    able = sorted((r for r in out if r[3] is not None and r[5] >= least), key=lambda r: (-r[3], r[0], r[1]))
    for k, row in enumerate(able[:percent * len(able) // 100]):
        row[4] = k + 1
    return sorted(str(tuple(r[:5])) for r in out)


def sample():
    rng = random.Random(8)
    docs = edge_rows(rng) + [(100 + i, prose(rng, rng.choice([1, 19, 20, 21, 200]))) for i in range(80)]
    docs += [(300, prose(random.Random(1), 30))] * 40 + [(301 + i, "the " * 70_000) for i in range(2)]
    return docs, [(i, prose(rng, 50)) for i in range(5)] + [(5, None), (None, "It ÉTÉ it")]


@pytest.mark.parametrize("buckets, widths, least, percent", [(10_000, (1, 1), 20, 10), (97, (1, 3), 5, 60)])
def test_against_brute_force(spark, buckets, widths, least, percent):
    docs, items = sample()
    target = spark.createDataFrame([(*x, "b", "n") for x in items], ITEMS)
    got = resample.resample(documents(spark, docs), target, buckets, widths, least_words=least, percent=percent)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, items, buckets, widths, least, percent)


def test_empty_tables(spark):
    docs, items = sample()[0][:30], []
    none = spark.createDataFrame([], ITEMS)
    got = resample.resample(documents(spark, docs), none, least_words=2)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, items, 10_000, (1, 1), 2, 10)
    assert resample.resample(documents(spark, docs).limit(0), none).count() == 0


@pytest.mark.parametrize("low, high", [(-40_000, 40_000), (0, 5), (-1, 0), (-64, 63)])
def test_planes_give_exact_sums(low, high):
    rng = np.random.default_rng(high)
    gain = rng.integers(low, high + 1, 1000)
    gain[:2] = low, high
    found = [rng.integers(0, 1000, n).tolist() + [7] * rep for n, rep in ((0, 0), (1, 0), (500, 3000), (9, 1))]
    assert resample.Planes(gain).sums(found).tolist() == [int(gain[f].sum()) for f in found]
    assert resample.Planes(gain).sums([]).tolist() == []

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
from fixtures_llm import documents, edge_rows, prose

from intactly.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def test_probabilities_sum_to_one_and_match_a_plain_model(spark):
    texts = ["abracadabra", "abba", "a cab"]
    df = documents(spark, list(enumerate(texts)))
    model = quality.Model.of(quality.probabilities(quality.gram_counts(df)))
    every = np.arange(1 << 16, dtype=np.uint64)
    for history in ("abr", "\0\0a", "zzz", "cab"):
        h = np.uint64(0)
        for c in history:
            h = (h << np.uint64(16)) | np.uint64(ord(c))
        keys = (h << np.uint64(16)) | every
        assert abs(np.exp(model.log_p(keys)).sum() - 1) < 1e-9


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(30, 120))) for i in range(200)]
    rows += [(1000 + i, " ".join(rng.choice("#$%&|") * 3 + w.upper() for w in prose(rng, 50).split())) for i in range(20)]
    edges = edge_rows(rng)[:6]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(1000, 0, 0), (None, 1, 0), (1, None, 0)], LABELS)
    df = documents(spark, rows + edges)
    scored = quality.perplexities(df, quality.train(df, labels, rows=60))
    got = quality.judged(scored, quality.thresholds(scored, labels)).collect()
    assert len(got) == len(rows) + len(edges)
    keep = {r.doc_id: r.keep for r in got}
    assert not any(keep[1000 + i] for i in range(20))
    assert sum(keep[i] for i in range(200)) >= 190
    assert keep[1] and keep[2]  # no units: kept
    kept = quality.good(df, labels)
    assert kept.columns == df.columns and 195 <= kept.count() <= 210


def test_without_trusted_text_all_stay(spark):
    df = documents(spark, [(1, "a b"), (2, None), (None, "###")])
    labels = spark.createDataFrame([], LABELS)
    scored = quality.perplexities(df, quality.train(df, labels))
    assert all(r.keep for r in quality.judged(scored, quality.thresholds(scored, labels)).collect())
    assert quality.good(df, labels).count() == 3
    assert quality.good(df.limit(0), labels).count() == 0


def test_keys_join_shard_by_shard():
    keys = np.sort(np.random.default_rng(4).integers(0, 2 ** 63, 100, np.uint64))
    p = np.linspace(0.1, 0.9, 100)
    model = quality.Model([(np.empty(0, np.uint64), np.empty(0))] * 3, [(np.empty(0, np.uint64), np.empty(0))] * 4,
                          list(zip(np.array_split(keys, 16), np.array_split(p, 16), strict=True)))
    assert np.allclose(np.exp(model.log_p(keys[::3])), p[::3])


def plain_model(texts, order=4):
    """p(unit | history) of an interpolated modified Kneser-Ney model, from dictionaries."""
    runs = lambda t: [tuple("\0" * (order - 1) + t)[i:i + order] for i in range(len(t))]
    counts = {order: Counter(g for t in texts for g in runs(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])  # in how many longer ones it is the end
    cuts, totals = {}, {}
    for k, level in counts.items():
        n1, n2, n3, n4 = (sum(n == m for n in level.values()) for m in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
        cuts[k] = [min(max(d, 0.05), most) for d, most in zip(raw, (0.95, 1.9, 2.9), strict=True)]
        totals[k] = defaultdict(lambda: [0, 0.0])
        for g, n in level.items():
            totals[k][g[:-1]][0] += n
            totals[k][g[:-1]][1] += cuts[k][min(n, 3) - 1]

    def p(g):
        if not g:
            return 1 / 65536
        k, lower = len(g), p(g[1:])
        if g[:-1] not in totals[k]:
            return lower
        total, held = totals[k][g[:-1]]
        n = counts[k][g]
        return (n - cuts[k][min(n, 3) - 1] if n else 0) / total + held / total * lower

    def perplexity(t):
        return math.exp(-sum(math.log(p(g)) for g in runs(t)) / len(t)) if t else None

    return perplexity


def test_perplexities_are_those_of_a_plain_model(spark):
    rng = random.Random(14)
    trusted = [prose(rng, rng.randint(1, 30)) for _ in range(40)] + ["", None, "aaaa aaaa", "é ß é", trusted_twice := "the the"]
    trusted += [trusted_twice]
    model = quality.Model.of(quality.probabilities(quality.gram_counts(documents(spark, list(enumerate(trusted))))))
    plain = plain_model([t or "" for t in trusted])
    held = [prose(rng, 40), "a", "zzzz qqq", "中é", "", None, trusted[0], "THE the"]
    _, got = model.perplexities(held)
    for text, found in zip(held, got, strict=True):
        want = plain(text or "")
        assert found is None if want is None else abs(found - want) < 1e-9 * want


def test_every_trusted_document_counts_and_rare_keys_are_joined(spark):
    rng = random.Random(31)
    trusted = [prose(rng, rng.randint(5, 30)) for _ in range(60)]
    texts = [*trusted, *trusted[:3], prose(rng, 40), "zzzz qqq", "中é", "a", "", None, trusted[0] + "!"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "the")]
    df = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(63)] + [(63, 0, 0), (None, 1, 0), (64, None, 0)], LABELS)
    plain = plain_model({texts[i] for i in range(63) if crc32(str(i).encode()) % 4 != 2})  # copies count once
    tables = quality.train(df, labels)
    want = sorted(str((i, None if not t else round(plain(t), 9))) for i, t in rows)
    for most in (quality.HELD, 100, 0):
        got = quality.perplexities(df, tables, most=most).collect()
        assert sorted(str((r.doc_id, r.perplexity if r.perplexity is None else round(r.perplexity, 9))) for r in got) == want
        assert all(r.n_units == len((texts[r.doc_id] or "").encode("utf-16-le")) // 2 for r in got if r.doc_id is not None)
        held = sum(len(k) for k, _ in quality.Model.frequent(tables, most).shards)
        assert held <= most and (most < quality.HELD or held == tables[-1][0].count())


def test_good_keeps_what_is_judged_to_be_kept(spark):
    rng = random.Random(32)
    rows = [(i, prose(rng, 30)) for i in range(80)] + [(100 + i, "#$%" * (20 + i)) for i in range(4)]
    df = documents(spark, rows + [(100, rows[0][1]), (None, "#$%" * 20), (1, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(70)], LABELS)
    scored = quality.perplexities(df, quality.train(df, labels))
    want = sorted(str(r.doc_id) for r in quality.judged(scored, quality.thresholds(scored, labels)).collect() if r.keep)
    assert sorted(str(r.doc_id) for r in quality.good(df, labels).collect()) == want


def test_more_trusted_documents_than_the_old_sample(spark):
    rows = [(i, f"{i:05d}") for i in range(6000)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6000)], LABELS)
    tables = quality.train(documents(spark, rows + rows[:50]), labels)
    units = sum(5 for i, _ in rows if crc32(str(i).encode()) % 4 != 2)
    assert units > 5 * 4000 and tables[-1][0].groupBy().sum("n").first()[0] == units

import math
import random
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import documents, edge_rows, prose
from pyspark.sql import functions as F

from intactly.llm import lmscore


def test_gradient_is_that_of_the_mean_log_probability():
    rng = np.random.default_rng(9)
    net = lmscore.Network.start(rng.integers(1, 50, lmscore.VOCABULARY).astype(float))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, around = lmscore.windows([rng.integers(1, lmscore.VOCABULARY, 30), rng.integers(1, 9, 5)])
    g = net.gradient(words, around)
    for name in g:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        value, e = net.p[name][at], 1e-3
        net.p[name][at] = value + e
        up = net.log_p(words, around).mean(dtype=np.float64)
        net.p[name][at] = value - e
        down = net.log_p(words, around).mean(dtype=np.float64)
        net.p[name][at] = value
        assert abs((up - down) / (2 * e) - g[name][at]) < 2e-3 * max(1, abs(g[name][at]))


def test_probabilities_sum_to_one():
    net = lmscore.Network.start(np.ones(lmscore.VOCABULARY))
    around = np.tile(np.array([[3], [5], [0], [9]]), lmscore.VOCABULARY)
    assert abs(np.exp(net.log_p(np.arange(lmscore.VOCABULARY), around)).sum() - 1) < 1e-3


@pytest.mark.parametrize("run_bytes", [8, 64, lmscore.RUN_BYTES])
def test_words_are_spelled_alike_wherever_they_stand(run_bytes):
    rng = random.Random(4)
    texts = [t for _, t in edge_rows(rng)][:8] + ["A b\x0bc\x0cD\r\n e", "é中 ab\u0000 ab\u00a0ab", "", " x ", None]
    n, names, tails = lmscore.Spelling(run_bytes)(texts)
    words = [w for t in texts for w in lmscore.words_of(t)]
    assert n.tolist() == [len(lmscore.words_of(t)) for t in texts] and len(words) == len(names) == len(tails)
    of = dict(zip(words, names.tolist(), strict=True))
    assert [of[w] for w in words] == names.tolist() and len(set(of.values())) == len(of)
    assert tails.tolist() == [int.from_bytes(w[-3:], "big") for w in words]
    n, names, _ = lmscore.Spelling(run_bytes)([])
    assert len(n) == len(names) == 0


def test_endings_are_the_same_in_spark_and_numpy(spark):
    tails = np.random.default_rng(3).integers(0, 2 ** 24, 500)
    df = spark.createDataFrame([(int(t),) for t in tails], "tail long")
    for side in (32, 40, 90):
        got = {r.tail: r.e for r in df.select("tail", lmscore.ending_of(F.col("tail"), side).alias("e")).collect()}
        want = lmscore.ending_of(tails, side)
        assert [got[int(t)] for t in tails] == want.tolist()
        assert 0 <= want.min() and want.max() < lmscore.endings_of(side)[0]


def test_added_rows_are_the_sums(spark):
    rows = [(i, bytearray(np.array([i, 2.0 * i]).tobytes())) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "read long, flat binary").repartition(5)
    got = lmscore.added(df).collect()
    assert len(got) == 1 and got[0].read == 780 and np.frombuffer(got[0].flat).tolist() == [780.0, 1560.0]
    assert lmscore.added(df.limit(0)).collect() == []


def test_windows_stay_in_their_text():
    words, around = lmscore.windows([np.array([1, 2, 3]), np.array([], int), np.array([4])])
    assert words.tolist() == [1, 2, 3, 4]
    assert around.T.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0], [0, 0, 0, 0]]


def test_training_helps_on_held_out_text_and_edges(spark):
    rng = random.Random(10)
    pairs = [("red", "apple"), ("blue", "sky"), ("green", "grass"), ("cold", "ice")]
    say = lambda n: " ".join(" ".join(rng.choice(pairs)) for _ in range(n))
    df = documents(spark, [(i, say(400)) for i in range(120)] + edge_rows(rng))
    held = documents(spark, [(1, say(300)), (2, prose(rng, 300)), (3, None), (4, "")])
    model = lmscore.train(df)
    got = {r.doc_id: r for r in lmscore.scores(held, model).collect()}
    start = lmscore.scores(held, lmscore.train(df, rounds=())).where("doc_id = 1").first()
    assert got[1].mean_log_prob > start.mean_log_prob + 0.1
    assert got[1].mean_log_prob > got[2].mean_log_prob
    assert (got[3].n_words, got[3].log_prob, got[3].mean_log_prob) == (0, 0.0, None) and got[4].n_words == 0
    assert abs(got[1].log_prob - got[1].mean_log_prob * got[1].n_words) < 1e-6
    assert lmscore.scores(held.limit(0), model).count() == 0
    assert lmscore.scores(held, lmscore.train(df.limit(0))).count() == 4


def test_words_that_share_an_id_have_their_own_probabilities(spark):
    common = " ".join(f"w{i}" for i in range(lmscore.VOCABULARY))
    df = documents(spark, [(i, common) for i in range(6)] + [(9, "zzxq zzxq zzxq zzxq yyxq")])
    held = documents(spark, [(1, "zzxq"), (2, "yyxq"), (2, "yyxq"), (3, "invented-xq"), (None, "zzxq zzxq"), (5, "w5")])
    got = lmscore.scores(held, lmscore.train(df, rounds=())).collect()
    of = {r.doc_id: r.log_prob for r in got}
    assert len(got) == 6 and [r.n_words for r in got if r.doc_id is None] == [2]
    assert abs(of[1] - of[2] - np.log(4)) < 1e-5
    assert of[3] == of[2] < of[1]


def test_ids_grow_with_the_distinct_words():
    sides = [lmscore.side_of(10 ** k) for k in range(10)]
    assert sides[0] == lmscore.LEAST_SIDE and sides == sorted(sides) and sides[9] > sides[7] > sides[6] > sides[0]
    net = lmscore.Network.start(np.ones(sides[6] ** 2))
    words = np.array([1, sides[6] ** 2 - 1])
    same = lmscore.Network.of(net.flat(), sides[6])
    assert np.array_equal(net.log_p(words, np.ones((4, 2), int)), same.log_p(words, np.ones((4, 2), int)))


def plain_scores(model, corpus, texts):
    """The sum over a text's words of log p(word | words on both sides), one word after the other."""
    side = math.isqrt(len(model.by_id))
    net, ids = lmscore.Network.of(model.flat, side), lmscore.Ids(model.frequent, side)
    count = Counter(w for t in corpus for w in lmscore.words_of(t))
    soft = lambda z: z - z.max() - math.log(np.exp(z - z.max()).sum())
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    out = []
    for text in texts:
        words, total = lmscore.words_of(text), 0.0
        own = [int(i) for i in ids(text)]
        for i, word in enumerate(words):
            around = [own[j] if 0 <= j < len(own) else 0 for j in (i - 2, i - 1, i + 1, i + 2)]
            h = np.tanh(p["hidden"] + sum(p["embed"][k][w] for k, w in enumerate(around)))
            kind, member = divmod(own[i], side)
            total += soft(h @ p["to_class"] + p["class_bias"])[kind]
            total += soft(h @ p["to_member"][kind] + p["member_bias"][kind])[member]
            if own[i] >= ids.first:  # the word's share of the id it shares
                total += math.log(max(1, count[word])) - math.log(model.by_id[own[i]] + 1)
        out.append((len(words), total))
    return out


def test_scores_are_those_of_the_plain_pseudo_likelihood(spark):
    rng = random.Random(31)
    common = [prose(rng, 400) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(common)] + edge_rows(rng)[:5] + [(50, "zzxq zzxq yyxq é 中")]
    df = documents(spark, rows)
    held = [(1, common[3][:300]), (2, "zzxq yyxq neverseen-q"), (3, None), (4, "one"), (5, prose(rng, 80).upper())]
    model = lmscore.train(df)
    got = {r.doc_id: r for r in lmscore.scores(documents(spark, held), model).collect()}
    for (i, _), (n, total) in zip(held, plain_scores(model, [t for _, t in rows], [t for _, t in held]), strict=True):
        assert got[i].n_words == n and abs(got[i].log_prob - total) < 1e-3 * max(1, n)

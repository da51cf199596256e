import random

import numpy as np
from fixtures_llm import documents, edge_rows, prose
from pyspark.sql import functions as F

from intactly.llm import toxicity
from intactly.llm.labelled import fold, labelled_sample

LABELS = "doc_id long, quality int, toxic int, text string, y string"


def planted(rng, n=400):
    rows, labels = [], []
    for i in range(n):
        w, bad = prose(rng, rng.randint(20, 80)).split(), i % 4 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grubwort", "Schurkenei", "SCHURKENUNG", "gr0bian"]))
        rows.append((1000 + i, " ".join(w)))
        labels.append((1000 + i, 1, int(bad), "t", "y"))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(7)
    rows, labels = planted(rng)
    edges = edge_rows(rng)
    df = documents(spark, rows + edges)
    marks = spark.createDataFrame(labels + [(1, 0, 1, "", ""), (None, 0, 1, "", ""), (2, 0, None, "", "")], LABELS)
    model = toxicity.train(df, marks)
    got = toxicity.scores(df, model).withColumn("out", fold(F.col("doc_id")) == 2).collect()
    assert len(got) == len(rows) + len(edges)
    assert all(0 <= r.score <= 1 for r in got)
    truth = {i: t for i, _, t, *_ in labels}
    out = [(r.score >= toxicity.THRESHOLD, truth[r.doc_id]) for r in got if r.out and r.doc_id in truth]
    assert len(out) > 50 and np.mean([p == t for p, t in out]) > 0.95
    kept = toxicity.clean(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.score < toxicity.THRESHOLD for r in got)


def test_sample_leaves_out_fold_two_and_is_bounded(spark):
    rows = [(i, f"text {i}") for i in range(200)] + [(500, "text 3")]
    labels = [(i, 1, i % 2, "t", "y") for i in range(200)] + [(3, 1, 0, "t", "y")]
    sample = labelled_sample(documents(spark, rows), spark.createDataFrame(labels, LABELS), "toxic", 50).collect()
    assert len(sample) == 50
    held = {f"text {r.id}" for r in spark.range(200).where(fold(F.col("id")) == 2).collect()}
    assert held and not held & {r.text for r in sample}


def test_without_labels_or_rows(spark):
    df = documents(spark, [(1, "a b"), (2, None)])
    none = toxicity.train(df, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.scores(df, none).collect()} == {0.0}
    assert toxicity.scores(df.limit(0), none).count() == 0
    one_kind = toxicity.train(df, spark.createDataFrame([(1, 1, 1, "", "")], LABELS))
    assert {r.score for r in toxicity.scores(df, one_kind).collect()} == {1.0}


def test_isotonic_is_the_monotone_least_squares_fit():
    z, y = np.array([3.0, 1, 2, 4, 5]), np.array([0.0, 0, 1, 1, 1])
    _, values = toxicity.isotonic(z, y)
    assert values.tolist() == [0.0, 0.5, 1.0] and (np.diff(values) >= 0).all()


def test_trees_learn_an_interaction():
    x = np.random.default_rng(2).normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.fit_trees(x, y)
    assert ((model.raw(x) > 0) == y).mean() > 0.95

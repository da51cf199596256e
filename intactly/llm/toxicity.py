"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration.

A bounded sample of labelled documents is split by text hash: three quarters give a lexicon (words and word beginnings
that toxic texts hold far more often) and fit the trees, one quarter fits the calibration. Features of a text are lexicon
densities (whole text and densest window), nearness of lexicon words to second-person words, and rates of capitals,
punctuation and obfuscation. Labels, language, source and id are never inputs of a score.

The score is the isotonic probability, with a small share of the trees' own probability so that it keeps their order
within a step. Null and empty texts have a score as texts with no words. With no labelled rows, or labels of one kind
only, every score is the mean label (0 without rows). Repeated rows get a row each.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.llm.common import BoundedCache, filter_rows, map_texts, table
from intactly.llm.labelled import fold, labelled_sample

#: Labelled documents that the model is fitted on, at most.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
#: A lexicon unit is in at least so many toxic sample texts, and its log odds ratio is at least so high.
LEAST_TEXTS, LEAST_ODDS = 5, 2.5
LEXICON_UNITS = 5_000
CACHE_ENTRIES = 600_000
WINDOW = 40
NEAR = 5

# Second-person words of the four languages.
SECOND_PERSON = frozenset("""you your yours yourself u ur du dich dir dein deine deiner deinen deinem ihr euch euer eure tu te toi
ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra""".split())
# Signs that stand for letters.
_LETTERS = str.maketrans("013457@$!€", "oieastasie")
_EDGES = re.compile(r"^[^\w@$€*]+|[^\w@$€*]+$")
_INNER = re.compile(r"[^\W_]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_REPEATED = re.compile(r"([!?.#$%&*])\1+")

# Bits of a word's code; the lexicon tier takes the lowest two.
_YOU, _CAPS, _ODD, _HIDDEN = 4, 8, 16, 32
FEATURES = 21


def plain_word(raw: str) -> str:
    """Lower-case letters of a token, with look-alike signs read as letters and separators dropped."""
    return "".join(_INNER.findall(raw.lower().translate(_LETTERS)))


def units(word: str) -> list[str]:
    """The word and its beginnings of 4 to 6 letters."""
    return [word] + [word[:k] + "-" for k in (4, 5, 6) if len(word) >= k]


class Words:
    """Codes of raw tokens under a lexicon {unit: tier 1 to 3}."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.codes = BoundedCache(self._code, CACHE_ENTRIES)

    def _code(self, raw: str) -> int:
        core = _EDGES.sub("", raw)
        word = plain_word(core)
        code = max((self.lexicon.get(u, 0) for u in units(word)), default=0)
        code |= _YOU * (word in SECOND_PERSON)
        code |= _CAPS * (len(core) > 1 and core.isupper())
        odd = any(not c.isalpha() and c not in "'’-" for c in core) and any(c.isalpha() for c in core)
        code |= _ODD * odd
        return code | _HIDDEN * (bool(code & 3) and odd)

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        raw = text.split()
        n = max(1, len(raw))
        chars = max(1, len(text))
        code = np.array(list(map(self.codes.__getitem__, raw)), np.int64)
        tier = code & 3
        at, you = np.flatnonzero(tier), np.flatnonzero(code & _YOU)
        strong = np.flatnonzero(tier == 3)
        dense = int((np.searchsorted(at, at + WINDOW) - np.arange(len(at))).max()) if len(at) else 0
        near, close = 0.0, 0
        if len(at) and len(you):
            after = np.searchsorted(you, at)
            gap = np.minimum(np.abs(at - you[np.minimum(after, len(you) - 1)]),
                             np.abs(at - you[np.maximum(after - 1, 0)]))
            near, close = 1 / (1 + float(gap.min())), int((gap <= NEAR).sum())
        capitals = len(_CAPITALS.findall(text))
        counts = [text.count(c) for c in "!?*#$%&|"]
        return [
            np.log1p(len(raw)), len(at), len(at) / n, (tier == 1).sum() / n, (tier == 2).sum() / n, len(strong) / n,
            len(strong), len({raw[i] for i in at}), dense, len(at) / np.sqrt(n),
            near, close / n, len(you) / n,
            capitals / chars, (code & _CAPS > 0).sum() / n,
            counts[0] / chars, counts[1] / chars, sum(counts[2:]) / chars, len(_REPEATED.findall(text)) / n,
            (code & _ODD > 0).sum() / n, (code & _HIDDEN > 0).sum() / n,
        ]


def lexicon_of(sample: DataFrame) -> dict[str, int]:
    """Units that toxic texts hold far more often, by tier; counts are made on the executors."""
    toxic, clean = sample.where("y >= 0.5"), sample.where("y < 0.5")
    n_toxic, n_clean = toxic.count(), clean.count()

    def counted(texts: DataFrame, of: frozenset | None) -> DataFrame:
        def run(frames):
            found: Counter = Counter()
            for frame in frames:
                for text in frame["text"]:
                    here = {u for w in set(text.split()) for u in units(plain_word(_EDGES.sub("", w)))}
                    found.update(here if of is None else here & of)
            if found:
                yield pd.DataFrame({"unit": list(found.keys()), "n": list(found.values())})

        return texts.select("text").mapInPandas(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))

    often = (counted(toxic, None).where((F.col("n") >= LEAST_TEXTS) & (F.length("unit") > 1))
             .orderBy(F.desc("n"), "unit").limit(10 * LEXICON_UNITS).collect())
    hits = {r["unit"]: r["n"] for r in often}
    misses = {r["unit"]: r["n"] for r in counted(clean, frozenset(hits)).collect()} if hits else {}
    odds = {u: np.log((n + .5) / (n_toxic - n + .5)) - np.log((misses.get(u, 0) + .5) / (n_clean - misses.get(u, 0) + .5))
            for u, n in hits.items()}
    best = sorted((u for u in odds if odds[u] >= LEAST_ODDS), key=lambda u: (-hits[u] * odds[u], u))[:LEXICON_UNITS]
    # Tier 3: often and nearly only in toxic texts; a unit seen in few texts may be of one group of near copies.
    enough = max(LEAST_TEXTS, 0.01 * n_toxic)
    return {u: 3 if odds[u] >= 5 and hits[u] >= enough else 2 if odds[u] >= 4 else 1 for u in best}


@dataclass
class Trees:
    """Boosted trees of a fixed depth: feature and threshold by inner node, value by leaf."""

    base: float
    depth: int = 3
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
              least_weight: float = 5.0, ridge: float = 1.0) -> Trees:
    """Logistic loss, Newton steps, splits at quantile bins."""
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(float(np.log(p0 / (1 - p0))), depth)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)]
    raw = np.full(len(y), model.base)
    for _ in range(rounds):
        p = sigmoid(raw)
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f, (e, c) in enumerate(zip(edges, codes, strict=True)):
                if not len(e):
                    continue
                cell = (node - first) * bins + c
                gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(axis=1)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[(hs < least_weight) | (ht - hs < least_weight)] = 0
                gain = gain[:, :len(e)]
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], feature[first + k], threshold[first + k] = top[k], f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - (2 ** depth - 1)
        value = rate * np.bincount(leaf, g, 2 ** depth) / (np.bincount(leaf, h, 2 ** depth) + ridge)
        raw += value[leaf]
        model.feature.append(feature)
        model.threshold.append(threshold)
        model.leaf.append(value)
    return model


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``y`` by ``z`` (pool adjacent violators): scores and values to interpolate between."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of z
    for zi, yi in zip(z[order], y[order], strict=True):
        blocks.append([float(yi), 1.0, float(zi)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, s = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + m * w) / (last[1] + w)
            last[1] += w
            last[2] += s
    return np.array([s / w for _, w, s in blocks]), np.array([m for m, *_ in blocks])


@dataclass
class Model:
    """Everything a task needs; a few hundred kB."""

    mean: float
    lexicon: dict[str, int] = field(default_factory=dict)
    trees: Trees | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def scorer(self):
        words = Words(self.lexicon)

        def score(texts: list[str | None]) -> np.ndarray:
            if self.trees is None or not texts:
                return np.full(len(texts), self.mean)
            raw = self.trees.raw(np.array([words.features(t) for t in texts], np.float64))
            return np.clip(0.98 * np.interp(raw, *self.steps) + 0.02 * sigmoid(raw), 0, 1)

        return score


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, "toxic", rows).withColumn(
        "part", F.conv(F.substring("same", 1, 8), 16, 10).cast("long") % 4)
    lexicon = lexicon_of(sample.where("part > 0"))

    def factory():
        words = Words(lexicon)
        return lambda texts: [[words.features(t) for t in texts]]

    # At most ``rows`` rows of FEATURES numbers reach the driver.
    got = map_texts(sample, "x array<double>", factory, carry=("same", "part", "y")).toPandas().sort_values("same")
    y = (got["y"] >= 0.5).to_numpy(np.float64)
    mean = float(y.mean()) if len(y) else 0.0
    fit = got["part"].to_numpy() > 0
    if not 0 < y[fit].sum() < fit.sum() or fit.all():
        return Model(mean)
    x = np.stack(got["x"].to_numpy()).astype(np.float64)
    trees = fit_trees(x[fit], y[fit])
    return Model(mean, lexicon, trees, isotonic(trees.raw(x[~fit]), y[~fit]))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        score = shared.value.scorer()
        return lambda texts: [score(texts)]

    return map_texts(docs, "score double", factory)


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        score = shared.value.scorer()
        return lambda batch: score(batch.column("text").to_pylist()) < threshold

    return filter_rows(docs, factory)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scores(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op6_toxicity": op6_toxicity}
SQL: dict[str, str] = {}

"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters (UTF-16 units), order 4: an n-gram is a 64-bit key of four units. Trusted text is that of
every document labelled as good whose fold is not 2; exact copies count once. The documents of fold 2 are held out for the
thresholds, which would be too low if the model had seen all the texts they are taken from. Its n-gram counts are made by Spark; continuation counts,
history totals and interpolated probabilities come from joins of the count tables on history and suffix, dealt over the
shuffle's shards.

The most frequent n-grams, HELD at most, are broadcast in key order, cut into shards; each batch of documents sorts its
distinct n-grams and joins them with one shard after the other, so no text is shuffled. The n-grams that are left (rare
or unseen ones) are joined by shuffle with the tables of all orders, backing off, and added to their document's sum. So
the whole model counts, and only a bounded part of it is ever in one place.

A document is rejected if its perplexity is above a high quantile of the trusted documents of its language; languages
with few trusted documents use the quantile of all trusted ones. The quantiles cover every trusted document. Null and
empty texts have no perplexity and are kept; without trusted text all documents are kept. Repeated rows get a row each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.llm.common import map_texts, staged, table
from intactly.llm.labelled import fold, labelled_sample

ORDER = 4
UNIT_BITS = 16
#: N-grams that are broadcast, at most (16 bytes each); the others are joined by shuffle.
HELD = 1_000_000
#: Up to so many digests of texts (32 bytes each) are broadcast to pick texts or leave them out; more are joined by shuffle.
BROADCAST_TEXTS = 500_000
#: A language's threshold is this quantile of its trusted documents' perplexities.
QUANTILE = 0.995
#: Below so many trusted documents a language takes the quantile of all languages.
LEAST_TRUSTED = 50
SHARDS = 16


def grams(text: str | None) -> np.ndarray:
    """Keys of the n-grams that end at each unit of a text; before the text lie zeros."""
    units = np.frombuffer((text or "").encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint64), units])
    key = np.zeros(len(units), np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(UNIT_BITS)) | padded[k:k + len(units)]
    return key


def gram_counts(texts: DataFrame) -> DataFrame:
    """key (signed 64-bit) and n over all texts."""

    def factory():
        def fn(batch):
            keys, n = np.unique(np.concatenate([grams(t) for t in batch]), return_counts=True)
            return [[keys.view(np.int64)] + [[]] * (len(batch) - 1), [n] + [[]] * (len(batch) - 1)]
        return fn

    counted = map_texts(texts, "keys array<long>, ns array<long>", factory, carry=())
    pairs = counted.select(F.explode(F.arrays_zip("keys", "ns")).alias("p"))
    return pairs.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.ns").alias("n"))


def _suffix(key: Column, order: int) -> Column:
    return key.bitwiseAND(F.lit((1 << (UNIT_BITS * order)) - 1).cast("long"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    held = lambda d, most: min(max(d, 0.05), most)
    return (held(1 - 2 * y * n2 / n1 if n1 else 0.5, 0.95), held(2 - 3 * y * n3 / n2 if n2 else 1.0, 1.9),
            held(3 - 4 * y * n4 / n3 if n3 else 1.5, 2.9))


def probabilities(counts: DataFrame, name: str = "grams") -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (key, p, n) of its n-grams and (history, gamma), the weight of the next lower order."""
    levels = [staged(counts, f"{name}{ORDER}")]
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many n-grams of the next order a key is the end.
        lower = levels[0].groupBy(_suffix(F.col("key"), order).alias("key")).agg(F.count("*").alias("n"))
        levels.insert(0, staged(lower, f"{name}{order}"))
    out: list[tuple[DataFrame, DataFrame]] = []
    for order, level in enumerate(levels, 1):
        d1, d2, d3 = _discounts(level)
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        own = level.select("key", "n", cut.alias("cut"), F.shiftrightunsigned("key", UNIT_BITS).alias("history"))
        totals = own.groupBy("history").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("gamma"))
        joined = own.join(totals, "history")
        if order == 1:
            lower = F.lit(1.0 / (1 << UNIT_BITS))
        else:
            joined = joined.withColumn("end", _suffix(F.col("key"), order - 1)).join(
                out[-1][0].select(F.col("key").alias("end"), F.col("p").alias("lower")), "end")
            lower = F.col("lower")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("gamma") * lower
        out.append((staged(joined.select("key", p.alias("p"), "n"), f"{name}p{order}"),
                    staged(totals.select("history", "gamma"), f"{name}g{order}")))
    return out


def _sorted(df: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    got = df.select(key, value).toArrow()
    keys = got.column(key).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], got.column(value).to_numpy()[order]


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


@dataclass
class Model:
    """Probability and back-off tables by order; those of the highest order in shards by key. Only the latter in a part
    of a model."""

    p: list[tuple[np.ndarray, np.ndarray]]
    gamma: list[tuple[np.ndarray, np.ndarray]]
    shards: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, tables: list[tuple[DataFrame, DataFrame]]) -> Model:
        """Brings whole tables to the driver: for small ones."""
        p = [_sorted(a, "key", "p") for a, _ in tables]
        gamma = [_sorted(b, "history", "gamma") for _, b in tables]
        keys, values = p.pop()
        return cls(p, gamma, list(zip(np.array_split(keys, SHARDS), np.array_split(values, SHARDS), strict=True)))

    @classmethod
    def frequent(cls, tables: list[tuple[DataFrame, DataFrame]], most: int = HELD) -> Model:
        """The part of a model with its most frequent n-grams, ``most`` at most."""
        top = tables[-1][0].withColumn("power", F.floor(F.log2("n")).cast("int"))
        left, cut = most, 64
        for r in sorted(top.groupBy("power").agg(F.count("*").alias("n")).collect(), reverse=True):
            left -= r["n"]
            if left < 0:
                break
            cut = r["power"]
        keys, values = _sorted(top.where(F.col("power") >= cut), "key", "p")
        return cls([], [], list(zip(np.array_split(keys, SHARDS), np.array_split(values, SHARDS), strict=True)))

    def known(self, wanted: np.ndarray) -> np.ndarray:
        """Probability of each distinct key, in rising key order; NaN for those that are not among the n-grams."""
        p = np.full(len(wanted), np.nan)
        for keys, values in self.shards:  # a merge of two sorted runs, shard by shard
            if len(keys):
                a, b = np.searchsorted(wanted, keys[0], "left"), np.searchsorted(wanted, keys[-1], "right")
                p[a:b] = _found(keys, values, wanted[a:b], np.nan)
        return p

    def log_p(self, wanted: np.ndarray) -> np.ndarray:
        """Log probability of each distinct key, in rising key order."""
        p = self.known(wanted)
        rest = np.flatnonzero(np.isnan(p))
        if len(rest):
            p[rest] = self._backed_off(wanted[rest], ORDER)
        return np.log(p)

    def _backed_off(self, key: np.ndarray, order: int) -> np.ndarray:
        """Probability of keys that are not among the n-grams of ``order``."""
        weight = _found(*self.gamma[order - 1], key >> np.uint64(UNIT_BITS), 1.0)
        if order == 1:
            return weight / (1 << UNIT_BITS)
        lower = key & np.uint64((1 << (UNIT_BITS * (order - 1))) - 1)
        p = _found(*self.p[order - 2], lower, np.nan)
        rest = np.flatnonzero(np.isnan(p))
        if len(rest):
            p[rest] = self._backed_off(lower[rest], order - 1)
        return weight * p

    def perplexities(self, texts: list[str | None]) -> tuple[np.ndarray, list[float | None]]:
        """Units and perplexity of each text; None for a text without units."""
        keys = [grams(t) for t in texts]
        n = np.array([len(k) for k in keys], np.int64)
        if not n.sum():
            return n, [None] * len(n)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        log_p = self.log_p(distinct)[at]
        ends = np.cumsum(n)
        return n, [float(np.exp(-log_p[e - k:e].mean())) if k else None for e, k in zip(ends, n, strict=True)]


    def known_sums(self, texts: list[str | None]) -> tuple[list, ...]:
        """Units of each text, the sum of its known n-grams' log probabilities, and its other n-grams with counts."""
        keys = [grams(t) for t in texts]
        n = np.array([len(k) for k in keys], np.int64)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        log_p = np.log(self.known(distinct))
        missing = np.isnan(log_p)
        sums, rest, counts = [], [], []
        for end, k in zip(np.cumsum(n), n, strict=True):
            own = at[end - k:end]
            sums.append(float(np.nansum(log_p[own])))
            left, times = np.unique(own[missing[own]], return_counts=True)
            rest.append(distinct[left].view(np.int64))
            counts.append(times)
        return n, sums, rest, counts


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every distinct text of the documents that a label calls good, but for the held out fold. Digests are compared first, so that of each text
    only one document is picked."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").where(fold(F.col("doc_id")) != 2).select("doc_id").distinct()
    same = F.unhex(F.sha2(F.col("text").cast("string"), 256))
    known = (docs.where(F.col("text").isNotNull()).select("doc_id", same.alias("same")).join(good, "doc_id", "left_semi")
             .groupBy("same", "doc_id").agg(F.count("*").alias("copies"))
             .groupBy("same").agg(F.min(F.struct("doc_id", "copies")).alias("first")))
    wanted = staged(known.select("first.doc_id", "same", "first.copies"), "trusted")
    picked = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
    found = docs.select("doc_id", "text").join(picked, "doc_id").where(same == F.col("same"))
    once = found.where("copies = 1").select("text")
    if wanted.where("copies > 1").isEmpty():
        return once
    return once.unionAll(found.where("copies > 1").dropDuplicates(["same"]).select("text"))


def train(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> list[tuple[DataFrame, DataFrame]]:
    """The tables of a model of all trusted text that is not held out (for trials: of ``rows`` documents at most)."""
    trusted = trusted_texts(docs, labels) if rows is None else labelled_sample(
        docs, labels.where("quality = 1"), "quality", rows)
    return probabilities(gram_counts(trusted))


def log_probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """key and log_p of distinct keys, by joins with the tables of all orders."""
    found, p = wanted, F.lit(1.0 / (1 << UNIT_BITS))
    for order, (level, backoff) in enumerate(tables, 1):
        end = _suffix(F.col("key"), order) if order < ORDER else F.col("key")
        here = level.select(F.col("key").alias("__end"), F.col("p").alias(f"__p{order}"))
        above = backoff.select(F.col("history").alias("__history"), F.col("gamma").alias(f"__g{order}"))
        found = (found.withColumn("__end", end).join(here, "__end", "left")
                 .withColumn("__history", F.shiftrightunsigned("__end", UNIT_BITS)).join(above, "__history", "left")
                 .drop("__end", "__history"))
        p = F.coalesce(F.col(f"__p{order}"), F.coalesce(F.col(f"__g{order}"), F.lit(1.0)) * p)
    return found.select("key", F.log(p).alias("log_p"))


def perplexities(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]], carry: tuple[str, ...] = ("doc_id", "lang"),
                 most: int = HELD) -> DataFrame:
    """``carry``, n_units and perplexity of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Model.frequent(tables, most))

    def factory():
        return lambda texts: shared.value.known_sums(texts)

    fields = "n_units long, __known double, __rest array<long>, __times array<long>"
    # Written once, so that a row keeps its number.
    first = staged(map_texts(docs, fields, factory, carry=carry).withColumn("__row", F.monotonically_increasing_id()),
                   "known")
    rest = (first.where(F.size("__rest") > 0).select("__row", F.explode(F.arrays_zip("__rest", "__times")).alias("r"))
            .select("__row", F.col("r.__rest").alias("key"), F.col("r.__times").alias("times")))
    logs = staged(log_probabilities(rest.select("key").distinct(), tables), "rest")
    sums = rest.join(logs, "key").groupBy("__row").agg(F.sum(F.col("times") * F.col("log_p")).alias("__added"))
    total = F.col("__known") + F.coalesce("__added", F.lit(0.0))
    return (first.drop("__rest", "__times").join(sums, "__row", "left")
            .select(*carry, "n_units", F.when(F.col("n_units") > 0, F.exp(-total / F.col("n_units"))).alias("perplexity")))


def thresholds(scored: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """lang and threshold, from all trusted documents; a row with a null language holds that of all of them."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    trusted = scored.where("perplexity IS NOT NULL").join(good, "doc_id", "left_semi").select(
        F.coalesce("lang", F.lit("")).alias("lang"), "perplexity")
    at = F.percentile_approx("perplexity", quantile, 10_000)
    return (trusted.rollup("lang").agg(at.alias("threshold"), F.count("*").alias("n"))
            .where((F.col("n") >= LEAST_TRUSTED) | F.col("lang").isNull()).select("lang", "threshold"))


def judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """``scored`` with threshold and keep."""
    by_lang, overall = limits.where("lang IS NOT NULL"), limits.where("lang IS NULL")
    of_all = overall.agg(F.max("threshold")).first()[0]  # one number, null without trusted documents
    joined = (scored.withColumn("__lang", F.coalesce("lang", F.lit("")))
              .join(by_lang.withColumnRenamed("lang", "__lang"), "__lang", "left").drop("__lang"))
    limit = F.coalesce("threshold", F.lit(of_all).cast("double"))
    keep = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return joined.withColumn("threshold", limit).withColumn("keep", keep)


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. A row is known by its language and text."""
    lang, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "text"))
    marked = docs.withColumn("__key", F.unhex(F.md5(F.concat(F.length(lang).cast("string"), F.lit(":"), lang, text))))
    scored = staged(perplexities(marked, train(docs, labels), ("doc_id", "lang", "__key")), "perplexities")
    out = staged(judged(scored, thresholds(scored, labels)).where("NOT keep").select("__key").distinct(), "rejected")
    return marked.join(F.broadcast(out) if out.count() <= BROADCAST_TEXTS else out, "__key", "left_anti").select(
        docs.columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = staged(perplexities(docs, train(docs, labels)), "perplexities")
    return judged(scored, thresholds(scored, labels))


QUERIES = {"op4_quality_classifier": op4_quality_classifier}
SQL: dict[str, str] = {}

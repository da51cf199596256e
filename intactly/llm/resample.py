"""Importance resampling towards a target by hashed word features, summed with bit planes.

Features are hashed into buckets. One pass counts the source's features by bucket (a bounded table: one row a bucket), the
same is done for the target, and each bucket gets an integer gain: how much likelier it is in the target. A document's
bucket counts are cut into binary planes, one bit a bucket, and the gains into two's complement planes. AND of a count plane
and a gain plane, the number of bits set in it and the two planes' powers of two add up to the exact sum of gains.

Draws are the highest scores (weight plus seeded Gumbel noise), ranked without a global window: rows are dealt by ranges of
the score, and places are carried from range to range.

Null and empty texts have no features: they weigh 0, and with fewer words than ``least_words`` they are never drawn. Rows
without an id count as source, but have no score and no part in the draw. Repeated rows count and are drawn each; ties of
score go to the smaller id, then to fewer features; rows alike in all are interchangeable. Texts of any length are read
whole, one at a time. An empty target or source has no counts; no documents, no rows. Only the id and the text are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.llm.common import WORDS, BoundedCache, crc32_sql, map_texts, staged, table, utf8
from intactly.operators.ordered import numbered

BUCKETS = 10_000
WIDTHS = (1, 1)
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Documents whose planes are held at once.
GROUP = 64


def features(text: str | None, widths: tuple[int, int] = WIDTHS) -> tuple[int, Iterable[bytes]]:
    """Number of words, and the runs of ``widths`` consecutive words."""
    words = utf8(text).translate(WORDS).split() if text else []
    if widths == (1, 1):
        return len(words), words
    return len(words), [b" ".join(words[i:i + n]) for n in range(widths[0], widths[1] + 1)
                        for i in range(len(words) - n + 1)]


def _bucketed(buckets: int) -> BoundedCache:
    return BoundedCache(lambda feature: zlib.crc32(feature) % buckets)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, widths: tuple[int, int] = WIDTHS) -> DataFrame:
    """bucket and n: how many features of all texts fall into each bucket. A task sends one row a bucket at most."""

    def count(batches):
        bucket, total = _bucketed(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = [bucket[f] for f in features(text, widths)[1]]
                total += np.bincount(np.array(found, np.int64), minlength=buckets)
        held = np.flatnonzero(total)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket."""
    s_all, t_all = float(sum(source.values())), float(sum(target.values()))
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * (s_all + buckets)
                                                / ((source.get(b, 0) + 1.0) * (t_all + buckets))))
                     for b in range(buckets)], np.int64)


class Planes:
    """Integer gains as bit planes, and sums of gains by counts through them."""

    def __init__(self, gain: np.ndarray):
        self.words = -(-len(gain) // 64)
        bits = int(max(gain.max(initial=0), -gain.min(initial=0) - 1)).bit_length() + 1
        self.planes = np.stack([self._packed((gain >> k) & 1) for k in range(bits)])
        self.power = 1 << np.arange(bits, dtype=np.int64)
        self.power[-1] *= -1  # two's complement: the highest plane counts negatively

    def _packed(self, bit: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 8, np.uint8)
        octets = np.packbits(bit.astype(np.uint8), bitorder="little")
        out[:len(octets)] = octets
        return out.view(np.uint64)

    def sums(self, found: list[list[int]]) -> np.ndarray:
        """For each list of buckets, the sum of their gains."""
        out = np.zeros(len(found), np.int64)
        owner = np.repeat(np.arange(len(found), dtype=np.int64), [len(f) for f in found])
        places, counts = np.unique(owner * (self.words * 64) + np.array(sum(found, []), np.int64), return_counts=True)
        word, bit = places >> 6, np.uint64(1) << (places & 63).astype(np.uint64)
        for j in range(int(counts.max(initial=0)).bit_length()):
            held = (counts >> j) & 1 == 1
            at, first = np.unique(word[held], return_index=True)
            plane = np.zeros(len(found) * self.words, np.uint64)
            plane[at] = np.bitwise_or.reduceat(bit[held], first)
            plane = plane.reshape(len(found), self.words)
            rows = np.flatnonzero(plane.any(axis=1))
            common = np.bitwise_count(plane[rows, None, :] & self.planes).sum(axis=2, dtype=np.int64)
            out[rows] += (common @ self.power) << j
        return out


def noise(key: str, seed: int = SEED) -> int:
    """floor of 1000 times a standard Gumbel variable, from the hash of the seed and the key."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(planes_of: Callable[[], Planes], buckets: int, widths: tuple[int, int]) -> Callable:
    def factory():
        planes, bucket = planes_of(), _bucketed(buckets)

        def fn(texts):
            words, n, weight = [], [], []
            for start in range(0, len(texts), GROUP):
                found = []
                for text in texts[start:start + GROUP]:
                    n_words, runs = features(text, widths)
                    words.append(n_words)
                    found.append([bucket[f] for f in runs])
                size = np.array([len(f) for f in found], np.int64)
                n += size.tolist()
                weight += np.where(size > 0, planes.sums(found) // np.maximum(size, 1), 0).tolist()
            return words, n, weight

        return fn

    return factory


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, widths: tuple[int, int] = WIDTHS,
             seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null unless drawn) of every document row."""
    spark = docs.sparkSession
    source, wanted = ({r["bucket"]: r["n"] for r in bucket_counts(t, buckets, widths).collect()}
                      for t in (docs, target))  # at most one row a bucket each
    shared = spark.sparkContext.broadcast(Planes(gains(source, wanted, buckets)))
    weighed = map_texts(docs, "n_words long, n_features long, weight long",
                        _scorer(lambda: shared.value, buckets, widths))

    @F.pandas_udf("long")
    def gumbel(keys):
        return keys.map(lambda k: noise(k, seed), na_action="ignore")

    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id").cast("string"))), "scored")
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = scored.where(able).count() * percent // 100
    ranked = numbered(scored.where(able), [F.desc("score"), F.col("doc_id"), F.col("n_features")], "place")
    rest = scored.where(~able).withColumn("place", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score",
                                           F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS_SQL = (r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])")

QUERIES = {"op11_importance_resampling": op11_importance_resampling}
SQL = {"op11_importance_resampling": f"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, {_WORDS_SQL} AS w FROM documents),
f AS (SELECT i, unnest(w) AS word FROM d),
b AS (SELECT unnest({_WORDS_SQL}) AS word FROM benchmark),
h AS (SELECT word, {crc32_sql("word")} % {BUCKETS} AS bucket
      FROM (SELECT word FROM f UNION SELECT word FROM b)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN h USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + {BUCKETS})::DOUBLE
             / ((s + 1)::DOUBLE * ((SELECT count(*) FROM b) + {BUCKETS})::DOUBLE))) AS gain
      FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT i, floor(avg_gain) AS weight FROM (SELECT i, sum(gain) / count(*) AS avg_gain
      FROM f JOIN h USING (word) JOIN g USING (bucket) GROUP BY i)),
x AS (SELECT i, doc_id, CAST(len(w) AS BIGINT) AS n, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || sha256('{SEED}:' || CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) AS h
      FROM d LEFT JOIN m USING (i)),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
r AS (SELECT i, row_number() OVER (ORDER BY score DESC, doc_id, n) AS place, count(*) OVER () AS eligible
      FROM y WHERE score IS NOT NULL AND n >= {LEAST_WORDS})
SELECT doc_id, n AS n_features, weight, score,
       CASE WHEN place <= {PERCENT} * eligible // 100 THEN place END AS rank
FROM y LEFT JOIN r USING (i)"""}

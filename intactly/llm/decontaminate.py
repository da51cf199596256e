"""Benchmark decontamination by a Wu-Manber multi-pattern search over words.

Every run of ``width`` words of a benchmark item is a pattern (an item of fewer words is one pattern). For each pattern
length, a shift table over blocks of adjacent words says how far the search may jump; where it may not, the block's
bucket (by suffix block, then by prefix block) names the patterns to compare word by word.

Patterns are dealt into blocks of a bounded number, whatever their words or items; each block's tables are broadcast and
every document is searched in each block. Documents are never shuffled for it.

Null and empty texts have no words: such documents have no hits, such items no patterns. Items without an id take no
part. Items of the same words are all reported; repeated documents get a row each. No items: nothing is hit.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.llm.common import WORDS, filter_rows, map_texts, staged, table, utf8

WIDTH = 10
#: Patterns (with their items) in one broadcast block: about 100 MB of tables in a worker.
BLOCK_PATTERNS = 200_000


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(WORDS).split() if text else []


class WuManber:
    """Finds every occurrence of word sequences in a list of words."""

    def __init__(self, patterns: Iterable[tuple[tuple[bytes, ...], str]]):
        items = defaultdict(set)
        for pattern, item in patterns:
            items[pattern].add(item)
        lengths = defaultdict(list)
        for pattern in items:
            lengths[len(pattern)].append(pattern)
        self.tables = [self._table(m, found, items) for m, found in sorted(lengths.items())]

    @staticmethod
    def _table(m: int, patterns: list, items: dict) -> tuple:
        block = min(2, m)
        shift: dict[tuple, int] = {}
        buckets: dict[tuple, dict[tuple, list]] = {}
        for p in patterns:
            for end in range(block, m + 1):
                key = p[end - block:end]
                shift[key] = min(shift.get(key, m), m - end)
            bucket = buckets.setdefault(p[m - block:], {})
            bucket.setdefault(p[:block], []).append((list(p), sorted(items[p])))
        return m, block, shift, buckets

    def search(self, words: list[bytes]) -> Iterable[tuple[int, int, list[str]]]:
        """(first word, word after the last, items) of each occurrence; by pattern length, then by place."""
        n = len(words)
        for m, block, shift, buckets in self.tables:
            far, end = m - block + 1, m
            while end <= n:
                key = tuple(words[end - block:end])
                step = shift.get(key, far)
                if step:
                    end += step
                    continue
                start = end - m
                for pattern, found in buckets[key].get(tuple(words[start:start + block]), ()):
                    if words[start:end] == pattern:
                        yield start, end, found
                end += 1


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def patterns(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """pattern (its words joined by a space) and item, one row for each place in each item."""

    def factory():
        def fn(texts):
            found = []
            for text in texts:
                w = words_of(text)
                found.append([b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else [])
            return [found]
        return fn

    named = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), "text")
    windows = map_texts(named, "patterns array<binary>", factory, carry=("item",))
    return windows.select("item", F.explode("patterns").alias("pattern"))


def _tables(rows: list) -> WuManber:
    return WuManber((tuple(bytes(r["pattern"]).split(b" ")), r["item"]) for r in rows)


_HITS = "n_words long, spans array<struct<first:long,after:long>>, items array<string>"


def _searched(docs: DataFrame, rows: list, carry: tuple[str, ...]) -> DataFrame:
    """Each document with what one block of patterns finds in it."""
    tables = docs.sparkSession.sparkContext.broadcast(_tables(rows))

    def factory():
        searcher = tables.value

        def fn(texts):
            n, spans, items = [], [], []
            for text in texts:
                words = words_of(text)
                found = list(searcher.search(words))
                n.append(len(words))
                spans.append([{"first": a, "after": b} for a, b in merged((a, b) for a, b, _ in found)])
                items.append(sorted({i for *_, names in found for i in names}))
            return n, spans, items

        return fn

    return map_texts(docs, _HITS, factory, carry=carry)


def _blocks(items: DataFrame, width: int, block_patterns: int) -> tuple[DataFrame, int]:
    """Patterns with the number of their block, and how many blocks there are."""
    found = staged(patterns(items, width), "patterns")
    blocks = max(1, -(-found.count() // block_patterns))
    return found.withColumn("block", F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks))), blocks


def uncontaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH,
                   block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """The rows of ``docs`` that no pattern occurs in, all columns."""
    found, blocks = _blocks(items, width, block_patterns)
    for b in range(blocks):
        tables = docs.sparkSession.sparkContext.broadcast(_tables(found.where(F.col("block") == b).collect()))

        def factory(tables=tables):
            search = tables.value.search
            return lambda batch: [not any(True for _ in search(words_of(t))) for t in batch.column("text").to_pylist()]

        docs = filter_rows(docs, factory)
        if b + 1 < blocks:
            docs = staged(docs, "uncontaminated")
    return docs


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH,
                  block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """doc_id, n_words, spans (merged word ranges that are hit) and items (sorted ids) of every document row."""
    dealt, blocks = _blocks(items, width, block_patterns)
    if blocks == 1:
        return _searched(docs, dealt.collect(), ("doc_id",))
    numbered = staged(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "numbered")
    parts = [staged(_searched(numbered, dealt.where(F.col("block") == b).collect(), ("row", "doc_id")), "searched")
             for b in range(blocks)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)

    def join(rows):
        for frame in rows:
            frame["spans"] = [[{"first": a, "after": b} for a, b in merged((s["first"], s["after"]) for s in spans)]
                              for spans in frame["spans"]]
            yield frame

    together = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row")
    return together.mapInPandas(join, together.schema)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


_WORDS_SQL = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
SQL = {"op1_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark
      WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT DISTINCT item, least({WIDTH}, len(w)) AS n, array_to_string(w[k:k + {WIDTH} - 1], ' ') AS run
      FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WIDTH} + 1) + 1)) AS k FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM p),
places AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS run
           FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d), lengths WHERE k + n - 1 <= len(w)),
hits AS (SELECT doc_id, k, places.n, item FROM places JOIN p USING (run)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""}

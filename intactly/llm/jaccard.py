"""N-gram Jaccard join with a prefix tree: links of documents whose word shingle sets are similar. Shingle width and
similarity are parameters; op8's query takes 3 words and 0.9, for which the numbers below stand.

A document's set is sorted by 64-bit shingle hashes, one global order. Documents of equal sets are one node from the
start (equal by a 64-bit hash of the set). Linked sets of sizes a and b differ in at most (a + b) / 19 shingles, so if
the order is cut into more ranges than that, two linked sets agree in all shingles of some range. Each set therefore
gives a signature for each range, under the numbers of ranges for its size class and the class below; sets that share
no signature cannot be linked. No candidate is dropped: an empty range counts as agreement, so there is one range more,
and a set with more empty ranges than that gives signatures for these too.

Sets that signatures connect form a block. In a block, sets are stored in a prefix tree; each set walks the tree, shares
the overlap counted so far among all sets below a branch, and leaves a branch when the elements that remain cannot reach
the overlap that its sizes ask for, or when all sets below are in its component already (a link there changes nothing).
A block of more than BLOCK_ELEMENTS is dealt into parts, each with the same few leaders; sets that do not end up in the
block's largest component are then compared with every part, so that no link across parts is lost.

Rows without an id, and texts without words, are linked with nothing; the component of the latter is their own id.
Repeated rows are equal sets. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from intactly.llm.common import LOWER, BoundedCache, map_texts, staged, table, utf8
from intactly.llm.components import components

WORDS = 3
#: Linked: PART * intersection >= share * union.
PART, SHARE = 100, 90
#: Shingles of all sets in one part of a block (about 100 MB in the tree).
BLOCK_ELEMENTS = 1_000_000
LEADERS = 32
#: Sets below a branch are read together when no more than so many elements remain of them.
FLAT_ELEMENTS = 32_768
#: Up to so many ids (16 MB) are broadcast to pick texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
SPARE_RANGES = 1
CACHE_ENTRIES = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.ids = BoundedCache(xxhash.xxh3_64_intdigest, CACHE_ENTRIES)
        self.factors = [np.uint64(int(_STEP) * (2 * k + 1) % 2 ** 64) for k in range(words)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = utf8(text).translate(LOWER).split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        ids = np.fromiter(map(self.ids.__getitem__, words), np.uint64, len(words))
        n = len(ids) - self.words + 1
        total = np.zeros(n, np.uint64)
        for k, f in enumerate(self.factors):
            total += mix(ids[k:k + n]) * f
        return np.unique(mix(total))


def least_overlap(a: int, b: int, share: int = SHARE) -> int:
    """Smallest intersection of linked sets of sizes a and b."""
    return -(-share * (a + b) // (PART + share))


class SizeClasses:
    """Classes such that linked sets are of one class or of neighbours."""

    def __init__(self, share: int = SHARE):
        self.share, self.starts = share, [1]

    def of(self, n: int) -> int:
        while self.starts[-1] <= n or len(self.starts) < 2:
            self._grow()
        return bisect_right(self.starts, n) - 1

    def _grow(self) -> None:
        self.starts.append(self.starts[-1] * PART // self.share + 1)

    def ranges(self, c: int) -> int:
        """Ranges for pairs of a set of class c with one of class c or c + 1."""
        while len(self.starts) <= c + 2:
            self._grow()
        most = self.starts[c + 1] - 1 + self.starts[c + 2] - 1
        # A difference is odd for odd sums of sizes and even for even ones: the largest is at one of the last two.
        return max(s - 2 * least_overlap(s, 0, self.share) for s in (most - 1, most)) + 1 + SPARE_RANGES


def signatures(s: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """One hash for each range of the set, under its class and the class below."""
    own = classes.of(len(s))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s)])
    out = []
    for c in (own - 1, own) if own else (own,):
        n = classes.ranges(c)
        bounds = (np.arange(1, n, dtype=np.float64) * (2.0 ** 64 / n)).astype(np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(s, bounds), [len(s)]])
        full = np.diff(cuts) > 0
        name = mix((np.arange(n, dtype=np.uint64) + np.uint64(c << 32)) * _STEP + _STEP)
        signs = mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ name)
        out.append(signs if n - full.sum() > SPARE_RANGES else signs[full])
    return np.concatenate(out)


def sets(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set; null without words) and signs of every row."""

    def factory():
        shingle, classes = Shingler(words), SizeClasses(share)

        def fn(texts):
            n, nodes, signs = [], [], []
            for t in texts:
                s = shingle(t)
                n.append(len(s))
                nodes.append(node_of(s))
                signs.append(signatures(s, classes).view(np.int64) if len(s) else None)
            return n, nodes, signs

        return fn

    return map_texts(docs, "n_shingles long, node long, signs array<long>", factory)


def node_of(s: np.ndarray) -> int | None:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())))) if len(s) else None


class _Branch:
    """What the sets ``low`` to ``high`` (in tree order) share after what lies above: a path of elements."""

    __slots__ = ("path", "low", "high", "least", "most", "end", "below", "leaves")

    def __init__(self, path: np.ndarray, low: int, high: int, least: int, most: int):
        self.path, self.low, self.high = path, low, high
        self.least, self.most = least, most  # sizes of the sets below
        self.end: int | None = None  # the set that ends here
        self.below: list[_Branch] = []
        # Elements, starts, sizes and places of sets below that are read together.
        self.leaves: tuple[np.ndarray, ...] | None = None


class PrefixTree:
    """Distinct sets as sorted ranks in one global order, by shared beginnings; and the components of links found."""

    def __init__(self, sets: list[np.ndarray], ranks: int, share: int = SHARE):
        self.share = share
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.sets = [sets[i] for i in order]
        self.place = np.argsort(order)
        self.labels = np.arange(len(sets))  # by place
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.shared = np.zeros(ranks, np.int32)
        self.root = self._build()

    def _build(self) -> _Branch:
        root = _Branch(np.empty(0, np.int64), 0, len(self.sets), 0, 0)
        todo: list[tuple[list[_Branch], int, int, int]] = [(root.below, 0, len(self.sets), 0)] if self.sets else []
        while todo:
            into, low, high, depth = todo.pop()
            first, last = self.sets[low], self.sets[high - 1]
            n = min(len(first), len(last))
            same = first[depth:n] == last[depth:n]
            end = n if same.all() else depth + int(np.argmin(same))
            sizes = self.sizes[low:high]
            branch = _Branch(first[depth:end], low, high, int(sizes.min()), int(sizes.max()))
            into.append(branch)
            at = low
            if len(first) == end:
                branch.end, at = low, low + 1
            single = list(range(at, high))
            if int(sizes.sum()) - (high - low) * end > FLAT_ELEMENTS:
                heads = np.array([self.sets[i][end] for i in single], np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(heads)) + 1).tolist(), len(heads)]
                runs = [(at + a, at + b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                single = [a for a, b in runs if b - a == 1]
                todo += [(branch.below, a, b, end) for a, b in runs if b - a > 1]
            if single:
                rests = [self.sets[i][end:] for i in single]
                starts = np.cumsum([0] + [len(r) for r in rests[:-1]])
                branch.leaves = np.concatenate(rests), starts, self.sizes[single], np.array(single)
        return root

    def _link(self, a: int, b: int) -> None:
        x, y = self.labels[a], self.labels[b]
        if x != y:
            self.labels[self.labels == max(x, y)] = min(x, y)

    def probe(self, s: np.ndarray, own: int) -> None:
        """Links the stored set at place ``own`` with the sets of the tree."""
        size = len(s)
        self.shared[s] = 1
        todo = [(b, 0, 0, 0) for b in self.root.below]
        while todo:
            branch, depth, at, overlap = todo.pop()
            if not self._reachable(size, at, depth, overlap, branch) or (
                    self.labels[branch.low:branch.high] == self.labels[own]).all():
                continue
            if len(branch.path):
                overlap += int(self.shared[branch.path].sum())
                depth += len(branch.path)
                at = int(np.searchsorted(s, branch.path[-1], "right"))
                if not self._reachable(size, at, depth, overlap, branch):
                    continue
            if branch.end is not None and overlap >= least_overlap(size, depth, self.share):
                self._link(own, branch.end)
            if branch.leaves is not None:
                elements, starts, sizes, places = branch.leaves
                need = least_overlap(size, sizes, self.share)
                if (overlap + np.minimum(size - at, sizes - depth) >= need).any():
                    found = overlap + np.add.reduceat(self.shared[elements], starts)
                    for i in places[found >= need]:
                        self._link(own, int(i))
            todo += [(b, depth, at, overlap) for b in branch.below]
        self.shared[s] = 0

    def _reachable(self, size: int, at: int, depth: int, overlap: int, branch: _Branch) -> bool:
        """Whether a set below could still have the overlap that its size asks for."""
        best = min(max(depth + size - at, branch.least), branch.most)
        return overlap + min(size - at, best - depth) >= least_overlap(size, best, self.share)


_EDGE = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, str, np.ndarray]]]:
    """(node, role, set) lists of one block after the other, from rows in order of block, role (last first) and node; each
    node once, as 'right' if it is both: two left sets of one group may lie in different parts, and one must walk."""
    now, found, seen = None, [], set()
    for batch in batches:
        for block, node, role, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "node", "role", "set")),
                                          strict=True):
            if block != now:
                if found:
                    yield found
                now, found, seen = block, [], set()
            if node not in seen:
                seen.add(node)
                found.append((node, role, np.frombuffer(raw, np.uint64)))
    if found:
        yield found


def _links(rows: DataFrame, share: int) -> DataFrame:
    """Edges that span the components of each block. In a block with roles 'left' and 'right', only the right sets
    walk the tree."""
    arrow = to_arrow_schema(_EDGE)

    def run(batches):
        for block in _blocks(batches):
            nodes, roles, found = zip(*block, strict=True)
            every = np.unique(np.concatenate(found))
            ranked = [np.searchsorted(every, x) for x in found]
            tree = PrefixTree(ranked, len(every), share)
            for i, role in enumerate(roles):
                if role != "left":
                    tree.probe(ranked[i], int(tree.place[i]))
            named = np.array(nodes, np.int64)[np.argsort(tree.place)]  # by place
            edges = [(a, b) for a, b in zip(named.tolist(), named[tree.labels].tolist(), strict=True) if a != b]
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*edges, strict=True)], schema=arrow)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (rows.select("block", "node", "role", "set").repartition(n, "block")
               .sortWithinPartitions("block", F.desc("role"), "node"))
    return ordered.mapInArrow(run, _EDGE)


def candidates(every: DataFrame, share: int = SHARE) -> DataFrame:
    """node and label of the nodes that signatures connect with others. A set of one shingle is linked with other sets
    only at a similarity of a half or less."""
    signs = (every.where(F.col("n_shingles") > (1 if 2 * share > PART else 0)).groupBy("node").agg(F.first("signs").alias("signs"))
             .select("node", F.explode("signs").alias("sign")))
    first = (signs.groupBy("sign").agg(F.min("node").alias("b"), F.max("node").alias("last"))
             .where("b <> last").select("sign", "b"))
    return components(signs.join(first, "sign").select(F.col("node").alias("a"), "b").where("a <> b").distinct())


def _texts_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, label, block parts and set of the wanted nodes (each with the id of one document)."""
    count = wanted.count()
    picked = docs.select("doc_id", "text").join(F.broadcast(wanted) if count <= BROADCAST_IDS else wanted, "doc_id")
    carry = tuple(c for c in wanted.columns if c != "doc_id")

    def factory():
        shingle = Shingler(words)

        def fn(texts):
            found = [shingle(t) for t in texts]
            return [node_of(s) for s in found], [s.tobytes() for s in found]

        return fn

    # An id may be repeated with other texts: only the text of this node counts.
    return map_texts(picked, "own long, set binary", factory, carry=carry).where("own = node").drop("own")


def links(docs: DataFrame, every: DataFrame, block_elements: int = BLOCK_ELEMENTS, words: int = WORDS,
          share: int = SHARE) -> DataFrame:
    """Edges (nodes a and b) that connect exactly what links connect."""
    nodes = every.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    near = staged(candidates(every, share).join(nodes, "node"), "candidates")
    sizes = near.groupBy("label").agg(F.sum("n").alias("elements"))
    parts = sizes.select("label", F.ceil(F.col("elements") / block_elements).cast("int").alias("parts"))
    large = staged(parts.where("parts > 1"), "large")
    wanted = near.join(parts, "label").select(
        "doc_id", "node", "label", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    has_large = not large.isEmpty()
    found = _texts_of(docs, wanted, words)
    if has_large:
        found = staged(found, "sets")
    name = F.concat_ws(":", "label", "part")
    once = found.select(name.alias("block"), "node", F.lit("all").alias("role"), "set")
    if not has_large:
        return _links(once, share)
    # The leaders of a large block: its nodes with the smallest hashes, in every part.
    first = (near.join(large, "label").withColumn("bucket", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(997)))
             .groupBy("label", "bucket", "parts").agg(F.min("node").alias("node"))
             .groupBy("label", "parts").agg(F.slice(F.array_sort(F.collect_list("node")), 1, LEADERS).alias("nodes"))
             .select("label", F.explode("nodes").alias("node")))
    leaders = (found.join(first, ["label", "node"])
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select(name.alias("block"), "node", F.lit("all").alias("role"), "set"))
    edges = staged(_links(once.unionAll(leaders), share), "links")
    # What is not in the largest component of its block meets every part of the block.
    label_of = components(edges).withColumnRenamed("label", "own")
    big = (found.where("parts > 1").select("label", "node", "part", "parts").distinct()
           .join(label_of, "node", "left").withColumn("own", F.coalesce("own", "node")))
    counted = big.groupBy("label", "own").agg(F.count("*").alias("n"))
    main = counted.groupBy("label").agg(F.max_by("own", F.struct("n", "own")).alias("main"))
    rest = big.join(main, "label").where("own <> main").select("label", "node")
    left = found.join(rest, ["label", "node"])
    groups = left.groupBy("label").agg(F.ceil(F.sum(F.length("set")) / (8 * block_elements)).cast("int").alias("groups"))
    pair = F.concat_ws(":", F.lit("x"), "label", "part", "group")
    lefts = (left.join(groups, "label").withColumn("group", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(pair.alias("block"), "node", F.lit("left").alias("role"), "set"))
    rights = (found.join(groups, "label").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .select(pair.alias("block"), "node", F.lit("right").alias("role"), "set"))
    return edges.unionAll(_links(lefts.unionAll(rights), share))


def jaccard_components(docs: DataFrame, block_elements: int = BLOCK_ELEMENTS, words: int = WORDS,
                       share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; linked are sets of shingles of ``words`` words with a
    similarity of ``share`` hundredths or more."""
    every = staged(sets(docs, words, share), "sets")
    joined = every.where("doc_id IS NOT NULL AND node IS NOT NULL")
    label_of = components(staged(links(docs, joined, block_elements, words, share), "links"))
    nodes = joined.groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(label_of, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = labelled.join(smallest, "label").select("node", "component_id")
    return (every.drop("signs").join(of_node, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, all columns; rows without an id stay.

    A row is known by its id and its text, so other texts under a repeated id are judged by themselves. Rows alike in
    both are one document: they stay or go together.
    """
    key = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", key.alias("__key")))
    found = jaccard_components(docs.select(known.alias("doc_id"), "text"), words=words, share=share)
    extra = staged(found.where("component_id <> doc_id").select("doc_id.*").distinct(), "extra")
    return docs.withColumn("__key", key).join(
        F.broadcast(extra) if extra.count() <= BROADCAST_IDS else extra, ["doc_id", "__key"], "left_anti").select(
        docs.columns)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {"op8_ngram_jaccard_join": op8_ngram_jaccard_join}
SQL = {"op8_ngram_jaccard_join": rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + {WORDS} - 1], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {WORDS} + 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
          FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
         WHERE {PART} * common >= {SHARE} * (p.n + q.n - common)),
edges AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS origin, doc_id AS met FROM d UNION SELECT origin, b FROM reach JOIN edges ON met = a),
labels AS (SELECT origin, min(met) AS component_id FROM reach GROUP BY origin)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN labels ON origin = d.doc_id"""}

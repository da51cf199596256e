"""Prefix trie of rebuilt conversations by collapsing whole sequences.

Conversations are rebuilt, and identical ones become one weighted sequence with the list of the conversations that end
there. Only one conversation of each sequence goes on. Its prefixes are the nodes of the trie: a node's members are the
summed weights, sequences that are proper prefixes of others fall out by an anti-join, and the rest are the leaves.

A sequence is named by the sum of one hash for each (place, turn): four 32-bit words, so sums are exact and parts of a
conversation can be hashed apart and added up. A prefix's name is a running sum, taken in runs of ``RUN`` turns whose
totals are carried, so a conversation of any length is spread over tasks.

The tokens saved below a node are summed without listing its descendants. Each node belongs to the sequence whose first
conversation is the smallest of the node's members; along a sequence, its own nodes are a tail. So the distinct texts below
a node are, for each sequence through it, what the sequence's tail adds to the node's subtree.

Turns are ordered by turn (null first), then role and text, so ties have one result; repeated rows are turns each. Null
roles and texts are empty; an empty text is a turn like others. Rows without a conversation id take no part; the remainder
of a negative id is negative or 0. A conversation without turns after rebuilding ends in the root. No rows: no nodes, not
even a root. Only conv_id, turn, role and text are read, so other columns cannot clash. Very long texts are hashed whole;
they are shuffled once, by the sort.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from intactly.llm.common import crc32_sql, staged, table
from intactly.operators.ordered import numbered

#: A conversation c starts with the first crc32(c) % SHARED turns of conversation c - c % FAMILY.
FAMILY, SHARED = 5, 9
#: Turns whose running sums are taken in one task.
RUN = 4096
#: Ids joined into one piece of an end list.
LIST_IDS = 8192

_WORDS = ("w1", "w2", "w3", "w4")
_NODE = ("depth", "k1", "k2")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (1-based, in order over all rows), turn_key (128 bits of role and text, as hex) and n_bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    src = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    named = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return numbered(src, [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                    keep=("conv_id", F.substring(named, 1, 32).alias("turn_key"),
                          F.octet_length("text").cast("long").alias("n_bytes")))


def rebuilt(rows: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Ids of all conversations, and the turns after rebuilding: conv, depth (from 1), words w1 to w4 and n_bytes."""
    own = rows.groupBy("conv_id").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    plan = own.select("conv_id", "first", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
                      (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = staged(plan.join(bases, "base", "left")
                  .withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0)))).drop("n_base"), "plan")
    placed = rows.join(plan.select("conv_id", "first", "h", "n_head"), "conv_id").withColumn(
        "pos", F.col("position") - F.col("first") + 1)
    tails = placed.where("pos > h").select(
        F.col("conv_id").alias("conv"), (F.col("n_head") + F.col("pos") - F.col("h")).alias("depth"), "turn_key", "n_bytes")
    starts = placed.where(F.col("pos") < shared).select(F.col("conv_id").alias("base"), "pos", "turn_key", "n_bytes")
    heads = (plan.select(F.col("conv_id").alias("conv"), "base", "n_head").join(starts, "base").where("pos <= n_head")
             .select("conv", F.col("pos").alias("depth"), "turn_key", "n_bytes"))
    low = F.lit(0xFFFFFFFF)
    mixed = tails.unionAll(heads)
    for i in (0, 1):
        mixed = mixed.withColumn(f"m{i}", F.xxhash64(F.lit(i), "depth", "turn_key"))
    words = [w for i in (0, 1) for w in (F.shiftrightunsigned(f"m{i}", 32), F.col(f"m{i}").bitwiseAND(low))]
    return plan.select(F.col("conv_id").alias("conv")), staged(
        mixed.select("conv", "depth", *[w.alias(n) for w, n in zip(words, _WORDS, strict=True)], "n_bytes"), "rebuilt")


def _key(sums, depth) -> list:
    """The name of a sequence: its length, and its four sums (each modulo 2^32) as two longs."""
    low = [s.bitwiseAND(F.lit(0xFFFFFFFF)) for s in sums]
    pair = lambda a, b: F.shiftleft(a, 32).bitwiseOR(b)
    return [depth, pair(low[0], low[1]), pair(low[2], low[3])]


def sequences(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sequences: depth, k1, k2, n_convs, conv (the smallest) and total (bytes); and all conversations'
    keys (conv, depth, k1, k2)."""
    none = F.lit(0).cast("long")
    whole = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("total"),
                                     *[F.sum(w).alias(w) for w in _WORDS])
    whole = convs.join(whole, "conv", "left").na.fill(0)
    key = [k.alias(n) for k, n in zip(_key([F.col(w) for w in _WORDS], F.coalesce("n", none)), _NODE, strict=True)]
    whole = staged(whole.select("conv", *key, "total"), "whole")
    return (staged(whole.groupBy(*_NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"),
                                             F.first("total").alias("total")), "sequences"), whole.drop("total"))


def end_lists(whole: DataFrame) -> DataFrame:
    """depth, k1, k2 and ends_sha256 of each sequence: the digest of its ascending, comma-joined ids.

    A digest reads its list in order, so one task takes a whole list; ids reach it joined into pieces of ``LIST_IDS``,
    made in the range-sorted tasks before it, and it holds one batch at a time.
    """
    order = [*_NODE, "conv"]
    n = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = whole.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = "depth long, k1 long, k2 long, first long, piece string"

    def runs(batches):
        """(key, ids) of the runs of equal keys, over the batches of a task."""
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            start, rows = 0, list(zip(*columns[:3], strict=True))
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i] != rows[start]:
                    yield rows[start], columns[3][start:i]
                    start = i

    def pieces(batches):
        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*made, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True)],
                ["depth", "k1", "k2", "first", "piece"])
            made.clear()
            return out

        made, open_key, ids = [], None, []
        for key, found in runs(batches):
            if ids and (key != open_key or len(ids) >= LIST_IDS):
                made.append((*open_key, ids[0], ",".join(map(str, ids))))
                ids = []
            open_key, ids = key, ids + found
            if len(made) >= 1000:
                yield flush()
        if ids:
            made.append((*open_key, ids[0], ",".join(map(str, ids))))
        if made:
            yield flush()

    def digests(batches):
        names = [*_NODE, "ends_sha256"]
        types = [pa.int64()] * 3 + [pa.string()]
        open_key, digest, made = None, None, []
        for batch in batches:
            *key_columns, _, texts = [c.to_pylist() for c in batch.columns]
            for key, text in zip(zip(*key_columns, strict=True), texts, strict=True):
                if key != open_key:
                    if open_key is not None:
                        made.append((*open_key, digest.hexdigest()))
                    open_key, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)
                made = []
        if open_key is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((*open_key, digest.hexdigest()), types, strict=True)], names)

    joined = listed.mapInArrow(pieces, schema)
    return (joined.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "first")
            .mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string"))


def prefixes(seqs: DataFrame, rows: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence: its key, its parent's (p1, p2), n_bytes of its last turn, the bytes before
    that turn, and n_convs, conv, total and length of the sequence."""
    facts = seqs.select("conv", "n_convs", "total", F.col("depth").alias("length"))
    mine = rows.join(facts, "conv").withColumn("run", F.floor((F.col("depth") - 1) / RUN))
    summed = [*_WORDS, "n_bytes"]
    inside = Window.partitionBy("conv", "run").orderBy("depth")
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = mine.groupBy("conv", "run").agg(*[F.sum(c).alias(c) for c in summed]).select(
        "conv", "run", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_carried") for c in summed])
    placed = mine.withColumns({f"{c}_upto": F.sum(c).over(inside) for c in summed}).join(totals, ["conv", "run"])
    upto = {c: F.col(f"{c}_upto") + F.col(f"{c}_carried") for c in summed}
    here = _key([upto[w] for w in _WORDS], F.col("depth"))
    above = _key([upto[w] - F.col(w) for w in _WORDS], F.col("depth") - 1)
    nodes = placed.select("conv", *[k.alias(n) for k, n in zip(here, _NODE, strict=True)], above[1].alias("p1"),
                          above[2].alias("p2"), "n_bytes", (upto["n_bytes"] - F.col("n_bytes")).alias("before"),
                          "n_convs", "total", "length")
    zero = F.lit(0).cast("long")
    root = facts.select("conv", *[zero.alias(n) for n in (*_NODE, "p1", "p2", "n_bytes", "before")], "n_convs", "total",
                        "length")
    return staged(nodes.unionByName(root), "prefixes")


def trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    convs, rows = rebuilt(turns(conversations), family, shared)
    seqs, whole = sequences(convs, rows)
    paths = prefixes(seqs, rows)
    on = list(_NODE)
    proper = paths.where(F.col("depth") < F.col("length")).select(*on).distinct()
    leaves = seqs.join(proper, on, "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))

    below = F.col("total") - F.col("before")  # bytes of the sequence from the node's last turn on
    nodes = staged(paths.groupBy(*on).agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.sum("n_convs").alias("n_convs"),
        F.min("conv").alias("conv_id"), F.sum(F.col("n_convs") * below).alias("gross")), "nodes")
    # The tail of a sequence that consists of its own nodes starts after this many bytes.
    tails = (paths.join(nodes.select(*on, F.col("conv_id").alias("conv")), [*on, "conv"])
             .groupBy("conv").agg(F.min("before").alias("tail")))
    facts = tails.join(leaves, "conv", "left")
    marked = paths.join(facts, "conv").groupBy(*on).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.col("total") - F.greatest("before", "tail")).alias("distinct_bytes"))

    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(marked, on).join(children, on, "left").join(end_lists(whole), on, "left")
            .join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                    (F.col("gross") - F.col("distinct_bytes")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


QUERIES = {"op13_conversation_trie": op13_conversation_trie}
SQL = {"op13_conversation_trie": f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id
                                     ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
           FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY k) AS turns, c - c % {FAMILY} AS base,
             {crc32_sql("CAST(c AS VARCHAR)")} % {SHARED} AS h FROM t GROUP BY c),
r AS (SELECT l.c, list_concat(coalesce(b.turns[1:l.h], []), l.turns[l.h + 1:]) AS seq
      FROM l LEFT JOIN l b ON b.c = l.base),
p AS (SELECT c, d, seq[1:d] AS pre, len(seq) = d AS ended, coalesce(strlen(seq[d].text), 0) AS bytes
      FROM (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM r)),
n AS (SELECT d, pre, min(c) AS conv, count(*) AS n_convs, any_value(bytes) AS bytes,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
      FROM p GROUP BY d, pre),
m AS (SELECT p.c, p.d, n.conv FROM p JOIN n USING (d, pre)),
o AS (SELECT n.conv, n.d, n_convs, bytes, ends_sha256, m.conv AS parent
      FROM n LEFT JOIN m ON m.c = n.conv AND m.d = n.d - 1),
k AS (SELECT parent AS conv, d - 1 AS d, count(*) AS n_children FROM o WHERE d > 0 GROUP BY ALL),
u AS (SELECT o.*, coalesce(n_children, 0) AS n_children FROM o LEFT JOIN k USING (conv, d)),
s AS (SELECT m.conv, m.d, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved
      FROM u JOIN m ON m.c = u.conv AND m.d <= u.d GROUP BY ALL)
SELECT conv AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends_sha256 FROM u JOIN s USING (conv, d)"""}

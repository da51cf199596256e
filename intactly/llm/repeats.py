"""Exact removal of repeated byte strings by a column-wise collection transform.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in any document. Comparing all
suffixes of all documents in one structure would be one job for one machine, so documents are first dealt into pieces that
can be compared apart. Every string of ``length`` bytes has an anchor, the ``anchor``-byte word in it with the least hash
(the leftmost of ties); it depends on the string alone. The strings of a document that share an anchor are neighbours and
form one piece. So equal strings lie in pieces of one anchor, at equal distance from it, and anchors that occur once need
no comparison.

Pieces of an anchor form a collection, aligned on the anchor. ``Collection`` builds its transform column by column from the
right: each round inserts the next symbol of every piece into the order of all suffixes (a stable sort by the symbol) and
updates the common prefix of neighbours from that of the round before. Columns, orders and prefixes go through sequential
files; a round holds one of each. A string is repeated if its common prefix with a neighbour reaches ``length``.

Identical pieces are counted before any text is shipped, and go into a collection twice at most: two already repeat
everything in them. An anchor with more than ``limit`` distinct pieces (a line in very many contexts) is dealt anew: its
pieces are cut in halves, each with more bytes common to all its strings, and these bytes replace the anchor. Halves that
became identical are counted again. In the end a piece is a single string, so every such group comes apart.

Null texts are empty. Texts shorter than ``length`` keep all bytes. Copies of a text are rows each, and repeat each other.
Repeats within a document count, overlapping ones too. Long texts are read in segments of ``SEGMENT`` strings; a run of one
repeated piece (one letter thousands of times) is one row. Null and repeated ids pass through as they are. No documents, no
rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from intactly.llm.common import staged, table

LENGTH = 200
#: Strings of one document whose hashes are held at once.
SEGMENT = 1 << 20
#: Pieces dealt to a task's collection; most distinct pieces of one anchor in it.
COLLECTION, LIMIT = 16_384, 8_192
#: A byte that UTF-8 never holds.
PADDING = 0xFF

_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def anchor_width(length: int) -> int:
    """A power of two near a third of the length, 8 at least."""
    if length < 8:
        raise ValueError("strings need 8 bytes at least")
    return max(8, 1 << ((length // 3).bit_length() - 1))


def word_hashes(data: bytes, width: int) -> np.ndarray:
    """64-bit hashes of the words of ``width`` bytes (8 times a power of two) at every place."""
    octets = np.frombuffer(data, np.uint8)
    h = np.ndarray((len(octets) - 7,), "<u8", octets, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    step = 8
    while step < width:
        h = h[:-step] * np.uint64(0xBF58476D1CE4E5B9) + h[step:]
        step *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def pieces(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First string, last string, place of the anchor and hash of the anchor of each piece, segment by segment."""
    width = anchor_width(length)
    span = length - width + 1  # places of words in a string
    for start in range(0, len(data) - length + 1, SEGMENT):
        h = word_hashes(data[start:start + SEGMENT + length - 1], width)
        n = len(h)
        # The least hash with its place, over each window of ``span`` places: from the ends of blocks of that size.
        key = np.full(n + -n % span, _FAR)
        key[:n] = (h & _HIGH) | np.arange(n, dtype=np.uint64)
        block = key.reshape(-1, span)
        upto = np.minimum.accumulate(block, axis=1).ravel()
        rest = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(rest[:n - span + 1], upto[span - 1:n]) & _LOW
        cut = np.flatnonzero(least[1:] != least[:-1])
        first, last = np.append(0, cut + 1), np.append(cut, len(least) - 1)
        place = least[first].astype(np.int64)
        yield first + start, last + start, place + start, h[place].view(np.int64)


def fingerprint(data: bytes, offset: int) -> bytes:
    return hashlib.blake2b(data, digest_size=16, salt=offset.to_bytes(8, "little")).digest()


class Collection:
    """Sorted suffixes of aligned strings, by columns from right to left, with the common prefixes of neighbours."""

    def __init__(self, strings: Sequence[bytes], shifts: np.ndarray):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.n, self.width = len(strings), int((shifts + sizes).max())
        row = np.repeat(np.arange(self.n), sizes)
        column = np.arange(len(row)) + np.repeat(shifts - np.cumsum(sizes) + sizes, sizes)
        symbols = np.full((self.width, self.n), PADDING, np.uint8)
        symbols[column, row] = np.frombuffer(b"".join(strings), np.uint8)
        self.columns, self.before, self.after = (tempfile.TemporaryFile() for _ in range(3))
        symbols.tofile(self.columns)
        self._write(np.arange(self.n, dtype=np.int32), np.full(self.n, self.width, np.int32))

    def _write(self, order: np.ndarray, ends: np.ndarray) -> None:
        self.after.seek(0)
        order.tofile(self.after)
        ends.tofile(self.after)
        self.before, self.after = self.after, self.before

    def _read(self, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.columns.seek(x * self.n)
        self.before.seek(0)
        order, ends = (np.fromfile(self.before, np.int32, self.n) for _ in range(2))
        return np.fromfile(self.columns, np.uint8, self.n)[order], order, ends

    def rounds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each column from the last: the column, the strings in order of what starts there, and the column where
        each stops agreeing with the one before it."""
        for x in range(self.width - 1, -1, -1):
            symbol, order, ends = self._read(x)
            rank = np.argsort(symbol, kind="stable")
            symbol = symbol[rank]
            # Neighbours of one symbol agree as far as all that stood between them did.
            between = np.minimum.reduceat(np.append(ends, 0), rank + 1)
            ends = np.full(self.n, x, np.int32)
            same = np.flatnonzero(symbol[1:] == symbol[:-1])
            ends[same + 1] = between[same]
            order = order[rank]
            self._write(order, ends)
            yield x, order, ends

    def close(self) -> None:
        for f in (self.columns, self.before, self.after):
            f.close()


def repeated(strings: Sequence[bytes], shifts: Sequence[int], counts: Sequence[int], length: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first, after) of the bytes that repeated strings cover in each piece; pieces that occur more than once are
    inserted twice."""
    shift, count = np.array(shifts, np.int64), np.array(counts, np.int64)
    own = np.concatenate([np.arange(len(strings)), np.flatnonzero(count > 1)])
    group = Collection([strings[i] for i in own], shift[own])
    found = np.zeros((len(strings), max(1, group.width - length + 1)), bool)
    try:
        for x, order, ends in group.rounds():
            if x + length <= group.width:
                alike = np.append(ends >= x + length, False)
                alike[0] = False
                found[own[order[alike[:-1] | alike[1:]]], x] = True
    finally:
        group.close()
    # Only strings that lie in the piece: what reaches into padding is none.
    x = np.arange(found.shape[1])
    strings_in = np.array([len(s) for s in strings]) - length + 1
    found &= (x >= shift[:, None]) & (x < (shift + strings_in)[:, None])
    edge = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
    piece, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    return piece, first - shift[piece], last - shift[piece] + length


def _batches(schema: StructType, rows: Sequence[Sequence]) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)], schema=arrow)


def anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """anchor and n: how many pieces have each anchor."""
    schema = StructType.fromDDL("anchor long, n long")

    def run(batches):
        for batch in batches:
            found = [h for data in batch.column(0).to_pylist() for *_, h in pieces(data, length)]
            if found:
                yield _batches(schema, np.unique(np.concatenate(found), return_counts=True))

    return texts.select("data").mapInArrow(run, schema).groupBy("anchor").agg(F.sum("n").alias("n"))


_PLACED = "key binary, anchor long, piece binary, first int, again int, size int, offset int, n long"


def placed_pieces(texts: DataFrame, length: int) -> DataFrame:
    """Pieces where they stand: the text's key, the anchor's hash, the piece's fingerprint, the place of the first and the
    last of ``n`` adjacent repetitions, the bytes of one and its anchor's offset."""
    schema = StructType.fromDDL(_PLACED)

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for key, data in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist(), strict=True):
                for found in pieces(data, length):
                    start = len(rows)
                    for a, b, place, h in zip(*(c.tolist() for c in found), strict=True):
                        name = fingerprint(data[a:b + length], place - a)
                        if len(rows) > start and rows[-1][2] == name:
                            rows[-1] = (*rows[-1][:4], a, *rows[-1][5:7], rows[-1][7] + 1)
                        else:
                            rows.append((key, h, name, a, a, b - a + length, place - a, 1))
            if rows:
                yield _batches(schema, list(zip(*rows, strict=True)))

    return texts.mapInArrow(run, schema)


_PIECES = "anchor long, piece binary, data binary, offset int, low int, high int, n long"


def contents(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The distinct pieces with their bytes, read from one text that holds them. ``low`` and ``high`` bound the distance
    from a string's start to its anchor."""
    schema = StructType.fromDDL(_PIECES)
    high = length - anchor_width(length)
    held = (found.groupBy("anchor", "piece")
            .agg(F.sum("n").alias("n"), F.min(F.struct("key", "first", "size", "offset")).alias("at"))
            .select("anchor", "piece", "n", "at.*"))
    wanted = held.groupBy("key").agg(F.collect_list(F.struct("anchor", "piece", "first", "size", "offset", "n"))
                                     .alias("wanted"))  # bounded by the length of the text
    sources = texts.dropDuplicates(["key"]).join(wanted, "key").select("data", "wanted")

    def run(batches):
        for batch in batches:
            for data, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(w["anchor"], w["piece"], data[w["first"]:w["first"] + w["size"]], w["offset"], 0, high, w["n"])
                        for w in asked]
                yield _batches(schema, list(zip(*rows, strict=True)))

    return sources.mapInArrow(run, schema)


_COVERED = "piece binary, covered array<struct<first:int,after:int>>"


def _compared(found: DataFrame, length: int, collection: int) -> DataFrame:
    """Covered ranges of the pieces of anchors that fit into one collection."""
    schema = StructType.fromDDL(_COVERED)
    deals = max(1, -(-found.count() // collection))

    def run(rows: pa.Table) -> pa.Table:
        names, data, counts = (rows.column(c).to_pylist() for c in ("piece", "data", "n"))
        shifts = rows.column("high").to_numpy() - rows.column("offset").to_numpy()
        covered: dict[int, list] = {}
        for i, first, after in zip(*(c.tolist() for c in repeated(data, shifts, counts, length)), strict=True):
            covered.setdefault(i, []).append({"first": first, "after": after})
        return pa.Table.from_batches([_batches(schema, [[names[i] for i in covered], list(covered.values())])])

    return (found.withColumn("deal", F.pmod(F.xxhash64("anchor"), F.lit(deals))).groupBy("deal")
            .applyInArrow(run, schema))


_HALVES = "whole binary, at int, anchor long, piece binary, data binary, offset int, low int, high int, n long"


def _halves(found: DataFrame, length: int) -> DataFrame:
    """The pieces cut in halves by the distance to the anchor; what all strings of a half share is its anchor."""
    schema = StructType.fromDDL(_HALVES)

    def run(batches):
        for batch in batches:
            rows = []
            for w in batch.to_pylist():
                data, anchor = w["data"], w["offset"]
                middle = (w["low"] + w["high"]) // 2
                for low, high in ((w["low"], middle), (middle + 1, w["high"])):
                    first, last = max(0, anchor - high), min(len(data) - length, anchor - low)
                    if first > last:
                        continue
                    common = hashlib.blake2b(data[anchor - low:anchor - high + length], digest_size=8,
                                             salt=bytes([low & 255, low >> 8, high & 255, high >> 8]))
                    part = data[first:last + length]
                    rows.append((w["piece"], first, int.from_bytes(common.digest(), "little", signed=True),
                                 fingerprint(part, (anchor - first) << 32 | high), part, anchor - first, low, high,
                                 w["n"]))
            if rows:
                yield _batches(schema, list(zip(*rows, strict=True)))

    return found.mapInArrow(run, schema)


def covered(found: DataFrame, length: int, collection: int = COLLECTION, limit: int = LIMIT) -> DataFrame:
    """piece and covered ranges, one or more rows a piece, for staged pieces."""
    large = found.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > limit).select("anchor")
    if large.isEmpty():
        return _compared(found, length, collection)
    large = staged(large, "large")
    small = _compared(staged(found.join(large, "anchor", "left_anti"), "small"), length, collection)
    halves = staged(_halves(found.join(large, "anchor", "left_semi").select(*found.columns), length), "halves")
    same = ["offset", "low", "high"]
    parts = staged(halves.groupBy("anchor", "piece").agg(
        F.first("data").alias("data"), *[F.first(c).alias(c) for c in same], F.sum("n").alias("n")
    ).select(*found.columns), "parts")
    below = covered(parts, length, collection, limit)
    moved = F.transform("covered", lambda c: F.struct((c["first"] + F.col("at")).alias("first"),
                                                      (c["after"] + F.col("at")).alias("after")))
    back = halves.select("whole", "at", "piece").join(below, "piece").select(F.col("whole").alias("piece"),
                                                                           moved.alias("covered"))
    return small.unionByName(back)


def repeats(docs: DataFrame, length: int = LENGTH, collection: int = COLLECTION, limit: int = LIMIT) -> DataFrame:
    """key (of a text) and spans (byte ranges, sorted, may overlap) that repeated strings cover in it."""
    texts = _texts(docs).select("key", "data").where(F.octet_length("data") >= length)
    several = anchor_counts(texts, length).where("n > 1").select("anchor")
    found = _released(staged(placed_pieces(texts, length).join(several, "anchor"), "placed"))
    known = _released(staged(contents(found, texts, length), "contents"))
    ranges = _released(staged(covered(known, length, collection, limit), "covered"))
    span = F.explode(F.transform("covered", lambda c: F.struct((F.col("first") + c["first"]).alias("first"),
                                                               (F.col("again") + c["after"]).alias("after"))))
    spans = found.select("key", "piece", "first", "again").join(ranges, "piece").select("key", span.alias("span"))
    return spans.groupBy("key").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, the text's bytes and their 128-bit key."""
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select("doc_id", data.alias("data")).withColumn("key", F.unhex(F.md5("data")))


def _released(df: DataFrame) -> DataFrame:
    """Lets the driver drop shuffle files of steps whose result is written by now."""
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def _kept(data: bytes, spans: Sequence[dict] | None) -> tuple[bytes, int]:
    """What the spans leave, and the number of maximal spans."""
    kept, runs, end = [], 0, -1
    for span in spans or ():
        if span["first"] > end:
            kept.append(data[max(end, 0):span["first"]])
            runs += 1
        end = max(end, span["after"])
    return b"".join([*kept, data[max(end, 0):]]), runs


def without_repeats(docs: DataFrame, length: int = LENGTH, collection: int = COLLECTION, limit: int = LIMIT,
                    as_text: bool = True) -> DataFrame:
    """doc_id, kept (the bytes left; only ``as_text``), n_bytes, n_removed, n_spans and kept_sha256 of every document row."""
    joined = _texts(docs).join(repeats(docs, length, collection, limit), "key", "left").select("doc_id", "data", "spans")
    schema = StructType(joined.schema.fields[:1] + StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").fields)

    def run(batches):
        for batch in batches:
            made = []
            for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, runs = _kept(data, spans)
                made.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(),
                             kept if as_text else None))
            yield _batches(schema, [batch.column(0), *zip(*made, strict=True)])

    out = joined.mapInArrow(run, schema)
    return out if as_text else out.drop("kept")


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), as_text=False)


QUERIES = {"op12_suffix_array_dedup": op12_suffix_array_dedup}
SQL = {"op12_suffix_array_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT i, k, md5(b[k + 1:k + {LENGTH}]) AS h
      FROM (SELECT i, b, unnest(range(octet_length(b) - {LENGTH} + 1)) AS k FROM d)),
r AS (SELECT i, k FROM p SEMI JOIN (SELECT h FROM p GROUP BY h HAVING count(*) > 1) USING (h)),
s AS (SELECT i, k, sum(fresh) OVER (PARTITION BY i ORDER BY k) AS run
      FROM (SELECT i, k, CASE WHEN k - lag(k) OVER (PARTITION BY i ORDER BY k) <= {LENGTH} THEN 0 ELSE 1 END AS fresh
            FROM r)),
t AS (SELECT i, run, min(k) AS a, max(k) + {LENGTH} AS z FROM s GROUP BY ALL),
u AS (SELECT i, run, a, z, coalesce(lag(z) OVER (PARTITION BY i ORDER BY run), 0) AS kept_from,
             lead(a) OVER (PARTITION BY i ORDER BY run) IS NULL AS final FROM t),
c AS (SELECT i, count(*) AS n_spans, sum(z - a) AS n_removed,
             string_agg(hex(b[kept_from + 1:a]) || CASE WHEN final THEN hex(b[z + 1:octet_length(b)]) ELSE '' END, ''
                        ORDER BY run) AS kept
      FROM u JOIN d USING (i) GROUP BY i)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256
FROM d LEFT JOIN c USING (i)"""}

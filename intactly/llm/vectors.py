"""Exact top-k search by inner product with vector-approximation files.

Queries go in blocks of a bounded number, each broadcast and searched against all rows. A task reads its vectors batch by
batch. In each batch, components are quantised to cells of a grid per dimension; the cells alone bound every score from
above. For each query, exact vectors are then read in the order of these bounds until the k-th best score so far is
above all bounds left; that k-th score is carried on to the next batch. Partial results of k rows for each query and
task meet in one top-k for each query.

Components are integers floor(scale * x). Vectors that are null, or hold a null or non-finite component, and rows without
an id take no part. Shorter vectors count as filled up with zeros; an empty vector scores 0 with all. A query is compared
with every row but those of its own id. Ties go to the smaller id; rows that repeat an id are candidates each, and a
repeated query row gets results of its own. Scores beyond 64 bits are held at the limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from intactly.llm.common import staged, table

SCALE = 1024
K = 10
#: Queries broadcast at once.
BLOCK_QUERIES = 4096
#: Cells for each dimension.
CELLS = 64
#: Largest sum of products that doubles hold exactly.
EXACT = 2.0 ** 53
_LIMIT = 2 ** 63 - 1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (doubles) of the rows that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite))


def matrix(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """Rows of floor(scale * x), filled with zeros or cut to ``width`` (what lies beyond meets zeros only)."""
    lengths = np.asarray(pc.list_value_length(column), np.int64)
    values = np.floor(np.asarray(column.flatten(), np.float64) * scale)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    ends = np.cumsum(lengths)
    for i, (end, n) in enumerate(zip(ends, lengths, strict=True)):
        out[i, :min(n, width)] = values[end - n:end][:width]
    return out


def cell_bounds(v: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper end of the cell of each component, on an even grid between a dimension's ends."""
    low, high = v.min(axis=0), v.max(axis=0)
    step = np.maximum((high - low) / cells, 1e-300)
    cell = np.minimum(((v - low) / step).astype(np.int64), cells - 1).astype(np.uint8)
    lower = np.minimum(low + cell * step, v)  # rounding must never put a component outside its cell
    upper = np.maximum(low + (cell + 1) * step, v)
    return lower, upper


def exact_scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``v`` with ``q``."""
    if np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * max(1, v.shape[1]) < EXACT:
        return (v @ q).astype(np.int64)
    whole = [int(x) for x in q]
    return np.array([max(-_LIMIT, min(_LIMIT, sum(int(a) * b for a, b in zip(row, whole, strict=True)))) for row in v],
                    np.int64)


class Search:
    """The k best rows seen so far for each query of a block."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, cells: int = CELLS):
        self.ids, self.q, self.k, self.cells = query_ids, queries, k, cells
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in query_ids]  # scores, ids

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        lower, upper = cell_bounds(v, self.cells)
        bound = np.maximum(self.q, 0) @ upper.T + np.minimum(self.q, 0) @ lower.T
        most = np.abs(self.q).sum(axis=1, keepdims=True) * max(np.abs(v).max(initial=0), 1)
        bound += 1e-12 * most  # more than the bounds' own rounding
        for i, own in enumerate(self.ids):
            scores, found = self.best[i]
            ub = bound[i]
            order = np.flatnonzero(ub >= scores[-1]) if len(scores) == self.k else np.arange(len(ids))
            order = order[np.argsort(-ub[order], kind="stable")]
            at, step = 0, 2 * self.k
            while at < len(order) and (len(scores) < self.k or ub[order[at]] >= scores[-1]):
                read = order[at:at + step]
                read = read[ids[read] != own]
                scores = np.concatenate([scores, exact_scores(v[read], self.q[i])])
                found = np.concatenate([found, ids[read]])
                first = np.lexsort((found, -scores))[:self.k]
                scores, found = scores[first], found[first]
                at, step = at + step, 2 * step
            self.best[i] = scores, found


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding", block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row that meets the condition ``is_query``."""
    rows = usable(vectors, id_col, vector_col)
    queries = staged(usable(vectors.where(is_query), id_col, vector_col)
                     .withColumn("row", F.monotonically_increasing_id()), "queries")
    total = queries.count()
    blocks = max(1, -(-total // block_queries))
    # Rows are numbered upwards within each file's task, so the remainder deals them out evenly.
    parts = [_block(rows, queries.where(F.pmod("row", F.lit(blocks)) == b), k, scale) for b in range(blocks)]
    if blocks > 1:
        parts = [staged(p, "best") for p in parts]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    best = Window.partitionBy("row", "query_id").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _block(rows: DataFrame, queries: DataFrame, k: int, scale: int) -> DataFrame:
    """The k best of each task for one block of queries."""
    block = queries.toArrow()
    lists = block.column("v").combine_chunks()
    width = int(pc.max(pc.list_value_length(lists)).as_py() or 0)
    shared = rows.sparkSession.sparkContext.broadcast(
        (block.column("row").to_numpy(), block.column("id").to_numpy(), matrix(lists, scale, width)))
    schema = StructType.fromDDL("row long, query_id long, vec_id long, score long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        number, ids, q = shared.value
        search = Search(ids, q, k)
        for batch in batches:
            if len(batch) and len(ids):
                search.add(batch.column(0).to_numpy(), matrix(batch.column(1), scale, q.shape[1]))
        for i, (scores, found) in enumerate(search.best):
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), number[i])), pa.array(np.full(len(found), ids[i])),
                     pa.array(found), pa.array(scores)], schema=arrow)

    return rows.mapInArrow(run, schema)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op9_exact_top_k": op9_exact_top_k}
SQL = {"op9_exact_top_k": f"""
WITH v AS (SELECT vec_id, [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}"""}

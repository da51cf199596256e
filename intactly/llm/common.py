"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from intactly.session import scratch_path

# Rows in one Arrow batch. Python holds one batch at a time, so this bounds a worker's memory
# when texts are long; it changes no result.
BATCH_ROWS = 1000

# A-Z become a-z, other bytes stay (UTF-8 letters beyond ASCII are left alone).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# As LOWER, and every ASCII byte that is neither a letter nor a digit becomes a space.
WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also sets the Arrow batch size for the Python stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps restart from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of the UTF-8 bytes of a text expression, bit by bit from the polynomial."""
    octets = f"[CAST('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(strlen({text}))]"
    bit = "lambda r, k: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return (f"xor(list_reduce({octets}, lambda c, b: list_reduce(range(8), {bit}, xor(c, b)), 4294967295), 4294967295)")


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class BoundedCache(dict):
    """Memo of ``make(key)``. With ``limit`` entries it starts anew and keeps the full one as the older half, from
    which keys still in use come back; so memory stays bounded and frequent keys are kept. Keys over ``longest``
    characters are computed each time."""

    def __init__(self, make: Callable, limit: int = 500_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def map_texts(docs: DataFrame, fields: str, factory: Callable, carry: Sequence[str] = ("doc_id",),
              text: str = "text") -> DataFrame:
    """``carry`` columns plus the columns of ``fields`` (DDL), computed from the text column.

    ``factory()`` runs once in each task and returns ``fn(texts) -> columns``; ``texts`` may hold None.
    Only the named columns leave the scan, so other columns of ``docs`` cannot clash.
    """
    src = docs.select(*[F.col(c) for c in carry], F.col(text).cast("string").alias("__text"))
    schema = StructType(src.schema.fields[:-1] + StructType.fromDDL(fields).fields)
    arrow = to_arrow_schema(schema)
    kept = len(carry)

    def run(batches):
        fn = None
        for batch in batches:
            fn = fn or factory()
            columns = fn(batch.column(kept).to_pylist())
            arrays = [batch.column(i).cast(arrow.field(i).type) for i in range(kept)]
            arrays += [pa.array(c, type=arrow.field(kept + i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return src.mapInArrow(run, schema)


def filter_rows(docs: DataFrame, factory: Callable) -> DataFrame:
    """Rows of ``docs`` (all columns) for which ``fn(batch)`` is true; ``factory()`` makes ``fn``."""
    arrow = to_arrow_schema(docs.schema)

    def run(batches):
        fn = None
        for batch in batches:
            fn = fn or factory()
            kept = batch.filter(pa.array(fn(batch), type=pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(i).cast(arrow.field(i).type) for i in range(len(arrow))], schema=arrow)

    return docs.mapInArrow(run, docs.schema)

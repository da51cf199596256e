"""Incremental arrival of files with Structured Streaming.

The file source remembers which files it has delivered in its checkpoint,
so ``trigger(availableNow=True)`` processes only files that arrived since
the last run; a run with nothing new delivers no batch. Each micro-batch is
validated once (staged), then written to both branches by epoch id, so a
replayed epoch overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from intactly.functions.rules import Rule
from intactly.operators import validate, zone
from intactly.operators.ordered import staged


#: Files in one micro-batch, at most, unless the caller asks for another number; all files are read either way.
MAX_FILES = 64


def ingest_available(spark: SparkSession, landing: str, schema: StructType, checkpoint: str,
                     zone_root: str, rejects_root: str, checks: Sequence[Rule],
                     prepare: Callable[[DataFrame], DataFrame], max_files: int = MAX_FILES) -> int:
    """Runs one availableNow pass; returns the number of micro-batches processed."""
    seen: list[int] = []

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # The stream's own id: a new checkpoint counts epochs from 0 again.
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        valid = staged(validate.with_reasons(prepare(batch), checks), "validated")
        zone.write_epoch(spark, validate.accepted(valid), zone_root, epoch_id, stream=stream)
        zone.write_epoch(spark, validate.rejected(valid), rejects_root, epoch_id, stream=stream)
        seen.append(epoch_id)

    query = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
             .writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(seen)

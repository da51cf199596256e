"""Bounded samples of labelled documents for the trained operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intactly.llm.common import staged


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text and y (0.0 to 1.0) of at most ``rows`` labelled documents, written to the shared folder.

    The labelled ids with the smallest hashes are taken, so the sample is the same in each run. Repeated labels of an id
    are averaged and exact copies of a text count once, with the mean of their labels. Rows whose fold is 2, null ids,
    labels and texts take no part.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .where(fold(F.col("doc_id")) != 2)
             .groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # At most ``rows`` pairs of an id and a number: a proven bound for the broadcast.
    texts = (docs.select("doc_id", "text").where(F.col("text").isNotNull())
             .join(F.broadcast(known), "doc_id")
             .groupBy(F.sha2("text", 256).alias("same")).agg(F.first("text").alias("text"), F.avg("y").alias("y")))
    return staged(texts.select("same", "text", "y"), "labelled")

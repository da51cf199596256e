"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

All stages but the last keep or drop whole rows and return the columns of ``documents``; the last one returns the pieces
of what is left with their sequence and place. Null and empty texts are kept by every stage (they score as clean, have
no perplexity, links or hits) and are packed as empty documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from intactly.llm import decontaminate, jaccard, packing, quality, toxicity
from intactly.llm.common import staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.3 or more."""
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is above their language's threshold."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of linked documents."""
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]
#: The trained stages and the tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

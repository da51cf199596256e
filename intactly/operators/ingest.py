"""The ingestion job (M4): harmonise → validate once → cleaned zone + warehouse fact.

Validation runs once and is staged; the two writers read the staged rows,
never each other's output (B9). Rejected rows are kept with their reasons.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions.rules import Rule
from intactly.functions import fingerprint as fp
from intactly.operators import harmonise, validate, zone
from intactly.operators.ordered import staged


@dataclass(frozen=True)
class IngestPaths:
    zone: str          # cleaned, month-partitioned zone with commit rows
    rejects: str       # rejected rows with reasons
    fact: str          # warehouse fact table (Parquet stand-in for the JDBC sink)


def ingest(spark: SparkSession, months: Sequence[DataFrame], checks: Sequence[Rule],
           clean: Callable[[DataFrame], DataFrame], to_fact: Callable[[DataFrame], DataFrame],
           paths: IngestPaths, fingerprint_cols: list[str] | None = None, requested: DataFrame | None = None) -> None:
    """Harmonises the monthly inputs, validates once and writes both branches.

    ``clean`` projects accepted rows to the cleaned contract (it must keep a
    ``month`` column); ``to_fact`` maps cleaned rows to fact rows (also with
    ``month``). All three outputs are committed zones: a re-run of a month
    commits new batches and readers see only the latest one per month.
    With ``fingerprint_cols`` (columns common to the zone and the fact) the
    two branches' commit fingerprints are directly comparable. ``requested``
    (a ``month`` column) names the months the run stands for, also those that
    brought no rows this time; without it they are the months in the data.
    """
    merged = harmonise.harmonise(list(months))
    # Validated once, onto shared storage: both branches and the rejects read it from there.
    valid = staged(validate.with_reasons(merged, checks), "validated")
    # Every branch commits every month of this run, even where it wrote no
    # rows, so readers never mix this run with an older one.
    covered = valid.select("month").distinct()
    if requested is not None:
        covered = covered.unionAll(requested.select("month")).distinct()
    rows = clean(validate.accepted(valid))
    zone.write_batch(spark, rows, paths.zone, fingerprint_cols, months=covered)
    zone.write_batch(spark, to_fact(rows), paths.fact, fingerprint_cols, months=covered)
    zone.write_batch(spark, validate.rejected(valid), paths.rejects, months=covered)


def read_cleaned(spark: SparkSession, root: str, contract: str,
                 months: Sequence[str] | None = None) -> DataFrame:
    """Cleaned-zone reader bound to the declared contract schema.

    Columns are selected and cast to the contract, so exploration and
    training never depend on what a particular file happens to contain.
    """
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(contract)
    data = zone.read_committed(spark, root, list(months) if months is not None else None)
    return data.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def branch_totals(spark: SparkSession, root: str) -> DataFrame:
    """Rows and fingerprint of a committed zone from its latest commit rows (read-back stats)."""
    heads = zone.committed(spark, root)
    return heads.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
                     fp.added(F.col("fingerprint")).alias("fingerprint"))

"""Validate once: one projection adds the failing rule names; two filters branch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intactly.functions.rules import Rule

UNMAPPED = "unmapped"


def with_reasons(df: DataFrame, checks: Sequence[Rule], name: str = "reasons",
                 sep: str = ",") -> DataFrame:
    """Adds the failing rule names joined in rule order ('' when the row passes).

    ``concat_ws`` over ``CASE`` expressions skips the passing rules and stays
    inside whole-stage codegen (no lambda functions on the hot path).
    """
    failed = [F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(r.name)) for r in checks]
    return df.withColumn(name, F.concat_ws(sep, *failed))


def accepted(validated: DataFrame, name: str = "reasons") -> DataFrame:
    return validated.where(F.col(name) == "").drop(name)


def rejected(validated: DataFrame, name: str = "reasons") -> DataFrame:
    """Rejected rows are kept, with their reasons."""
    return validated.where(F.col(name) != "")


def violation_counts(df: DataFrame, checks: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """Violations per rule × group in a single aggregation pass (then unpivoted)."""
    wide = df.groupBy(*by).agg(*[F.count_if(~F.coalesce(r.ok, F.lit(False))).alias(r.name)
                                 for r in checks])
    stacked = ", ".join(f"'{r.name}', `{r.name}`" for r in checks)
    return wide.selectExpr(*by, f"stack({len(checks)}, {stacked}) AS (rule, violations)")


def decode(code: Column, dictionary: Mapping[str, str]) -> Column:
    """Code → label through a literal map; unknown codes keep the row as 'unmapped'.

    Dictionaries are fixed, tiny value lists, so the lookup is an inline map
    expression evaluated in whole-stage codegen rather than a join.
    """
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(dictionary.items())])
    return F.coalesce(F.element_at(lookup, code), F.lit(UNMAPPED))


def orphans(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str) -> DataFrame:
    """Fact rows whose key is missing from the lookup (anti join)."""
    return facts.join(lookup.select(F.col(lookup_key).alias(fact_key)), fact_key, "left_anti")

"""Validation rules that stand in a table: read as rows, compiled to one projection (C14).

A rule row has a name, a version, the column it checks, a kind and the
kind's arguments. Kinds: ``present`` (not null), ``range`` (low ≤ value ≤
high), ``above`` (value > low), ``not_before`` (value ≥ the column
``other``), ``pattern`` (the whole text matches ``codes[0]``) and ``domain``
(the value, as text, is one of ``codes``, or of the rule's rows in a table
of codes). A null fails every rule. A new rule, a changed bound or a longer
list is a new row and needs no code; reasons name the version that failed.

Short code lists go into the projection. Long ones are joined by a hash
lookup on distinct codes, which Spark broadcasts or shuffles by their size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intactly.functions.rules import Rule

RULE_SCHEMA = ("name string, version int, column string, kind string, low double, high double, other string, "
               "codes array<string>")
CODE_SCHEMA = "name string, code string"
#: Rules of one table, at most; codes written into the projection, at most (more are joined).
MOST_RULES, INLINE_CODES = 10_000, 64


def _condition(row, hit: Column | None) -> Column:
    c = F.col(row["column"])
    kind = row["kind"]
    if kind == "present":
        return c.isNotNull()
    if kind == "range":
        return c.between(F.lit(row["low"]), F.lit(row["high"]))
    if kind == "above":
        return c > F.lit(row["low"])
    if kind == "not_before":
        return c >= F.col(row["other"])
    if kind == "pattern":
        return F.regexp_like(c.cast("string"), F.lit(f"^(?:{row['codes'][0]})$"))
    if kind == "domain":
        return hit if hit is not None else c.cast("string").isin(*(row["codes"] or []))
    raise ValueError(f"rule {row['name']}: unknown kind {kind!r}")


@dataclass
class RuleSet:
    """The newest version of each rule; ``checks`` in the order of their names after ``applied`` made the lookups."""
    rows: list
    lookups: dict[str, DataFrame] = field(default_factory=dict)

    def applied(self, df: DataFrame) -> tuple[DataFrame, list[Rule]]:
        """``df`` with a hit column for each joined code list, and the rules over it, named ``name@version``."""
        checks = []
        for i, row in enumerate(self.rows):
            hit = None
            if row["name"] in self.lookups:
                codes = self.lookups[row["name"]].withColumnRenamed("code", f"_code{i}").withColumn(f"_hit{i}", F.lit(True))
                df = df.join(codes, F.col(row["column"]).cast("string") == F.col(f"_code{i}"), "left").drop(f"_code{i}")
                hit = F.col(f"_hit{i}").isNotNull()
            checks.append(Rule(f"{row['name']}@{row['version']}", _condition(row, hit)))
        return df, checks


def load(rules: DataFrame, codes: DataFrame | None = None, inline: int = INLINE_CODES) -> RuleSet:
    """Reads a rule table (``RULE_SCHEMA``) and, for long domains, a table of codes (``CODE_SCHEMA``).

    Of several versions of a rule the highest holds. Codes of both sources
    count. More than ``MOST_RULES`` rules are refused.
    """
    newest = rules.groupBy("name").agg(F.max_by(F.struct(*rules.columns), F.col("version")).alias("r")).select("r.*")
    rows = newest.orderBy("name").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    lookups = {}
    listed = {} if codes is None else {r["name"]: r["n"] for r in codes.join(
        F.broadcast(newest.where("kind = 'domain'").select("name")), "name").groupBy("name").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    for row in rows:
        own = row["codes"] or []
        if row["kind"] == "domain" and len(own) + listed.get(row["name"], 0) > inline or row["name"] in listed:
            mine = rules.sparkSession.createDataFrame([(c,) for c in own], "code string")
            if row["name"] in listed:
                mine = mine.unionAll(codes.where(F.col("name") == row["name"]).select("code"))
            lookups[row["name"]] = mine.where("code IS NOT NULL").distinct()
    return RuleSet(rows, lookups)

"""Schemas as data: a schema's JSON text as (path, position, type, nullable) rows, compared path by path.

The tree is walked by a recursive query over VARIANT nodes, one level of
nesting per step, on distinct schema texts only: a million files of three
schemas cost three trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the children of arrays and maps in a path.
ELEMENT, KEY, VALUE = "element", "key", "value"

_CHILDREN = f"""CASE try_variant_get(node, '$.type', 'string')
  WHEN 'struct' THEN transform(try_variant_get(node, '$.fields', 'array<variant>'), (f, i) -> named_struct(
      'step', try_variant_get(f, '$.name', 'string'), 'position', i, 'node', try_variant_get(f, '$.type', 'variant'),
      'nullable', try_variant_get(f, '$.nullable', 'boolean')))
  WHEN 'array' THEN array(named_struct('step', '{ELEMENT}', 'position', 0,
      'node', try_variant_get(node, '$.elementType', 'variant'),
      'nullable', try_variant_get(node, '$.containsNull', 'boolean')))
  WHEN 'map' THEN array(
      named_struct('step', '{KEY}', 'position', 0, 'node', try_variant_get(node, '$.keyType', 'variant'),
                   'nullable', false),
      named_struct('step', '{VALUE}', 'position', 1, 'node', try_variant_get(node, '$.valueType', 'variant'),
                   'nullable', try_variant_get(node, '$.valueContainsNull', 'boolean')))
  END"""

_WALK = f"""
WITH RECURSIVE tree(schema, path, position, node, nullable) AS (
  SELECT schema, '', 0, try_parse_json(schema), false FROM {{texts}}
  UNION ALL
  SELECT schema, IF(path = '', child.step, concat(path, '.', child.step)), child.position, child.node, child.nullable
  FROM (SELECT schema, path, explode({_CHILDREN}) AS child FROM tree))
SELECT schema, path, position,
       coalesce(try_variant_get(node, '$.type', 'string'), try_variant_get(node, '$', 'string')) AS type, nullable
FROM tree"""


def flattened(texts: DataFrame, text: str = "schema") -> DataFrame:
    """schema, path, position, type and nullable of every node of the distinct schema texts of a column.

    The root has the empty path. A position is the place among the siblings.
    Text that is no schema yields a root without a type.
    """
    distinct = texts.select(F.col(text).alias("schema")).where(F.col(text).isNotNull()).distinct()
    return texts.sparkSession.sql(_WALK, texts=distinct)


def same_schema(a: Column, b: Column) -> Column:
    """Whether two schema texts say the same, whatever their spacing and the order of their keys."""
    plain = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), c)
    return plain(a).eqNullSafe(plain(b))


def embedded(text: Column) -> Column:
    """Schema text as a VARIANT: written to JSON it is a nested object, not a quoted text (I16)."""
    return F.try_parse_json(text)


def differences(pairs: DataFrame, key: str, recorded: str = "recorded", observed: str = "observed") -> DataFrame:
    """key, path, change, recorded_type and observed_type of every path in which two schemas of a key differ.

    ``added`` and ``removed`` name the outermost path only. Pairs that say the
    same have no rows; a missing schema has no paths.
    """
    differ = (pairs.select(key, F.col(recorded).alias("_r"), F.col(observed).alias("_o"))
              .where(~same_schema(F.col("_r"), F.col("_o"))))
    texts = differ.select("_r", "_o").distinct()
    trees = flattened(texts.select(F.col("_r").alias("schema")).unionAll(texts.select("_o")))
    facts = ["position", "type", "nullable"]

    def side(column: str, tag: str) -> DataFrame:
        return (texts.join(trees.withColumnRenamed("schema", column), column)
                .select("_r", "_o", "path", F.struct(*facts).alias(tag)))

    both = side("_r", "r").join(side("_o", "o"), ["_r", "_o", "path"], "full_outer")
    change = (F.when(F.col("r").isNull(), F.lit("added")).when(F.col("o").isNull(), F.lit("removed"))
              .when(~F.col("r.type").eqNullSafe(F.col("o.type")), F.lit("retyped"))
              .when(~F.col("r.nullable").eqNullSafe(F.col("o.nullable")), F.lit("renullable"))
              .when(F.col("r.position") != F.col("o.position"), F.lit("moved")))
    changed = both.select("_r", "_o", "path", change.alias("change"), F.col("r.type").alias("recorded_type"),
                          F.col("o.type").alias("observed_type")).where("change IS NOT NULL")
    # What lies below an added, removed or retyped path says nothing more.
    whole = changed.where("change IN ('added', 'removed', 'retyped')").select(
        "_r", "_o", F.col("path").alias("_above"))
    below = F.col("path").startswith(F.concat("_above", F.lit("."))) | ((F.col("_above") == "") & (F.col("path") != ""))
    outer = changed.join(whole, (changed["_r"].eqNullSafe(whole["_r"])) & (changed["_o"].eqNullSafe(whole["_o"])) & below,
                         "left_anti")
    return (differ.join(outer, differ["_r"].eqNullSafe(outer["_r"]) & differ["_o"].eqNullSafe(outer["_o"]))
            .select(differ[key], "path", "change", "recorded_type", "observed_type"))

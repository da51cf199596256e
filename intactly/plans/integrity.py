"""Queries for the verify job (M1): decode, fingerprint, inventory, digests, footers, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions import fingerprint as fp
from intactly.functions import schema
from intactly.operators import integrity, profile
from intactly.sources import files as file_sources
from intactly.sources import lookup
from intactly.session import scratch_path
from intactly.sources.tables import TABLES, month_of, read_table


def q00_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection with a concatenated label and a typed null, written and read back."""
    li = read_table(spark, sf_dir, "lineitem")
    proj = li.selectExpr("l_orderkey AS id", "concat('value-', l_orderkey) AS label",
                         "CAST(NULL AS DOUBLE) AS missing")
    path = scratch_path(spark, "q00-roundtrip")
    proj.write.mode("errorifexists").parquet(path)
    back = spark.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"),
                    F.count("missing").alias("missing_values"),
                    F.count_distinct("label").alias("labels"))


def q01_decode_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and all-column fingerprint of lineitem per ship month.

    The fingerprint reads every column of every row, so nothing can be
    answered from footers or pruned columns; both aggregates are partial
    on the map side and shuffle one row per (task, month).
    """
    li = read_table(spark, sf_dir, "lineitem")
    # Money as exact decimals: their text is the same in every engine.
    li = li.withColumns({c: F.col(c).cast("decimal(18,2)") for c, kind in LINEITEM_COLS if kind == "dec"})
    return li.groupBy(month_of("l_shipdate").alias("month")).agg(*fp.fingerprint_aggs(li))


def q02_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-insensitive, duplicate-sensitive fingerprint of documents per source."""
    docs = read_table(spark, sf_dir, "documents")
    return fp.fingerprint(docs, by=["source"])


def q03_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (file_sources.inventory(spark, sf_dir, "*.parquet")
            .select("filename", F.col("length").alias("bytes")))


def q04_file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = file_sources.inventory(spark, sf_dir, "*.parquet")
    return (file_sources.file_digests(inv)
            .select(F.element_at(F.split("path", "/"), -1).alias("filename"),
                    "bytes", "sha256", "error"))


def q05_verified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded rows and status of every table's file, by the isolating path (K2, M1)."""
    checked = integrity.verify_files(file_sources.inventory(spark, sf_dir, "*.parquet"))
    return checked.select("filename", "decoded_rows", "status")


def q05_verify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = file_sources.inventory(spark, sf_dir, "*.parquet")
    return (integrity.verify_files(inv)
            .select("filename", "bytes", "row_groups", "footer_rows", "decoded_rows",
                    "status", "error"))


def q06_schema_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark schema of every table file as (path, position, type) rows."""
    checked = integrity.verify_files(file_sources.inventory(spark, sf_dir, "*.parquet")).select(
        "filename", "spark_schema")
    trees = schema.flattened(checked, "spark_schema")
    return (checked.join(trees, checked["spark_schema"] == trees["schema"]).where("path <> ''")
            .select("filename", "path", "position", "type"))


def q06_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = file_sources.inventory(spark, sf_dir, "*.parquet")
    return (file_sources.footers(inv)
            .select(F.element_at(F.split("path", "/"), -1).alias("filename"),
                    "row_group", "column", "physical_type", "rg_rows", "num_values"))


def q07_lookup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup profile after a round trip through the strict CSV lookup reader."""
    path = scratch_path(spark, "q07-lookup")
    lookup.write_lookup_csv(read_table(spark, sf_dir, "nation"), path)
    nation = lookup.read_lookup_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    return profile.lookup_profile(nation, "n_nationkey", "n_name")


def q08_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    return profile.column_profile(joined)


# The first months whose profiles q08_stored_profile stores later, and the error allowed for distinct counts.
LATER_MONTHS, DISTINCT_ERROR = "1997-01", 0.06


def q08_stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of lineitem from stored monthly sketches, the later months added without reading the earlier ones.

    Distinct counts are estimates: the row says whether they are within the
    sketch's error bound of the exact ones.
    """
    li = read_table(spark, sf_dir, "lineitem").withColumn("month", F.coalesce(month_of("l_shipdate"), F.lit("none")))
    path = scratch_path(spark, "q08-profiles")
    later = F.col("month") >= LATER_MONTHS
    profile.store_profiles(li.where(~later), "month", path)
    profile.store_profiles(li.where(later), "month", path)
    merged = profile.merged_profile(profile.read_profiles(spark, path, "month"))
    exact = profile.column_profile(li.drop("month")).select("column_name", "distinct_values")
    near = F.abs(F.col("distinct") - F.col("distinct_values")) <= DISTINCT_ERROR * F.col("distinct_values")
    return merged.join(exact, "column_name").select("column_name", "groups", "rows", "nulls", "blanks",
                                                    near.alias("distinct_within_bound"))


def q09_decode_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table fully decoded through the noop sink, rows counted by ``observe``.

    Nothing is pruned and no footer count is used: each job materialises
    every column of every row; only the per-table totals reach the driver.
    """
    counts = [(name, integrity.decoded_row_count(read_table(spark, sf_dir, name)))
              for name in TABLES]
    return spark.createDataFrame(counts, "table_name string, decoded_rows bigint")


QUERIES = {
    "q00_smoke": q00_smoke,
    "q01_decode_rowcount": q01_decode_rowcount,
    "q02_fingerprint": q02_fingerprint,
    "q03_inventory": q03_inventory,
    "q04_file_digest": q04_file_digest,
    "q05_verify_files": q05_verify_files,
    "q05_verified_counts": q05_verified_counts,
    "q06_footers": q06_footers,
    "q06_schema_paths": q06_schema_paths,
    "q07_lookup_profile": q07_lookup_profile,
    "q08_null_profile": q08_null_profile,
    "q08_stored_profile": q08_stored_profile,
    "q09_decode_tables": q09_decode_tables,
}

# Oracle SQL helpers: the canonical row text of fingerprint.py, in DuckDB.
def _canon(expr: str, kind: str) -> str:
    text = {"dec": f"CAST(CAST({expr} AS DECIMAL(18,2)) AS VARCHAR)", "ts": f"CAST(epoch_us({expr}) AS VARCHAR)"}.get(
        kind, f"CAST({expr} AS VARCHAR)")
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, 'N')"


def canon_row_sql(cols: list[tuple[str, str]]) -> str:
    return " || ".join(_canon(c, k) for c, k in cols)


def fingerprint_sql(text: str) -> str:
    """Sums of the first four 32-bit words of the digest, joined by a dash."""
    words = [f"coalesce(sum(CAST('0x' || substr(sha256({text}), {1 + 8 * k}, 8) AS BIGINT)), 0)" for k in range(4)]
    return " || '-' || ".join(f"CAST({w} AS VARCHAR)" for w in words)


LINEITEM_COLS = [
    ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
    ("l_quantity", "dec"), ("l_extendedprice", "dec"), ("l_discount", "dec"),
    ("l_tax", "dec"), ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "ts"),
]
DOCUMENT_COLS = [("doc_id", "int"), ("text", "str"), ("lang", "str"), ("source", "str"),
                 ("n_chars", "int")]

SQL = {
    "q00_smoke": """
        SELECT count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS id_sum,
               count(CAST(NULL AS DOUBLE)) AS missing_values,
               count(DISTINCT 'value-' || l_orderkey) AS labels
        FROM lineitem""",
    "q01_decode_rowcount": f"""
        SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS rows,
               {fingerprint_sql(canon_row_sql(LINEITEM_COLS))} AS fingerprint
        FROM lineitem GROUP BY 1""",
    "q02_fingerprint": f"""
        SELECT source, count(*) AS rows,
               {fingerprint_sql(canon_row_sql(DOCUMENT_COLS))} AS fingerprint
        FROM documents GROUP BY 1""",
    "q07_lookup_profile": """
        SELECT count(*) AS rows, count(DISTINCT n_nationkey) AS distinct_keys,
               count(*) FILTER (WHERE n_nationkey IS NULL) AS null_keys,
               count(*) FILTER (WHERE n_name IS NULL OR trim(n_name) = '') AS blank_names,
               CAST(min(n_nationkey) AS BIGINT) AS min_key, CAST(max(n_nationkey) AS BIGINT) AS max_key,
               count(DISTINCT n_nationkey) <> count(n_nationkey) AS has_duplicates
        FROM nation""",
}

_Q08_COLS = [("doc_id", False), ("text", True), ("lang", True), ("source", True),
             ("n_chars", False), ("quality", False), ("toxic", False)]
SQL["q08_null_profile"] = "WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))\n" + \
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        + (f"count(*) FILTER (WHERE trim({c}) = '')" if text else "CAST(0 AS BIGINT)")
        + f" AS blanks, count(DISTINCT {c}) AS distinct_values FROM j"
        for c, text in _Q08_COLS)

SQL["q09_decode_tables"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS decoded_rows FROM {t}" for t in TABLES)

SQL["q05_verified_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}.parquet' AS filename, count(*) AS decoded_rows, 'verified' AS status FROM {t}" for t in TABLES)

# Spark's names of DuckDB's column types; lists are an array and its element.
_TYPES = {"BIGINT": "long", "INTEGER": "integer", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
          "DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "BOOLEAN": "boolean"}
_TYPE_SQL = "CASE replace(data_type, '[]', '') " + " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in _TYPES.items()) + " END"
_NAMES = ", ".join(f"'{t}'" for t in TABLES)
SQL["q06_schema_paths"] = f"""
WITH c AS (SELECT table_name || '.parquet' AS filename, column_name AS path, ordinal_position - 1 AS position,
                  data_type, {_TYPE_SQL} AS type FROM information_schema.columns WHERE table_name IN ({_NAMES}))
SELECT filename, path, CAST(position AS INTEGER) AS position,
       CASE WHEN data_type LIKE '%[]' THEN 'array' ELSE type END AS type FROM c
UNION ALL SELECT filename, path || '.element', 0, type FROM c WHERE data_type LIKE '%[]'"""

_LINE_COLUMNS = [(c, k == "str") for c, k in LINEITEM_COLS]
SQL["q08_stored_profile"] = "WITH l AS (SELECT *, coalesce(strftime(l_shipdate, '%Y-%m'), 'none') AS month FROM lineitem)\n" + \
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT month) AS groups, count(*) AS rows, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        + (f"count(*) FILTER (WHERE trim({c}) = '')" if text else "CAST(0 AS BIGINT)")
        + " AS blanks, true AS distinct_within_bound FROM l" for c, text in _LINE_COLUMNS)

"""Queries for ingestion (M4): harmonise, validate once, decode, zone writes — q30–q38.

The trip role is played by lineitem ⋈ orders; the month of a trip is its
ship month. Validation rules are ours (the specification leaves them open).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions.rules import Rule
from intactly.operators import harmonise, ruletable, validate, zone
from intactly.operators import ingest as ingest_job
from intactly.session import scratch_path
from intactly.sources.tables import month_of, read_months, read_table, trips

# Code dictionaries (order status P is deliberately unmapped).
RETURN_FLAGS = {"A": "accepted", "N": "none", "R": "returned"}
LINE_STATUSES = {"O": "open", "F": "fulfilled"}
ORDER_STATUSES = {"F": "final", "O": "open"}

# The month split of q30/q31 and the month re-run by q37.
SPLIT_AT = "1998-01-01 00:00:00"
RERUN_MONTH = "1996-01"
SCANNED_MONTHS = ("1995-03", "1996-01")


def trip_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("quantity_range", c("l_quantity").between(1, 50)),
        Rule("discount_range", c("l_discount").between(0, 0.1)),
        Rule("tax_range", c("l_tax").between(0, 0.08)),
        Rule("returnflag_domain", c("l_returnflag").isin(*RETURN_FLAGS)),
        Rule("linestatus_domain", c("l_linestatus").isin(*LINE_STATUSES)),
        Rule("order_present", c("o_orderkey").isNotNull()),
        Rule("ship_after_order", c("l_shipdate") >= c("o_orderdate")),
        Rule("price_positive", c("l_extendedprice") > 0),
    ]


def revenue() -> F.Column:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    discount = F.col("l_discount").cast("decimal(18,2)")
    return (price * (F.lit(1) - discount)).cast("decimal(18,4)")


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.with_reasons(trips(spark, sf_dir), trip_rules())


def cleaned(valid: DataFrame) -> DataFrame:
    return validate.accepted(valid).select("l_orderkey", "l_linenumber", "month",
                                           revenue().alias("revenue"))


def _months(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = read_table(spark, sf_dir, "lineitem").withColumn("month", month_of("l_shipdate"))
    split = F.col("l_shipdate") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    early = li.where(split).select("l_orderkey", "l_linenumber", "l_quantity",
                                   F.col("l_tax").alias("L_TAX"), "month")
    late = li.where(~F.coalesce(split, F.lit(False))).select("l_orderkey", F.col("l_linenumber").cast("bigint"),
                                   "l_quantity", "l_tax", "month",
                                   F.col("l_linestatus").alias("request_source"))
    return early, late


def q30_harmonised_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _months(spark, sf_dir)
    union = harmonise.harmonise([early, late])
    return union.groupBy("month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("request_source").alias("with_request_source"),
        F.sum(F.col("l_tax").cast("decimal(18,2)")).cast("decimal(38,2)").alias("tax_total"))


def q31_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _months(spark, sf_dir)
    return harmonise.schema_drift(spark, early, late)


def q32_dictionary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trips(spark, sf_dir)
    return (t.select(validate.decode(F.col("l_returnflag"), RETURN_FLAGS).alias("returnflag_label"),
                     validate.decode(F.col("l_linestatus"), LINE_STATUSES).alias("linestatus_label"),
                     validate.decode(F.col("o_orderstatus"), ORDER_STATUSES).alias("orderstatus_label"))
            .groupBy("returnflag_label", "linestatus_label", "orderstatus_label")
            .agg(F.count(F.lit(1)).alias("rows")))


def q33_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.violation_counts(trips(spark, sf_dir), trip_rules(), ["month"])


# The rules of q33 as rows; one rule has an older version that no longer holds.
RULE_ROWS = [
    ("quantity_range", 1, "l_quantity", "range", 1.0, 50.0, None, None),
    ("discount_range", 1, "l_discount", "range", 0.0, 0.05, None, None),
    ("discount_range", 2, "l_discount", "range", 0.0, 0.1, None, None),
    ("tax_range", 1, "l_tax", "range", 0.0, 0.08, None, None),
    ("returnflag_domain", 1, "l_returnflag", "domain", None, None, None, list(RETURN_FLAGS)),
    ("linestatus_domain", 1, "l_linestatus", "domain", None, None, None, list(LINE_STATUSES)),
    ("order_present", 1, "o_orderkey", "present", None, None, None, None),
    ("ship_after_order", 1, "l_shipdate", "not_before", None, None, "o_orderdate", None),
    ("price_positive", 1, "l_extendedprice", "above", 0.0, None, None, None),
    ("supplier_known", 3, "l_suppkey", "domain", None, None, None, None),
]


def q33_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per rule and month, from stored rules and a stored list of the suppliers in credit (C14)."""
    path = scratch_path(spark, "q33-rules")
    spark.createDataFrame(RULE_ROWS, ruletable.RULE_SCHEMA).write.parquet(f"{path}/rules")
    (read_table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
     .select(F.lit("supplier_known").alias("name"), F.col("s_suppkey").cast("string").alias("code"))
     .write.parquet(f"{path}/codes"))
    rules = ruletable.load(spark.read.parquet(f"{path}/rules"), spark.read.parquet(f"{path}/codes"))
    rows, checks = rules.applied(trips(spark, sf_dir))
    return validate.violation_counts(rows, checks, ["month"])


def q34_clean_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(validated(spark, sf_dir))


def q35_clean_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (validate.rejected(validated(spark, sf_dir))
            .select("l_orderkey", "l_linenumber", "month", "reasons"))


def q36_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    active = read_table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    return (validate.orphans(li, active, "l_suppkey", "s_suppkey")
            .groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("orphan_rows")))


def q37_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "q37-zone")
    rows = cleaned(validated(spark, sf_dir))
    zone.write_batch(spark, rows, root)
    zone.write_batch(spark, rows.where(F.col("month") == RERUN_MONTH), root)
    return zone.read_committed(spark, root).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


def q38_branch_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate once, write the cleaned zone and the warehouse fact, compare them read back."""
    early, late = _trip_months(spark, sf_dir)
    paths = ingest_job.IngestPaths(zone=scratch_path(spark, "q38-zone"),
                                   rejects=scratch_path(spark, "q38-rejects"),
                                   fact=scratch_path(spark, "q38-fact"))
    fact = lambda rows: rows.select(
        "l_orderkey", "l_linenumber", "revenue", "month",
        F.date_format(F.to_date(F.concat("month", F.lit("-01"))), "yyyyMM").cast("int").alias("month_key"))
    cols = ["l_orderkey", "l_linenumber", "revenue"]
    ingest_job.ingest(spark, [early, late], trip_rules(), _clean_rows, fact, paths, cols)
    # Each branch's commit rows hold counts and fingerprints of what it wrote, read back.
    a = ingest_job.branch_totals(spark, paths.zone).withColumn("branch", F.lit("cleaned_zone"))
    b = ingest_job.branch_totals(spark, paths.fact).withColumn("branch", F.lit("warehouse"))
    return a.unionByName(b).select("branch", "rows", "fingerprint")


def _clean_rows(accepted: DataFrame) -> DataFrame:
    return accepted.select("l_orderkey", "l_linenumber", "month", revenue().alias("revenue"))


def _trip_months(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trips as two monthly deliveries (before and after the split date)."""
    t = trips(spark, sf_dir)
    split = F.col("l_shipdate") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    return t.where(split), t.where(~F.coalesce(split, F.lit(False)))


def q39_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of chosen months from a month-partitioned zone; other months' folders are not opened (A10)."""
    root = scratch_path(spark, "q39-months")
    zone.write_months(cleaned(validated(spark, sf_dir)), root)
    return (read_months(spark, root, SCANNED_MONTHS).groupBy("month")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("revenue").cast("decimal(38,4)").alias("revenue")))


def q39_cleaned_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed zone read back through its contract, for chosen months."""
    root = scratch_path(spark, "q39-zone")
    zone.write_batch(spark, cleaned(validated(spark, sf_dir)), root)
    return ingest_job.read_cleaned(spark, root, "month string, l_orderkey bigint, l_linenumber bigint", SCANNED_MONTHS)


QUERIES = {
    "q30_harmonised_union": q30_harmonised_union,
    "q31_schema_drift": q31_schema_drift,
    "q32_dictionary_decode": q32_dictionary_decode,
    "q33_domain_violations": q33_domain_violations,
    "q33_rule_table": q33_rule_table,
    "q34_clean_accepted": q34_clean_accepted,
    "q35_clean_rejected": q35_clean_rejected,
    "q36_orphans": q36_orphans,
    "q37_rerun_idempotent": q37_rerun_idempotent,
    "q38_branch_parity": q38_branch_parity,
    "q39_month_scan": q39_month_scan,
    "q39_cleaned_reader": q39_cleaned_reader,
}

TRIPS_SQL = "(SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"

RULES_SQL = [
    ("quantity_range", "l_quantity BETWEEN 1 AND 50"),
    ("discount_range", "l_discount BETWEEN 0 AND 0.1"),
    ("tax_range", "l_tax BETWEEN 0 AND 0.08"),
    ("returnflag_domain", "l_returnflag IN ('A', 'N', 'R')"),
    ("linestatus_domain", "l_linestatus IN ('O', 'F')"),
    ("order_present", "o_orderkey IS NOT NULL"),
    ("ship_after_order", "l_shipdate >= o_orderdate"),
    ("price_positive", "l_extendedprice > 0"),
]
_FAILED = " OR ".join(f"NOT coalesce({cond}, false)" for _, cond in RULES_SQL)
REVENUE_SQL = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) "
               "AS DECIMAL(18,4))")
ACCEPTED_SQL = (f"(SELECT l_orderkey, l_linenumber, month, {REVENUE_SQL} AS revenue FROM {TRIPS_SQL} t "
                f"WHERE NOT ({_FAILED}))")

_MONTHS_SQL = """
WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity, l_tax AS "L_TAX", strftime(l_shipdate, '%Y-%m') AS month
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'),
b AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_tax,
             strftime(l_shipdate, '%Y-%m') AS month, l_linestatus AS request_source
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00')"""

_TYPE_SQL = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END")

SQL = {
    "q30_harmonised_union": _MONTHS_SQL + """,
u AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)
SELECT month, count(*) AS rows, count(request_source) AS with_request_source,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS tax_total
FROM u GROUP BY month""",
    "q31_schema_drift": _MONTHS_SQL + f""",
cols AS (SELECT column_name AS name, {_TYPE_SQL} AS data_type FROM information_schema.columns
         WHERE table_name = 'lineitem'),
lc AS (SELECT 'l_orderkey' AS name, count(l_orderkey) AS n FROM a UNION ALL SELECT 'l_linenumber', count(l_linenumber) FROM a
       UNION ALL SELECT 'l_quantity', count(l_quantity) FROM a UNION ALL SELECT 'L_TAX', count("L_TAX") FROM a
       UNION ALL SELECT 'month', count(month) FROM a),
rc AS (SELECT 'l_orderkey' AS name, count(l_orderkey) AS n FROM b UNION ALL SELECT 'l_linenumber', count(l_linenumber) FROM b
       UNION ALL SELECT 'l_quantity', count(l_quantity) FROM b UNION ALL SELECT 'l_tax', count(l_tax) FROM b
       UNION ALL SELECT 'month', count(month) FROM b UNION ALL SELECT 'request_source', count(request_source) FROM b),
l AS (SELECT CASE WHEN name = 'l_tax' THEN 'L_TAX' ELSE name END AS name, data_type FROM cols
      WHERE name IN ('l_orderkey', 'l_linenumber', 'l_quantity', 'l_tax')
      UNION ALL SELECT 'month', 'string'),
r AS (SELECT name, CASE WHEN name = 'l_linenumber' THEN 'bigint' ELSE data_type END AS data_type FROM cols
      WHERE name IN ('l_orderkey', 'l_linenumber', 'l_quantity', 'l_tax')
      UNION ALL SELECT 'month', 'string'
      UNION ALL SELECT 'request_source', data_type FROM cols WHERE name = 'l_linestatus')
SELECT coalesce(lower(l.name), lower(r.name)) AS column_name, l.name AS left_name, l.data_type AS left_type,
       lc.n AS left_values, r.name AS right_name, r.data_type AS right_type, rc.n AS right_values,
       CASE WHEN l.name IS NULL THEN 'only_right' WHEN r.name IS NULL THEN 'only_left'
            WHEN l.data_type <> r.data_type THEN 'type_changed' WHEN l.name <> r.name THEN 'case_changed'
            ELSE 'same' END AS change
FROM (l LEFT JOIN lc ON lc.name = l.name) FULL OUTER JOIN (r LEFT JOIN rc ON rc.name = r.name)
  ON lower(l.name) = lower(r.name)""",
    "q32_dictionary_decode": f"""
SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' ELSE 'unmapped' END AS returnflag_label,
       CASE l_linestatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'fulfilled' ELSE 'unmapped' END AS linestatus_label,
       CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'unmapped' END AS orderstatus_label,
       count(*) AS rows
FROM {TRIPS_SQL} t GROUP BY ALL""",
    "q33_domain_violations": f"""
WITH t AS {TRIPS_SQL}
{" UNION ALL ".join(f"SELECT month, '{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS violations FROM t GROUP BY month" for n, c in RULES_SQL)}""",
    "q34_clean_accepted": f"SELECT * FROM {ACCEPTED_SQL}",
    "q35_clean_rejected": f"""
SELECT l_orderkey, l_linenumber, month,
       concat_ws(',', {", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in RULES_SQL)}) AS reasons
FROM {TRIPS_SQL} t WHERE {_FAILED}""",
    "q36_orphans": """
SELECT l_suppkey, count(*) AS orphan_rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY l_suppkey""",
    "q37_rerun_idempotent": f"SELECT month, count(*) AS rows FROM {ACCEPTED_SQL} GROUP BY month",
}


def _fp_sql() -> str:
    from intactly.plans.integrity import canon_row_sql, fingerprint_sql
    text = canon_row_sql([("l_orderkey", "int"), ("l_linenumber", "int"), ("revenue", "text")])
    return f"count(*) AS rows, {fingerprint_sql(text)} AS fingerprint"


SQL["q38_branch_parity"] = (f"SELECT 'cleaned_zone' AS branch, {_fp_sql()} FROM {ACCEPTED_SQL} "
                            f"UNION ALL SELECT 'warehouse', {_fp_sql()} FROM {ACCEPTED_SQL}")

SQL["q39_month_scan"] = f"""
SELECT month, count(*) AS rows, CAST(sum(revenue) AS DECIMAL(38,4)) AS revenue FROM {ACCEPTED_SQL}
WHERE month IN {SCANNED_MONTHS} GROUP BY month"""
SQL["q39_cleaned_reader"] = f"""
SELECT month, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
FROM {ACCEPTED_SQL} WHERE month IN {SCANNED_MONTHS}"""

SQL["q33_rule_table"] = f"""
WITH t AS {TRIPS_SQL}
{" UNION ALL ".join(f"SELECT month, '{n}@{2 if n == 'discount_range' else 1}' AS rule, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS violations FROM t GROUP BY month" for n, c in RULES_SQL)}
UNION ALL SELECT month, 'supplier_known@3', count(*) FILTER (WHERE l_suppkey IS NULL OR l_suppkey NOT IN
  (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)) FROM t GROUP BY month"""

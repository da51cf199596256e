"""Model queries (M6): q60 mean baseline, q61 least squares, q62 MLlib models, q63 batch scoring.

Target: the line's extended price; features known before pricing: quantity,
discount, tax, return flag. Split by order key (80 / 20).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intactly.functions.rules import Rule
from intactly.operators import asof, model
from intactly.session import scratch_path
from intactly.sources.tables import read_table

NUMERIC = ["l_quantity", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag"]
LABEL = "l_extendedprice"


def _data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.split(read_table(spark, sf_dir, "lineitem"), "l_orderkey")


def q60_mean_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.baseline_rmse(_data(spark, sf_dir), F.col(LABEL).cast("decimal(18,2)"))


def q61_ols_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.baseline_rmse(_data(spark, sf_dir), F.col(LABEL).cast("decimal(18,2)"),
                               F.col("l_quantity").cast("decimal(18,2)"))


def q62_model_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits, saves, reloads and evaluates each model; one row per model."""
    from pyspark.ml import PipelineModel
    data = _data(spark, sf_dir)
    train, test = data.where("is_train"), data.where("NOT is_train")
    rows = []
    for kind in ("linear", "gbt"):
        path = scratch_path(spark, f"q62-{kind}")
        model.fit_save(model.pipeline(NUMERIC, CATEGORICAL, LABEL, kind), train, path)
        loaded = PipelineModel.load(path)
        rows.append((kind, float(model.rmse(loaded, test, LABEL))))
    return spark.createDataFrame(rows, "model string, rmse double")


def input_checks() -> list[Rule]:
    c = F.col
    return [Rule("quantity_present", c("l_quantity").isNotNull() & (c("l_quantity") > 0)),
            Rule("discount_range", c("l_discount").between(0, 1)),
            Rule("tax_range", c("l_tax").between(0, 1))]


def q63_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _data(spark, sf_dir)
    path = scratch_path(spark, "q63-linear")
    model.fit_save(model.pipeline(NUMERIC, CATEGORICAL, LABEL, "linear"), data.where("is_train"), path)
    return model.score(path, data, input_checks(), ["l_orderkey", "l_linenumber"])


def q64_asof_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's newest other event that is not later than it (L1)."""
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    bought = events.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    others = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("ts").alias("seen_at"), F.col("event_id").alias("seen_event"), F.col("value").alias("seen_value"))
    return asof.as_of(bought, others, "user_id", "ts", "seen_at", ["seen_event", "seen_value"], tie=["seen_event"]).select(
        "event_id", "seen_event", "seen_value")


QUERIES = {
    "q64_asof_features": q64_asof_features,
    "q60_mean_rmse": q60_mean_rmse,
    "q61_ols_rmse": q61_ols_rmse,
    "q62_model_rmse": q62_model_rmse,
    "q63_score": q63_score,
}

_Y = "CAST(l_extendedprice AS DECIMAL(18,2))"
_X = "CAST(l_quantity AS DECIMAL(18,2))"
_TR = "l_orderkey % 10 < 8"


def _s(expr: str, cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN {expr} END) AS DOUBLE)"


SQL = {
    "q60_mean_rmse": f"""
WITH s AS (SELECT CAST(count(*) FILTER (WHERE {_TR}) AS DOUBLE) AS n, {_s(_Y, _TR)} AS sy,
                  CAST(count(*) FILTER (WHERE NOT ({_TR})) AS DOUBLE) AS tn, {_s(_Y, f"NOT ({_TR})")} AS tsy,
                  {_s(f"{_Y} * {_Y}", f"NOT ({_TR})")} AS tsyy,
                  count(*) FILTER (WHERE {_TR}) AS train_rows, count(*) FILTER (WHERE NOT ({_TR})) AS test_rows
           FROM lineitem),
m AS (SELECT *, sy / n AS mean FROM s)
SELECT CAST(sqrt((tsyy - 2.0 * mean * tsy + tn * mean * mean) / tn) AS DECIMAL(18,6)) AS rmse,
       CAST(mean AS DECIMAL(18,6)) AS mean, train_rows, test_rows FROM m""",
    "q61_ols_rmse": f"""
WITH s AS (SELECT CAST(count(*) FILTER (WHERE {_TR}) AS DOUBLE) AS n, {_s(_X, _TR)} AS sx, {_s(_Y, _TR)} AS sy,
                  {_s(f"{_X} * {_Y}", _TR)} AS sxy, {_s(f"{_X} * {_X}", _TR)} AS sxx,
                  CAST(count(*) FILTER (WHERE NOT ({_TR})) AS DOUBLE) AS tn,
                  {_s(_Y, f"NOT ({_TR})")} AS tsy, {_s(f"{_Y} * {_Y}", f"NOT ({_TR})")} AS tsyy,
                  {_s(_X, f"NOT ({_TR})")} AS tsx, {_s(f"{_X} * {_X}", f"NOT ({_TR})")} AS tsxx,
                  {_s(f"{_X} * {_Y}", f"NOT ({_TR})")} AS tsxy,
                  count(*) FILTER (WHERE {_TR}) AS train_rows, count(*) FILTER (WHERE NOT ({_TR})) AS test_rows
           FROM lineitem),
b AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM s),
a AS (SELECT *, (sy - slope * sx) / n AS intercept FROM b)
SELECT CAST(sqrt((tsyy - 2.0 * intercept * tsy - 2.0 * slope * tsxy + tn * intercept * intercept
                  + 2.0 * intercept * slope * tsx + slope * slope * tsxx) / tn) AS DECIMAL(18,6)) AS rmse,
       CAST(slope AS DECIMAL(18,6)) AS slope, CAST(intercept AS DECIMAL(18,6)) AS intercept,
       train_rows, test_rows FROM a""",
}

SQL["q64_asof_features"] = """
SELECT event_id, seen_event, value AS seen_value FROM (
  SELECT event_id, event_type,
         last_value(CASE WHEN event_type <> 'purchase' THEN event_id END IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY ts, event_type = 'purchase', event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen_event FROM events) w
LEFT JOIN (SELECT event_id AS seen_event, value FROM events) v USING (seen_event) WHERE event_type = 'purchase'"""

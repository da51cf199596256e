"""Fare-style price model: split, baselines, MLlib pipelines, saved artifact, scoring (M6).

Baselines are computed in a single aggregation pass over exact decimal sums
(n, Σx, Σy, Σxy, Σx², Σy² for train and test), then combined in double
precision; no cross join and no second scan is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intactly.functions.rules import Rule

# Deterministic split — key mod 10 below 8 trains (80 %).
SPLIT_MOD = 10
TRAIN_BELOW = 8
# Rows that one task of boosted trees keeps in memory (about 300 bytes each).
TRAIN_ROWS = 500_000


def split(df: DataFrame, key: str) -> DataFrame:
    """Adds ``is_train`` from the key, so the split is stable across runs and engines."""
    return df.withColumn("is_train", F.pmod(F.col(key), F.lit(SPLIT_MOD)) < TRAIN_BELOW)


def _sums(y: Column, x: Column | None, flag: Column, tag: str) -> list[Column]:
    def s(e: Column, name: str) -> Column:
        return F.sum(F.when(flag, e)).alias(f"{tag}_{name}")
    out = [F.count_if(flag).alias(f"{tag}_n"), s(y, "sy"), s(y * y, "syy")]
    if x is not None:
        out += [s(x, "sx"), s(x * x, "sxx"), s(x * y, "sxy")]
    return out


def baseline_rmse(df: DataFrame, y: Column, x: Column | None = None) -> DataFrame:
    """Test RMSE of the train mean (x None) or of train least squares y = a + b·x.

    ``y`` and ``x`` should be decimals so that the sums are exact.
    """
    train, test = F.col("is_train"), ~F.col("is_train")
    sums = df.agg(*_sums(y, x, train, "tr"), *_sums(y, x, test, "te"))
    d = {c: F.col(c).cast("double") for c in sums.columns}
    if x is None:
        m = d["tr_sy"] / d["tr_n"]
        sse = d["te_syy"] - F.lit(2.0) * m * d["te_sy"] + d["te_n"] * m * m
        return sums.select(F.sqrt(sse / d["te_n"]).cast("decimal(18,6)").alias("rmse"),
                           m.cast("decimal(18,6)").alias("mean"),
                           F.col("tr_n").alias("train_rows"), F.col("te_n").alias("test_rows"))
    n, sx, sy, sxy, sxx = d["tr_n"], d["tr_sx"], d["tr_sy"], d["tr_sxy"], d["tr_sxx"]
    b = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    a = (sy - b * sx) / n
    sse = (d["te_syy"] - F.lit(2.0) * a * d["te_sy"] - F.lit(2.0) * b * d["te_sxy"]
           + d["te_n"] * a * a + F.lit(2.0) * a * b * d["te_sx"] + b * b * d["te_sxx"])
    return sums.select(F.sqrt(sse / d["te_n"]).cast("decimal(18,6)").alias("rmse"),
                       b.cast("decimal(18,6)").alias("slope"), a.cast("decimal(18,6)").alias("intercept"),
                       F.col("tr_n").alias("train_rows"), F.col("te_n").alias("test_rows"))


def pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str, kind: str) -> Pipeline:
    """Feature pipeline + regressor ('linear' or 'gbt') (L1, L4).

    A row with a null or NaN feature raises: no row leaves training or evaluation unseen.
    """
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical],
                        outputCols=[f"{c}_vec" for c in categorical], handleInvalid="keep")
    vec = VectorAssembler(inputCols=[*numeric, *[f"{c}_vec" for c in categorical]],
                          outputCol="features", handleInvalid="error")
    if kind == "linear":
        reg = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)
    elif kind == "gbt":
        reg = GBTRegressor(featuresCol="features", labelCol=label, maxIter=10, maxDepth=4, seed=42)
    else:
        raise ValueError(kind)
    return Pipeline(stages=[*idx, ohe, vec, reg])


def spread(df: DataFrame) -> DataFrame:
    """``df`` in partitions of about ``TRAIN_ROWS`` rows at most, dealt out anew if one of its own holds more than that."""
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return df.repartition(-(-sum(rows) // TRAIN_ROWS)) if max(rows, default=0) > TRAIN_ROWS else df


def fit_save(pipe: Pipeline, train: DataFrame, path: str) -> PipelineModel:
    """Fits all stages and saves the model.

    Boosted trees keep their binned rows in memory, in the partitions they come
    in, and read them in every round. Those would grow with the size of the
    scan's splits, so they are dealt out first; no other stage keeps rows.
    """
    *stages, last = pipe.getStages()
    if isinstance(last, GBTRegressor):
        features = Pipeline(stages=stages).fit(train)
        model = PipelineModel(stages=[*features.stages, last.fit(features.transform(spread(train)))])
    else:
        model = pipe.fit(train)
    model.write().overwrite().save(path)
    return model


def rmse(model: PipelineModel, test: DataFrame, label: str) -> float:
    pred = model.transform(test)
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(pred)


def score(path: str, df: DataFrame, checks: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Loads the saved artifact and scores every row that passes the input checks.

    Rows that fail a check are returned too, with a null prediction and the
    names of the failed checks, so nothing is dropped on the way.
    """
    model = PipelineModel.load(path)
    checked = df.withColumn("input_issues", F.concat_ws(",", *[
        F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(r.name)) for r in checks]))
    good = checked.where(F.col("input_issues") == "")
    scored = model.transform(good).select(*keep, F.col("prediction").cast("double"), "input_issues")
    refused = checked.where(F.col("input_issues") != "").select(
        *keep, F.lit(None).cast("double").alias("prediction"), "input_issues")
    return scored.unionByName(refused)

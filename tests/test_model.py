"""How training rows are dealt to the tasks of the price models."""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from intactly.operators import model


def _rows(spark, n, partitions):
    return spark.range(0, n, 1, partitions).select(
        (F.col("id") % 50).cast("double").alias("q"), F.when(F.col("id") % 7 > 0, F.lit("N")).alias("flag"),
        (F.col("id") % 50 * 3 + F.col("id") % 7).cast("double").alias("y"), F.lit("not read").alias("other"))


def test_boosted_trees_keep_few_rows_in_a_task(spark, workdir, monkeypatch):
    seen, fit = [], GBTRegressor._fit

    def watched(self, dataset):
        seen.append([r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, dataset)
    monkeypatch.setattr(GBTRegressor, "_fit", watched)
    monkeypatch.setattr(model, "TRAIN_ROWS", 300, raising=False)
    for n, partitions in ((2000, 1), (500, 4)):
        path = os.path.join(workdir, f"gbt{n}")
        train = _rows(spark, n, partitions)
        fitted = model.fit_save(model.pipeline(["q"], ["flag"], "y", "gbt"), train, path)
        # Every row arrives; what fits is left in the partitions it has.
        assert sum(seen[-1]) == n and max(seen[-1]) <= 330
        assert (len(seen[-1]) == partitions) == (n == 500)
        assert fitted.stages[0].labels == ["N"]
        loaded = PipelineModel.load(path)
        assert [type(s) for s in loaded.stages] == [type(s) for s in fitted.stages]
        assert model.rmse(loaded, train, "y") == model.rmse(fitted, train, "y") < 10
    model.fit_save(model.pipeline(["q"], ["flag"], "y", "linear"), _rows(spark, 2000, 1), os.path.join(workdir, "linear"))
    assert len(seen) == 2
    assert model.spread(_rows(spark, 0, 1)).count() == 0

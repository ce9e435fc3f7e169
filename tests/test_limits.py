"""Sizes at which plans or patterns could change their behaviour."""

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from fieldtally.operators import boosting
from fieldtally.operators.ordering import rank_cutoff
from fieldtally.operators.regression import assemble, fit_boosted, fit_ridge
from fieldtally.sources.readers import extract_script_text


@pytest.mark.parametrize("unit", ["a", "\\n"])
def test_script_text_of_any_length(spark, unit):
    page = spark.range(1).select(F.concat(F.lit('<script>var v = "'), F.repeat(F.lit(unit), 100_000), F.lit('";</script>')).alias("html"))
    assert len(extract_script_text(page, "html", "v", "out").first()["out"]) == 100_000


def test_cutoff_beyond_the_group_limit(spark, plan):
    rows = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    large = rank_cutoff(rows, ["g"], "v", 5_000, "cut")
    assert {r["g"]: r["cut"] for r in large.collect()} == {0: 10_000, 1: 10_001}
    assert "WindowGroupLimit" in plan(rank_cutoff(rows, ["g"], "v", 12, "cut"))
    assert "hashpartitioning(g" in plan(large) and "_slice" in plan(large)


def test_fit_without_rows_is_refused(spark):
    empty = assemble(spark.createDataFrame([], "x double, y double"), ["x"])
    with pytest.raises(ValueError):
        fit_ridge(empty, "y", 1.0)


def test_boosted_fit_repeats_and_learns(spark):
    rows = assemble(spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 * 3.0).alias("y")), ["x"])
    few, same, more = fit_boosted(rows, "y", 5), fit_boosted(rows, "y", 5), fit_boosted(rows, "y", 20)
    error = lambda m: m.transform(rows).agg(F.avg(F.abs(F.col("y") - F.col("_fit")))).first()[0]
    assert error(few) == error(same) and error(more) < error(few)
    assert abs(sum(few.featureImportances.toArray()) - 1) < 1e-9


def test_boosted_fit_makes_its_rows_once(spark):
    """However often the fit reads its rows, the steps before it run once a row, and nothing stays behind."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return float(x % 20)

    rows = spark.range(400).select(counted("id").alias("x"), (F.col("id") % 20 * 3.0).alias("y"))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = fit_boosted(assemble(rows, ["x"]), "y", 5)
    assert made.value == 400 and spark.sparkContext._jsc.getPersistentRDDs().size() <= held
    plain = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 * 3.0).alias("y"))
    drawn = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.trees]  # the first line holds a random name
    assert drawn(model) == drawn(fit_boosted(assemble(plain, ["x"]), "y", 5))


def grown(model):
    """Per tree: the columns and thresholds of its splits, and all that it predicts."""
    lines = [line.strip() for t in model.trees for line in t.toDebugString.split("\n")[1:]]
    return [x for x in lines if not x.startswith("Predict")], np.array([float(x.split()[1]) for x in lines if x.startswith("Predict")])


@pytest.mark.parametrize("n,parts,columns,shares", [
    (4_000, 1, ["rand(1)", "rand(2)", "rand(3)", "rand(4)", "rand(5)"], (0.8, 0.8)),
    (4_000, 3, ["rand(1)", "floor(rand(2) * 3)", "if(rand(3) < 0.7, 0, rand(4) - 0.4)", "1.0"], (0.8, 0.8)),
    (2_000, 2, ["rand(1)", "rand(2)", "rand(3)"], (1.0, 1.0)),
    (90_000, 2, ["rand(1)", "rand(2)", "rand(3)"], (0.8, 0.8)),
])
def test_trees_by_blocks_are_those_of_the_library(spark, tmp_path, n, parts, columns, shares):
    """Also with several partitions and blocks, repeated values, a constant column and bins from a sample."""
    names = [f"x{i}" for i in range(len(columns))]
    rows = spark.range(0, n, 1, parts).select("id", *[F.expr(c).cast("double").alias(x) for c, x in zip(columns, names)])
    rows = assemble(rows.withColumn("y", F.expr("100 + x0 * 3 + x1 * x2 + 0.3 * randn(9)")), names).persist(StorageLevel.MEMORY_ONLY)
    assert rows.count() == n
    settings = dict(featuresCol="features", labelCol="y", maxIter=6, stepSize=0.05, maxDepth=4, seed=42, predictionCol="_fit")
    estimator = GBTRegressor(subsamplingRate=shares[0], featureSubsetStrategy=str(shares[1]), **settings)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    expected, model = estimator.fit(rows), boosting.fit_trees(rows, n, estimator)
    (splits, values), (same_splits, same_values) = grown(expected), grown(model)
    assert splits == same_splits and len(splits) > 50 and np.allclose(values, same_values, rtol=1e-10, atol=1e-10)
    assert np.allclose(expected.featureImportances.toArray(), model.featureImportances.toArray(), atol=1e-10)
    assert expected.treeWeights == model.treeWeights and spark.sparkContext._jsc.getPersistentRDDs().size() <= held
    # The stored model predicts the same.
    model.write().overwrite().save(str(tmp_path / "model"))
    pairs = expected.transform(rows).select("id", F.col("_fit").alias("a")).join(
        GBTRegressionModel.load(str(tmp_path / "model")).transform(rows).select("id", F.col("_fit").alias("b")), "id")
    assert pairs.where("abs(a - b) > 1e-9").count() == 0 and pairs.count() == n
    rows.unpersist()


def test_trees_by_blocks_refuse_what_the_library_refuses(spark):
    rows = assemble(spark.createDataFrame([(1.0, 2.0), (2.0, float("nan"))], "x double, y double"), ["x"])
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(Exception, match="finite"):
        boosting.fit_trees(rows, 2, GBTRegressor(labelCol="y", maxIter=2, featureSubsetStrategy="0.8"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held


def test_many_rows_are_fitted_by_blocks(spark, monkeypatch):
    """A fit of more rows than one partition holds takes no pass over single rows."""
    calls = []
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: calls.append(1))
    rows = assemble(spark.range(0, 200_001, 1, 2).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 50 * 2.0).alias("y")), ["x"])
    model = fit_boosted(rows, "y", 2)
    assert not calls and model.getNumTrees == 2


def test_predictions_survive_many_trees_and_leave_no_files(spark, monkeypatch):
    """Predictions are written every few trees; neither that nor the number of blocks shows in the result."""
    rows = assemble(spark.range(0, 900, 1, 2).select(F.rand(1).alias("x"), F.rand(2).alias("y")), ["x"]).persist()
    estimator = GBTRegressor(labelCol="y", maxIter=7, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="1.0", seed=5)
    plain = grown(boosting.fit_trees(rows, 900, estimator))
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    removed, remove = [], boosting._remove
    monkeypatch.setattr(boosting, "_remove", lambda session, path: (removed.append(path), remove(session, path)))
    often = grown(boosting.fit_trees(rows, 900, estimator))
    assert plain[0] == often[0] and np.array_equal(plain[1], often[1])
    paths = {p for p in removed if p}
    assert len(paths) == 3
    for path in paths:
        files, folder = boosting.file_system(spark, path)
        assert not files.exists(folder)
    rows.unpersist()

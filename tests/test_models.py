"""Residual models: the grouped ridge, the model store, and what a whole valuation returns with few trees."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from conftest import SMALL
from fieldtally.bindings import composed, model_queries, tables
from fieldtally.operators import regression
from fieldtally.operators.regression import assemble
from fieldtally.plans import valuation as val
from fieldtally.sources.models import ModelStore


def grouped(spark, groups=3, n=80, p=5, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        x = rng.normal(size=(n + 10 * g, p)) * [1, 5, 0.2, 1, 1] + g
        x[:, 4] = 3.0
        y = x @ rng.normal(size=p) + rng.normal(size=len(x)) + 100 * g
        rows += [(f"g{g}", *map(float, r), float(v)) for r, v in zip(x, y)]
    cols = [f"x{i}" for i in range(p)]
    return spark.createDataFrame(rows, "g string, " + ", ".join(f"{c} double" for c in cols) + ", y double"), cols


def test_grouped_ridge_equals_one_fit_per_group(spark):
    df, cols = grouped(spark)
    fitted = regression.ridge_table(df, cols, "y", ["g"], 10.0)
    frame = df.toPandas()
    for row in fitted.collect():
        part = frame[frame.g == row["g"]]
        x, y = part[cols].to_numpy(), part["y"].to_numpy()
        centred = x - x.mean(0)
        want = np.linalg.solve(centred.T @ centred + 10 * np.eye(len(cols)), centred.T @ (y - y.mean()))
        assert np.allclose(row["coefs"], want, atol=1e-8) and row["n_train"] == len(part)
        assert abs(row["intercept"] - (y.mean() - want @ x.mean(0))) < 1e-8
    scaled = val.standardize(df, regression.scale_table(df, cols, ["g"]), cols, ["g"])
    together = {r["g"]: r["coefs"] for r in regression.ridge_table(scaled, cols, "y", ["g"], 10.0).collect()}
    for g, coefs in together.items():
        alone = regression.fit_ridge(assemble(scaled.where(F.col("g") == g), cols), "y", 10.0)
        assert np.allclose(alone.coefficients.toArray(), coefs, atol=1e-8)
    predicted = regression.add_ridge(df.withColumn("base", F.lit(1.0)), fitted, cols, ["g"], "base", "out").toPandas()
    by_group = {r["g"]: r for r in fitted.collect()}
    want = [1 + by_group[g]["intercept"] + np.dot(by_group[g]["coefs"], x) for g, x in zip(predicted.g, predicted[cols].to_numpy())]
    assert np.allclose(predicted["out"], want)


def test_grouped_ridge_reads_the_rows_once(spark, plan):
    df, cols = grouped(spark)
    text = plan(regression.gram_table(df, cols, "y", ["g"]))
    assert text.count("Exchange") == 1 and "partial_" in text


def test_gram_sums_of_many_batches_and_odd_groups(spark, plan):
    """Groups over several batches, a NULL key, keys of two types and no key at all; no product is taken row by row."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(25_000, 3))
    keys = [(None if i % 7 == 0 else i % 3, None if i % 5 == 0 else f"g{i % 2}") for i in range(len(x))]
    df = spark.createDataFrame([(*k, *map(float, r)) for k, r in zip(keys, x)], "a bigint, b string, x double, z double, y double")
    df = df.repartition(2)
    fitted = regression.gram_table(df, ["x", "z"], "y", ["a", "b"])
    got = {(r["a"], r["b"]): r for r in fitted.collect()}
    assert set(got) == set(keys)
    for key, r in got.items():
        part = x[[k == key for k in keys]]
        assert r["n_train"] == len(part) and np.allclose(r["sums"], part.sum(0))
        assert np.allclose(r["products"], (part.T @ part)[np.triu_indices(3)])
    (whole,) = regression.gram_table(df, ["x", "z"], "y", []).collect()
    assert whole["n_train"] == len(x) and np.allclose(whole["products"], (x.T @ x)[np.triu_indices(3)])
    assert "lambda" not in plan(fitted)


def test_grouped_ridge_of_nothing(spark):
    df, cols = grouped(spark)
    assert regression.ridge_table(df.where("false"), cols, "y", ["g"], 1.0).count() == 0


def test_model_store(spark, tmp_path):
    data = str(tmp_path / "data")
    spark.range(40).select((F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y")).write.parquet(data)
    rows = assemble(spark.read.parquet(data), ["x"])
    fits = []

    def fit():
        fits.append(1)
        return GBTRegressor(featuresCol="features", labelCol="y", maxIter=2).fit(rows)

    store = ModelStore(spark, [data], str(tmp_path / "models"))
    first, again = store.get(GBTRegressionModel, fit, ["x"]), ModelStore(spark, [data], str(tmp_path / "models")).get(GBTRegressionModel, fit, ["x"])
    assert len(fits) == 1 and first.toDebugString.split("\n")[1:] == again.toDebugString.split("\n")[1:]
    store.get(GBTRegressionModel, fit, ["other"])
    assert len(fits) == 2
    # A save that was cut short is done again.
    (tmp_path / "models" / store.path(["x"]).rsplit("/", 1)[1] / "_complete").unlink()
    store.get(GBTRegressionModel, fit, ["x"])
    assert len(fits) == 3
    spark.range(1).select(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).write.mode("append").parquet(data)
    store.get(GBTRegressionModel, fit, ["x"])
    assert len(fits) == 4


@pytest.fixture(scope="module")
def few_trees(spark):
    wide = composed.mega(spark, SMALL)
    return wide, val.valuation(wide, tables.SEGMENT_K, tables.TRAIN, tables.TEST, trees=3)


def test_valuation_with_few_trees(spark, few_trees):
    wide, result = few_trees
    rows = result.predictions.toPandas()
    known = wide.where(F.col("ppg").isNotNull() & F.col("season").isin(*tables.TEST)).count()
    assert len(rows) == known and rows[["market", "ridge", "boosted"]].notna().all().all()
    table = result.metrics().toPandas()
    assert set(table.model) == {"market", "ridge", "boosted"} and set(table.position) == set(tables.SEGMENT_K)
    assert len(table) == 3 * 5 * 5
    top = result.importances.toPandas()
    assert (top.groupby("position").size() <= 10).all() and (top.groupby("position")["importance"].sum() <= 1 + 1e-9).all()
    assert set(top.feature) <= set(model_queries.FEATURES) == set(result.features)


def test_valuation_repeats_and_the_rest_does_not_depend_on_trees(spark, few_trees):
    """The same seed gives the same trees; market and ridge rows equal those of the query with SQL."""
    wide, result = few_trees
    again = val.valuation(wide, tables.SEGMENT_K, tables.TRAIN, tables.TEST, trees=3)
    key = ["player_id", "season"]
    a, b = (r.predictions.toPandas().sort_values(key)["boosted"].to_numpy() for r in (result, again))
    assert np.array_equal(a, b)
    linear = {tuple(r) for r in model_queries.valued(spark, SMALL, False).metrics().collect()}
    assert linear == {tuple(r) for r in result.metrics().where("model <> 'boosted'").collect()}


def test_more_trees_fit_the_training_rows_better(spark):
    df, cols = grouped(spark, 1)
    rows = assemble(df, cols)
    error = lambda trees: regression.fit_boosted(rows, "y", trees).transform(rows).agg(F.avg(F.abs(F.col("y") - F.col("_fit")))).first()[0]
    assert error(20) < error(5) < error(1)

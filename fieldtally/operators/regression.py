"""Baseline-plus-residual regressions, fitted per group in grouped jobs where the algebra allows it.

Group parameters (medians, means, coefficients) have one row per group and are
written once, like a saved model. The optimizer then knows their size: it
broadcasts them when that is small and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.boosting import fit_trees
from fieldtally.operators.ordering import exact_medians
from fieldtally.session import settle


def time_split(df: DataFrame, period: str, train: Sequence[int], test: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Rows of the training periods and rows of the test periods."""
    return df.where(F.col(period).isin(*train)), df.where(F.col(period).isin(*test))


def _attach(df: DataFrame, params: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put the group's parameters next to each row; without groups there is a single parameter row."""
    return df.join(params, list(by), "left") if by else df.join(F.broadcast(params), F.lit(True), "left")


def median_table(train: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group with a ``_med_<col>`` per column."""
    tall = exact_medians(train, cols, by)
    wide = tall.groupBy(*by).pivot("feature", list(cols)).agg(F.first("median"))
    return settle(wide.select(*by, *[F.col(c).alias(f"_med_{c}") for c in cols]))


def impute_median(df: DataFrame, medians: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Fill NULLs with the group's training median.

    A column without any training value in a group becomes constant there,
    which has the same effect on the fits as leaving it out.
    """
    filled = {
        c: F.when(F.col(f"_med_{c}").isNull(), 0.0).otherwise(F.coalesce(F.col(c).cast("double"), f"_med_{c}"))
        for c in cols
    }
    return _attach(df, medians, by).select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def scale_table(train: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per group; a constant column gets scale 1."""
    spread = lambda c: F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(1.0)
    return settle(train.groupBy(*by).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in cols], *[spread(c).alias(f"_std_{c}") for c in cols]
    ))


def standardize(df: DataFrame, scales: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``(x - mean) / std`` with the group's training statistics."""
    scaled = {c: (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}") for c in cols}
    return _attach(df, scales, by).select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def ridge_pair(
    train: DataFrame, x: tuple[str, str], y: str, by: Sequence[str], alpha: float = 1.0
) -> DataFrame:
    """Ridge with a free intercept on two standardised columns, solved from six sums per group.

    Output: by.., intercept, coef_<x0>, coef_<x1>, n_train.
    """
    a, b = F.col(x[0]), F.col(x[1])
    sums = train.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_train"), F.avg(y).alias("intercept"),
        (F.sum(a * a) + alpha).alias("aa"), (F.sum(b * b) + alpha).alias("bb"), F.sum(a * b).alias("ab"),
        F.sum(a * F.col(y)).alias("ay"), F.sum(b * F.col(y)).alias("cy"),
    )
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    return settle(sums.select(
        *by, "intercept",
        ((F.col("ay") * F.col("bb") - F.col("ab") * F.col("cy")) / det).alias(f"coef_{x[0]}"),
        ((F.col("cy") * F.col("aa") - F.col("ab") * F.col("ay")) / det).alias(f"coef_{x[1]}"),
        "n_train",
    ))


def predict_pair(df: DataFrame, coefs: DataFrame, x: tuple[str, str], by: Sequence[str], out: str) -> DataFrame:
    """Prediction of ``ridge_pair`` on standardised columns."""
    value = F.col("intercept") + F.col(f"coef_{x[0]}") * F.col(x[0]) + F.col(f"coef_{x[1]}") * F.col(x[1])
    return _attach(df, coefs, by).select(*df.columns, value.alias(out))


def gram_table(train: DataFrame, cols: Sequence[str], y: str, by: Sequence[str]) -> DataFrame:
    """Per group: by.., n, the sums of ``cols`` and ``y`` and of the products of every two of them.

    One aggregate for all groups, combined before the shuffle: a task sends
    one row per group, however many rows it read. ``products`` is the upper
    triangle, row by row, with ``y`` as the last column. The products of a
    batch of rows are one matrix product per group, so that only one row per
    batch and group is added up.
    """
    by, width = list(by), len(cols) + 1
    names = [f"_z{i}" for i in range(width)]
    values = train.select(*by, *[F.col(c).cast("double").alias(z) for c, z in zip((*cols, y), names)])

    def batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(width)
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.column_stack([batch.column(len(by) + i).to_numpy(zero_copy_only=False) for i in range(width)])
            columns, parts = [], [z]
            if by:
                keys = pa.table({f"k{i}": batch.column(i) for i in range(len(by))} | {"row": np.arange(len(z))})
                groups = keys.group_by([f"k{i}" for i in range(len(by))], use_threads=False).aggregate([("row", "list")])
                columns = [groups.column(f"k{i}").combine_chunks() for i in range(len(by))]
                parts = [z[rows.values.to_numpy()] for rows in groups.column("row_list").combine_chunks()]
            columns.append(pa.array([len(x) for x in parts], pa.int64()))
            columns.append(pa.array([x.sum(0) for x in parts], pa.list_(pa.float64())))
            columns.append(pa.array([(x.T @ x)[upper] for x in parts], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, [*by, "_n", "_s", "_p"])

    shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in values.select(*by).schema)
    sums = values.mapInArrow(batch_sums, f"{shape}_n bigint, _s array<double>, _p array<double>").groupBy(*by).agg(
        F.sum("_n").alias("n_train"),
        Summarizer.sum(array_to_vector("_s")).alias("_sums"),
        Summarizer.sum(array_to_vector("_p")).alias("_products"),
    )
    return sums.select(*by, "n_train", vector_to_array("_sums").alias("sums"), vector_to_array("_products").alias("products"))


def ridge_table(train: DataFrame, cols: Sequence[str], y: str, by: Sequence[str], alpha: float) -> DataFrame:
    """Ridge with a free intercept for every group at once: by.., intercept, coefs (in the order of ``cols``), n_train.

    The rows are read once for all groups; each group's system, no larger than
    the square of its columns, is solved by Cholesky where its row lies.
    ``cols`` and ``y`` hold no NULL. Without training rows there is no row.
    """

    # Nested, so that it travels by value and the tasks need not have this package installed.
    def solution(n: int, sums: np.ndarray, products: np.ndarray) -> tuple[float, np.ndarray]:
        width = len(sums)
        full = np.zeros((width, width))
        full[np.triu_indices(width)] = products
        full += np.triu(full, 1).T
        mean = sums / n
        centred = full - n * np.outer(mean, mean)
        lower = np.linalg.cholesky(centred[:-1, :-1] + alpha * np.eye(width - 1))
        coefs = np.linalg.solve(lower.T, np.linalg.solve(lower, centred[:-1, -1]))
        return float(mean[-1] - coefs @ mean[:-1]), coefs

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fits = [solution(*fit) for fit in zip(frame["n_train"], frame["sums"], frame["products"])]
            out = frame.drop(columns=["sums", "products"])
            out["intercept"], out["coefs"] = [f[0] for f in fits], [f[1] for f in fits]
            yield out

    kept = gram_table(train, cols, y, by)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("sums", "products").schema)
    return settle(kept.mapInPandas(solve, f"{shape}, intercept double, coefs array<double>"), "ridge")


def add_ridge(df: DataFrame, fitted: DataFrame, cols: Sequence[str], by: Sequence[str], base: str, out: str) -> DataFrame:
    """``base`` plus the prediction of ``ridge_table``; NULL in groups without a fit."""
    value = F.col(base) + F.col("_intercept")
    for i, c in enumerate(cols):
        value = value + F.col("_coefs")[i] * F.col(c)
    named = fitted.select(*by, F.col("intercept").alias("_intercept"), F.col("coefs").alias("_coefs"))
    return _attach(df, named, by).select(*df.columns, value.alias(out))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Pack numeric columns into one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def fit_ridge(train: DataFrame, y: str, alpha: float, features: str = "features"):
    """Ridge on an assembled, standardised vector; ``alpha`` weighs the sum of squared coefficients.

    Spark's penalty is relative to row count and label spread, hence the
    conversion.
    """
    n, spread = train.agg(F.count(F.lit(1)), F.stddev_pop(y)).first()
    if not n:
        raise ValueError("no rows to fit on")
    penalty = alpha * (spread or 0.0) / n
    return LinearRegression(
        featuresCol=features, labelCol=y, solver="normal", elasticNetParam=0.0,
        regParam=penalty, standardization=False, predictionCol="_fit",
    ).fit(train)


def fit_boosted(
    train: DataFrame, y: str, trees: int = 400, rate: float = 0.05, depth: int = 4,
    row_share: float = 0.8, column_share: float = 0.8, seed: int = 42, features: str = "features",
):
    """Gradient-boosted regression trees.

    A few hundred trees are some thousand short jobs, so few rows are put into
    few partitions: about 200,000 rows each. The fit reads the rows several
    times before its own binned copy exists; they are kept on the executors'
    disks meanwhile, or every pass would assemble the vectors anew. Rows that
    fill more than one such partition are counted in blocks, for the same trees.
    """
    rows = train.count()
    kept = train.select(y, features).coalesce(max(1, rows // 200_000)).persist(StorageLevel.DISK_ONLY)
    estimator = GBTRegressor(
        featuresCol=features, labelCol=y, maxIter=trees, stepSize=rate, maxDepth=depth,
        subsamplingRate=row_share, featureSubsetStrategy=str(column_share), seed=seed, predictionCol="_fit",
    )
    try:
        return fit_trees(kept, rows, estimator) if rows > 200_000 else estimator.fit(kept)
    finally:
        kept.unpersist()


def add_fit(df: DataFrame, model, base: str, out: str) -> DataFrame:
    """``base`` plus the model's prediction."""
    return model.transform(df).withColumn(out, F.col(base) + F.col("_fit")).drop("_fit")


def importances(model, cols: Sequence[str], n: int, spark, **labels: str) -> DataFrame:
    """The ``n`` most important features of a fitted tree model."""
    values = model.featureImportances.toArray()
    table = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, values)], "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature").limit(n)
    return ranked.select(*[F.lit(v).alias(k) for k, v in labels.items()], "feature", "importance")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames of the same shape."""
    return reduce(DataFrame.unionByName, frames)


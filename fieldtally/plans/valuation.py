"""Market baseline plus residual models, evaluated against the actual outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.operators.aggregates import spread_stats
from fieldtally.operators.metrics import evaluate
from fieldtally.operators.ordering import rank_min
from fieldtally.operators.regression import (
    add_fit, add_ridge, assemble, fit_boosted, importances, impute_median, median_table, predict_pair, ridge_pair,
    ridge_table, scale_table, standardize, union_all,
)
from fieldtally.plans import league
from fieldtally.plans.explore import residual_features
from fieldtally.session import settle
from fieldtally.sources.models import ModelStore

TARGET, EXPECTED, RESIDUAL = "ppg", "expected_ppg", "residual"


@dataclass
class Valuation:
    """Everything one run produces."""

    predictions: DataFrame
    residual_stats: DataFrame
    coefficients: DataFrame
    residual_ridge: DataFrame
    importances: DataFrame | None
    features: list[str]
    top_k: Mapping[str, int]
    group: str = "position"
    models: dict[str, object] = field(default_factory=dict)

    def metrics(self) -> DataFrame:
        """(group, model, metric, value) for all models, measured on the test seasons in one job."""
        names = [c for c in ("market", "ridge", "boosted") if c in self.predictions.columns]
        return evaluate(self.predictions, TARGET, names, "season", dict(self.top_k), [self.group], self.group)


def training_rows(
    mega: DataFrame, groups: Sequence[str], features: Sequence[str], train: Sequence[int], test: Sequence[int],
    group: str = "position", ids: Sequence[str] = ("player_id",),
) -> DataFrame:
    """Rows with a known outcome in the training or test seasons, only the columns the models need."""
    kept = mega.where(
        F.col(TARGET).isNotNull() & F.col(group).isin(*groups) & F.col("season").isin(*train, *test)
    )
    return kept.select(*ids, group, "season", TARGET, *[F.col(c).cast("double").alias(c) for c in features],
                       F.col("season").isin(*train).alias("is_train"))


def scaled_rows(rows: DataFrame, cols: Sequence[str], group: str = "position") -> DataFrame:
    """Fill with training medians, then standardise with training statistics, per group."""
    train = rows.where("is_train")
    filled = impute_median(rows, median_table(train, cols, [group]), cols, [group])
    return standardize(filled, scale_table(filled.where("is_train"), cols, [group]), cols, [group])


def baseline(scaled: DataFrame, alpha: float = 1.0, group: str = "position") -> tuple[DataFrame, DataFrame]:
    """(rows with expected outcome and residual, coefficients): ridge on the two market columns."""
    pair = league.MARKET_COLUMNS
    coefs = ridge_pair(scaled.where("is_train"), pair, TARGET, [group], alpha)
    priced = predict_pair(scaled, coefs, pair, [group], EXPECTED)
    return priced.withColumn(RESIDUAL, F.col(TARGET) - F.col(EXPECTED)), coefs


def valuation(
    mega: DataFrame,
    top_k: Mapping[str, int] = league.TOP_K,
    train: Sequence[int] = league.TRAIN_SEASONS,
    test: Sequence[int] = league.TEST_SEASONS,
    group: str = "position",
    ids: Sequence[str] = ("player_id",),
    features: Sequence[str] | None = None,
    ridge_alpha: float = 10.0,
    trees: int = 400,
    boosted: bool = True,
    store: ModelStore | None = None,
) -> Valuation:
    """Fit per group and predict the test seasons.

    The model input is written once, one folder per group. The residual ridge
    of all groups is one job; the boosted models read a folder each. With a
    ``store``, boosted models fitted before on the same files with the same
    settings are loaded instead.
    """
    features = list(features or residual_features(mega))
    columns = list(dict.fromkeys([*league.MARKET_COLUMNS, *features]))
    rows = settle(training_rows(mega, list(top_k), columns, train, test, group, ids))
    priced, coefs = baseline(scaled_rows(rows, columns, group), group=group)
    kept = list(dict.fromkeys([*ids, group, "season", TARGET, EXPECTED, RESIDUAL, "is_train", *features]))
    ready = settle(priced.select(*kept), "model-rows", group)
    learn = ready.where("is_train")
    ridge = ridge_table(learn, features, RESIDUAL, [group], ridge_alpha)

    known = {r[0] for r in ridge.select(group).collect()}
    # A group without training rows has nothing to predict from: it is left out of the result.
    groups = [value for value in top_k if value in known]
    if not groups:
        raise ValueError("no group has training rows")
    score = ready.where(~F.col("is_train") & F.col(group).isin(*groups))
    predictions = add_ridge(score, ridge, features, [group], EXPECTED, "ridge")
    models, report = {}, None
    if boosted:
        parts = {value: assemble(ready.where(F.col(group) == value), features) for value in groups}

        def fit(value: str) -> GBTRegressionModel:
            make = lambda: fit_boosted(parts[value].where("is_train"), RESIDUAL, trees)
            settings = [value, features, trees, sorted(train), sorted(test)]
            return store.get(GBTRegressionModel, make, settings) if store else make()

        # The groups' fits are independent chains of short jobs; a few at a time keep the executors busy.
        with ThreadPool(min(8, len(groups))) as pool:
            models = dict(zip(groups, pool.map(fit, groups)))
        report = union_all([importances(models[v], features, 10, mega.sparkSession, **{group: v}) for v in groups])
        vectors = assemble(predictions, features)
        predictions = union_all([add_fit(vectors.where(F.col(group) == v), models[v], EXPECTED, "boosted") for v in groups])
    outcome = [c for c in ("ridge", "boosted") if c in predictions.columns]
    labels = list(dict.fromkeys([*ids, group, "season", TARGET, EXPECTED, RESIDUAL]))
    return Valuation(
        predictions=predictions.select(*labels, *outcome, F.col(EXPECTED).alias("market")),
        residual_stats=spread_stats(learn, RESIDUAL, [group]),
        coefficients=coefs,
        residual_ridge=ridge,
        importances=report,
        features=features,
        top_k=top_k,
        group=group,
        models=models,
    )


def model_vs_market(
    predictions: DataFrame, model: str, market: str = "adp_overall", by: Sequence[str] = ("season", "position")
) -> DataFrame:
    """Rank by prediction (high first) next to the rank by market price (low first), and the difference."""
    ranked = rank_min(predictions, by, model, "model_rank")
    both = rank_min(ranked, by, market, "market_rank", descending=False)
    return both.withColumn("rank_gap", F.col("market_rank") - F.col("model_rank"))

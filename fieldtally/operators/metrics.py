"""Accuracy and top-K ranking metrics, for any number of groups and models in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.numeric import flag, half_even, pearson
from fieldtally.operators.ordering import rank_average, rank_cutoff
from fieldtally.session import settle


TOPK_METRICS = ("precision_at_k", "spearman_at_k", "mae_at_k")


def mean_absolute_error(y: str, pred: str) -> Column:
    """Aggregate expression: mean absolute difference."""
    return F.avg(F.abs(F.col(y) - F.col(pred)))


def accuracy(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error and Pearson correlation, pooled over all rows of a group."""
    return df.groupBy(*by).agg(
        mean_absolute_error(y, pred).alias("mae"), pearson(F.col(y), F.col(pred)).alias("r")
    )


def spearman(df: DataFrame, a: str, b: str, by: Sequence[str], out: str = "spearman") -> DataFrame:
    """Pearson correlation of average ranks; NULL where a side is constant."""
    ranked = rank_average(rank_average(df, by, a, "_rank_a"), by, b, "_rank_b")
    return ranked.groupBy(*by).agg(pearson(F.col("_rank_a"), F.col("_rank_b")).alias(out))


def _limit(k: int | Mapping[str, int], key: str | None) -> tuple[int, Column]:
    """Largest k, and the k that applies to a row."""
    if isinstance(k, int):
        return k, F.lit(k)
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(k.items())])
    return max(k.values()), table[F.col(key)]


def _topk(
    rows: DataFrame, period: str, k: int | Mapping[str, int], by: Sequence[str], k_key: str | None
) -> DataFrame:
    """Metrics per group and period of rows (by.., period, _y, _p) that are cheap to read several times."""
    group = [*by, period]
    largest, own = _limit(k, k_key)
    cut_y = rank_cutoff(rows, group, "_y", largest, "_cut_y", own)
    cut_p = rank_cutoff(rows, group, "_p", largest, "_cut_p", own)
    # One row per group, written so that the optimizer knows its size and can broadcast it when small.
    cuts = settle(cut_y.join(cut_p, group))
    marked = rows.join(cuts, group).select(
        *group, "_y", "_p", (F.col("_y") >= F.col("_cut_y")).alias("_actual"),
        (F.col("_p") >= F.col("_cut_p")).alias("_predicted"),
    )
    stats = marked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(flag(F.col("_actual") & F.col("_predicted"))).alias("_hits"),
        F.avg(F.when(F.col("_actual"), F.abs(F.col("_y") - F.col("_p")))).alias("mae_at_k"),
    )
    rho = spearman(marked.where("_actual").select(*group, "_y", "_p"), "_p", "_y", group, "spearman_at_k")
    return stats.where(F.col("_rows") >= own).join(rho, group, "left").select(
        *group, (F.col("_hits") / own).alias("precision_at_k"), "spearman_at_k", "mae_at_k"
    )


def _mean_over_periods(per: DataFrame, by: Sequence[str]) -> DataFrame:
    return per.groupBy(*by).agg(*[F.avg(m).alias(m) for m in TOPK_METRICS])


def topk_by_period(
    df: DataFrame, y: str, pred: str, period: str, k: int | Mapping[str, int], by: Sequence[str] = (),
    k_key: str | None = None,
) -> DataFrame:
    """Per group and period: precision, Spearman and MAE within the actual top k.

    Periods with fewer than k rows are left out. ``k`` may differ by the
    values of the column ``k_key``. Membership is a comparison with the k-th
    value, so ties at the edge are all members while precision still divides
    by k. Outcomes and predictions are written once and then read by each of
    the passes.
    """
    rows = settle(df.select(*by, period, F.col(y).alias("_y"), F.col(pred).alias("_p")))
    return _topk(rows, period, k, by, k_key)


def topk_metrics(
    df: DataFrame, y: str, pred: str, period: str, k: int | Mapping[str, int], by: Sequence[str] = (),
    k_key: str | None = None,
) -> DataFrame:
    """The per-period metrics averaged over periods. A period without a Spearman value is left out of its mean."""
    return _mean_over_periods(topk_by_period(df, y, pred, period, k, by, k_key), by)


def evaluate(
    df: DataFrame, y: str, preds: Sequence[str], period: str, k: int | Mapping[str, int],
    by: Sequence[str] = (), k_key: str | None = None, places: int = 3,
) -> DataFrame:
    """Tidy (by.., model, metric, value) table for several prediction columns at once."""
    slim = df.select(*by, period, F.col(y).alias("_y"), *[F.col(p).cast("double").alias(p) for p in preds])
    rows = settle(slim.unpivot([*by, period, "_y"], list(preds), "model", "_p"))
    keys = [*by, "model"]
    ranked = _mean_over_periods(_topk(rows, period, k, keys, k_key), keys)
    names = ["mae", "r", *TOPK_METRICS]
    wide = accuracy(rows, "_y", "_p", keys).join(ranked, keys, "left")
    return wide.select(*keys, *[half_even(F.col(m), places).alias(m) for m in names]).unpivot(
        keys, names, "metric", "value"
    )

"""Grouped summaries. Rows with a NULL group key are left out everywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from fieldtally.functions.numeric import flag, half_even, pearson, safe_ratio, sum_or_zero


def group_present(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """``groupBy`` over rows whose keys are all present."""
    return df.dropna(subset=list(keys)).groupBy(*keys)


def rollup_period(
    df: DataFrame, keys: Sequence[str], count_col: str, sum_cols: Sequence[str], count_out: str = "games_played"
) -> DataFrame:
    """Short periods to long ones: count the non-NULL ``count_col``, sum the rest (nothing to sum is 0)."""
    return group_present(df, keys).agg(
        F.count(count_col).cast("int").alias(count_out), *[sum_or_zero(F.col(c)).alias(c) for c in sum_cols]
    )


def weighted_mean(
    df: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    weight: str,
    ignore_null_weight: bool = False,
) -> DataFrame:
    """Volume-weighted mean per key of the value columns that exist.

    The weight of a row counts even where its value is NULL, so a group
    without values gives 0.0; ``ignore_null_weight=True`` leaves such weights
    out and gives NULL. No positive weight gives NULL.
    """
    w = F.col(weight)

    def mean(c: str) -> Column:
        base = F.sum(F.when(F.col(c).isNotNull(), w)) if ignore_null_weight else F.sum(w)
        return safe_ratio(sum_or_zero(F.col(c) * w).cast("double"), base).alias(c)

    return group_present(df, keys).agg(*[mean(c) for c in value_cols if c in df.columns])


def sum_and_mean(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], means: Mapping[str, str]
) -> DataFrame:
    """Totals and plain means, given as {output: input}."""
    return group_present(df, keys).agg(
        *[sum_or_zero(F.col(c)).alias(out) for out, c in sums.items()],
        *[F.avg(c).alias(out) for out, c in means.items()],
    )


def conditional_counts(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    """Rows per key that meet each condition, all in one pass."""
    return group_present(df, keys).agg(*[F.sum(flag(cond)).alias(out) for out, cond in conditions.items()])


def group_denominators(
    df: DataFrame, keys: Sequence[str], first: Column, second: Column,
    names: tuple[str, str, str] = ("team_pass_plays", "team_rush_attempts", "team_pass_rate"),
) -> DataFrame:
    """Two conditional counts and the share of the first, for groups with at least one hit."""
    a, b, rate = names
    counted = conditional_counts(df.where(first | second), keys, {a: first, b: second})
    return counted.withColumn(rate, safe_ratio(F.col(a), F.col(a) + F.col(b)))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group, sorted by group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).orderBy(*keys)


def mean_across(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of several columns per key, for instance over all sources."""
    return group_present(df, keys).agg(*[F.avg(c).alias(c) for c in cols])


def table_summary(df: DataFrame, period: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, number of columns, distinct periods and their range."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.countDistinct(period).alias("n_periods"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
    )


def null_rates(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Percentage of NULLs per column, one decimal, only columns that have any, largest first."""
    cols = [c for c in df.columns if c not in by]
    n = F.count(F.lit(1))
    share = lambda c: half_even((n - F.count(c)) * 100.0 / n, 1)
    wide = df.groupBy(*by).agg(*[share(c).alias(c) for c in cols])
    tall = wide.unpivot(list(by), cols, "column_name", "null_pct")
    return tall.where("null_pct > 0").orderBy(*by, F.desc("null_pct"), "column_name")


def correlations(df: DataFrame, cols: Sequence[str], target: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of every column with ``target``, pairwise complete, undefined ones left out, ascending."""
    others = [c for c in cols if c != target]
    wide = df.groupBy(*by).agg(*[pearson(F.col(c), F.col(target)).alias(c) for c in others])
    tall = wide.unpivot(list(by), others, "feature", "corr")
    return tall.where(F.col("corr").isNotNull()).orderBy(*by, "corr", "feature")


def correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = (), out: str = "corr") -> DataFrame:
    """Correlation of two columns over rows that have both, with the number of such rows."""
    both = df.dropna(subset=[x, y])
    return both.groupBy(*by).agg(pearson(F.col(x), F.col(y)).alias(out), F.count(F.lit(1)).alias("n"))


def spread_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum."""
    return df.groupBy(*by).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max")
    )

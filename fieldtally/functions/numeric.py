"""Column expressions for guarded arithmetic and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` where ``den > 0``, else NULL."""
    return F.when(den > 0, num / den)


def nonzero_ratio(num: Column, den: Column) -> Column:
    """``num / den`` unless ``den`` is zero; negative denominators pass."""
    return num / F.nullif(den, F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def to_number(col: Column) -> Column:
    """Double value of a column; text that is not a number, NaN and NULL count as 0."""
    return F.coalesce(F.nanvl(col.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def half_even(col: Column, places: int) -> Column:
    """Round half to even."""
    return F.bround(col, places)


def sum_or_zero(col: Column) -> Column:
    """Sum in which a group without any value counts as 0."""
    return F.coalesce(F.sum(col), F.lit(0))


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are present; NULL when either is constant."""
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating-point columns (all of them unless ``cols`` is given)."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    chosen = floating if cols is None else floating & set(cols)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])

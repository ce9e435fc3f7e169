"""Wide-to-long reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.names import name_matches
from fieldtally.operators.ordering import top_rows
from fieldtally.operators.project import select_present


def feature_rows(df: DataFrame, ids: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """One (feature, value) row per column, values as text."""
    cols = [c for c in (cols or df.columns) if c not in ids]
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot(list(ids), cols, "feature", "value")


def profile(df: DataFrame, pattern: str, cols: Sequence[str], name: str = "full_name") -> DataFrame:
    """All rows of entities whose name matches, reduced to the listed columns that exist."""
    return select_present(df.where(name_matches(F.col(name), pattern)), cols)


def feature_row(
    df: DataFrame, pattern: str, period_value: int, ids: Sequence[str] = (), name: str = "full_name",
    period: str = "season",
) -> DataFrame:
    """Every column of one entity-period as (feature, value)."""
    return feature_rows(df.where(name_matches(F.col(name), pattern) & (F.col(period) == period_value)), ids)


def over_under(
    df: DataFrame, expected: str, actual: str, n: int, cols: Sequence[str], ties: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    """The ``n`` largest and ``n`` smallest differences ``value = expected - actual``.

    Rows without a difference only fill up a short result.
    """
    valued = select_present(df.withColumn("value", F.col(expected) - F.col(actual)), [*cols, "value"])
    steals = top_rows(valued, [F.desc_nulls_last("value"), *ties], n)
    busts = top_rows(valued, [F.asc_nulls_last("value"), *ties], n)
    return steals, busts

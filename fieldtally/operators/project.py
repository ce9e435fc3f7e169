"""Schema-driven projections. They look at column names only and start no job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in dict.fromkeys(wanted) if c in have])


def conform(df: DataFrame, renames: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Rename columns, then optionally keep a standard list of them."""
    renamed = df.withColumnsRenamed(dict(renames))
    return renamed if keep is None else select_present(renamed, keep)


def columns_with_prefix(df: DataFrame, prefix: str, extra: Sequence[str] = ()) -> list[str]:
    """``extra`` followed by every column whose name starts with ``prefix``."""
    return [*extra, *[c for c in df.columns if c.startswith(prefix)]]


def add_prefix(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    """Rename ``cols`` to ``prefix + name``."""
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

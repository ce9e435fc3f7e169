"""What the operators of this package share: tables, words, stable row positions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.session import settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A word is a run of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this package, with its SQL where there is one."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def count_words(text: Column) -> Column:
    """Number of words as long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def positions(df: DataFrame, order: Sequence[Column], out: str, total: str) -> DataFrame:
    """Add each row's position (from 0) in a global order, and the number of rows.

    The rows are range partitioned and written once, sorted, with a row number
    inside each slice; a second step adds the rows of the earlier slices. The
    table of offsets has one row per slice, so it may be broadcast at any data
    size. ``order`` should break all ties between rows that differ.
    """
    mark, slice_, first, own = "__slot", "__slice", "__first", "__own"
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(mark, F.monotonically_increasing_id()),
        "positions",
    ).withColumn(slice_, F.shiftright(mark, 33))
    counts = placed.groupBy(slice_).agg(F.count(F.lit(1)).alias(own))
    earlier = Window.orderBy(slice_)
    offsets = counts.select(
        slice_,
        (F.sum(own).over(earlier) - F.col(own)).alias(first),
        F.sum(own).over(earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total),
    )
    position = F.col(first) + F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), slice_).select(*df.columns, position.alias(out), total)

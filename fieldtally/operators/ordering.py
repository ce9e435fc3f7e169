"""Ranks, running totals and medians that stay parallel inside one huge group.

A window function puts a whole group into one task. Where a group can be a
large share of the table (a season, a position) the functions here range
partition the *ordered values* instead: each slice is numbered on its own and
shifted by what the earlier slices hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.session import settle

_SLICE, _OFFSET, _BEFORE, _N = "_slice", "_offset", "_before", "_n"


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    amount: str | None = None,
    out: str = _BEFORE,
    total: str | None = None,
) -> DataFrame:
    """Add the sum of ``amount`` over the rows that precede each row of its group.

    ``amount=None`` counts rows. ``total`` also adds the sum of the whole
    group. ``order`` should be unique within a group. The slices are written
    to the shared folder once, so that numbering and offsets describe the
    same partitions whatever is recomputed later.
    """
    wanted, by = df.columns, list(by)
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    size = F.col(amount) if amount else F.lit(1)
    slices = settle(df.repartitionByRange(*by, *order).withColumn(_SLICE, F.spark_partition_id()))
    per_slice = slices.groupBy(*by, _SLICE).agg(F.sum(size).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # A slice continues at most one group of the slices before it, so this
    # table has at most one row per slice: safe to broadcast at any data size.
    offsets = (
        per_slice.withColumn(_OFFSET, F.sum("_size").over(earlier))
        .where(F.col(_OFFSET).isNotNull())
        .select(*[F.col(c).alias(f"_o_{c}") for c in by], F.col(_SLICE).alias("_o_slice"), _OFFSET)
    )
    local = Window.partitionBy(*by, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = slices.withColumn("_upto", F.sum(size).over(local))
    same = F.col(_SLICE) == F.col("_o_slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    result = numbered.join(F.broadcast(offsets), same, "left").select(
        *df.columns, (F.col("_upto") - size + F.coalesce(_OFFSET, F.lit(0))).alias(out)
    )
    if total is None:
        return result.select(*wanted, out)
    sums = per_slice.groupBy(*by).agg(F.sum("_size").alias(total))
    return result.join(sums, by).select(*wanted, out, total)


def _counted(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their row counts: ties collapse before any sort."""
    return df.dropna(subset=[*by, value]).groupBy(*by, value).agg(F.count(F.lit(1)).alias(_N))


def _with_rank(df: DataFrame, by: Sequence[str], value: str, rank: Column, out: str, descending: bool) -> DataFrame:
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranked = running_total(_counted(df, by, value), by, [order], _N)
    return df.join(ranked.select(*by, value, rank.alias(out)), [*by, value], "left").select(*df.columns, out)


def rank_min(df: DataFrame, by: Sequence[str], value: str, out: str, descending: bool = True) -> DataFrame:
    """Rank where ties share the smallest position; NULL values get a NULL rank."""
    return _with_rank(df, by, value, (F.col(_BEFORE) + 1).cast("int"), out, descending)


def rank_average(df: DataFrame, by: Sequence[str], value: str, out: str, descending: bool = False) -> DataFrame:
    """Rank where ties share the mean of their positions."""
    return _with_rank(df, by, value, F.col(_BEFORE) + (F.col(_N) + 1) / 2, out, descending)


def rank_first(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str, on: Sequence[str] | None = None, unique: bool = False
) -> DataFrame:
    """Position of each row in its group; rows that ``order`` can't tell apart follow each other in no fixed order.

    With ``on``, the columns that ``order`` reads, only these and the group
    are ordered and written, and the positions are joined back: wide rows are
    not written at all. ``unique`` promises that the group and ``on`` tell all
    rows apart, which saves a step; a promise that doesn't hold fails the job.
    """
    if on is None:
        numbered = running_total(df, by, order)
        return numbered.select(*df.columns, (F.col(_BEFORE) + 1).cast("int").alias(out))
    keys = list(dict.fromkeys([*by, *on]))
    # Equal rows are one row here, so the way back can't multiply them.
    ranked = running_total(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)), by, order, _N)
    named = ranked.select(*[F.col(c).alias(f"_k_{c}") for c in keys], _N, _BEFORE)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    error = F.raise_error(F.lit(f"{', '.join(keys)} do not tell all rows apart")).cast("int")
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) if not unique else F.when(F.col(_N) > 1, error).otherwise(1)
    return df.join(named, same).select(*df.columns, (F.col(_BEFORE) + own).cast("int").alias(out))


def ordinal(df: DataFrame, entity: str, period: str, out: str) -> DataFrame:
    """1 for an entity's first period, 2 for its second, ... on input unique in (entity, period).

    The group is one entity's periods, so a plain window is enough.
    """
    return df.withColumn(out, F.row_number().over(Window.partitionBy(entity).orderBy(period)).cast("int"))


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key, the first or last in ``order``.

    An aggregate rather than a window: it combines before the shuffle, so at
    most one row per key and task is moved. Rows as aggregates cannot be
    hashed in place, so Spark sorts by key on both sides of the shuffle.
    ``order`` must be non-NULL and unique per key.
    """
    pick = F.max_by if keep == "last" else F.min_by
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dominant(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent ``value`` per key; the smallest one on a tie."""
    counts = df.dropna(subset=[*keys, value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(_N))
    best = F.min(F.struct((-F.col(_N)).alias("rank"), F.col(value).alias("value")))
    return counts.groupBy(*keys).agg(best["value"].alias(value))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order (planned as a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def rank_cutoff(
    df: DataFrame, by: Sequence[str], value: str, k: int, out: str, cap: Column | None = None
) -> DataFrame:
    """Per group, the smallest value whose descending min-rank is at most ``k``.

    ``value >= cutoff`` is then the top-k membership test including ties, and
    no group is ever ranked as a whole: only its k largest distinct values
    survive the first stage. ``cap`` is an expression over ``by`` for groups
    whose own limit is below ``k``.
    """
    limit = F.lit(k) if cap is None else cap
    if k >= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        # Beyond this the optimizer drops the group limit, and a window would take each whole group into one task.
        counted = running_total(_counted(df, by, value), by, [F.col(value).desc()], _N)
        return counted.where(F.col(_BEFORE) < F.least(limit, F.lit(k))).groupBy(*by).agg(F.min(value).alias(out))
    largest = Window.partitionBy(*by).orderBy(F.col(value).desc())
    top = _counted(df, by, value).withColumn("_row", F.row_number().over(largest)).where(F.col("_row") <= k)
    upto = F.sum(_N).over(largest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return top.withColumn(_BEFORE, upto - F.col(_N)).where(F.col(_BEFORE) < limit).groupBy(*by).agg(
        F.min(value).alias(out)
    )


def exact_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Interpolated median of every column per group, as (by.., feature, median).

    All columns go through one job. Values are counted, range partitioned and
    written once. The row counts of the slices, one row per group and slice,
    tell which slices hold the middle; only these one or two are read again
    and numbered. Columns without any value in a group have no row.
    """
    typed = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    tall = typed.unpivot(list(by), list(cols), "feature", "value")
    keys = [*by, "feature"]
    counted = _counted(tall, keys, "value")
    slices = settle(counted.repartitionByRange(*keys, "value").withColumn(_SLICE, F.spark_partition_id()), "slices")
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy(*keys, _SLICE).agg(F.sum(_N).alias("_size")).select(
        *keys, _SLICE, "_size", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias(_OFFSET), F.sum("_size").over(whole).alias("_total"),
    ).withColumns({"_low": F.expr("(_total - 1) div 2"), "_high": F.expr("_total div 2")})
    middle = lambda place: (F.col(_OFFSET) <= F.col(place)) & (F.col(place) < F.col(_OFFSET) + F.col("_size"))
    # At most two rows per group, written so that the optimizer knows their size.
    wanted = settle(sizes.where(middle("_low") | middle("_high")).drop("_size", "_total"), "middles")
    local = Window.partitionBy(*keys, _SLICE).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = slices.join(wanted, [*keys, _SLICE]).withColumn("_upto", F.col(_OFFSET) + F.sum(_N).over(local))
    holds = lambda place: (F.col("_upto") - F.col(_N) <= F.col(place)) & (F.col(place) < F.col("_upto"))
    return numbered.where(holds("_low") | holds("_high")).groupBy(*keys).agg(
        ((F.max(F.when(holds("_low"), F.col("value"))) + F.max(F.when(holds("_high"), F.col("value")))) / 2).alias("median")
    )

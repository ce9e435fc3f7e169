"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Each source sends its documents in a shuffled order, again and again up to
``repeats`` times. A copy's virtual finish time is the number of words its
source has sent up to its end, divided by the source's target. All sources
reach their targets at virtual time 1, where the words sent make up the total
budget: there the globally sorted stream is cut, and a copy that is under way
counts with the words sent so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import count_words, query, table
from fieldtally.operators.ordering import running_total
from fieldtally.session import settle


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target): the budget is the sum of all sizes.

    Sources by code point, NULL last, get the weights in turn. No target is
    above ``repeats`` times its source's size; the excess goes to the other
    sources by weight until none is above. That end state is found directly:
    with the sources sorted by limit / weight, those before some point are at
    their limits and the rest share what is left by weight.

    One row per source is all this ever handles, so plain windows are enough.
    A table without rows gives no rows; without words, all targets are 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    limited = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))).withColumn(
        "limit", F.col("source_size") * repeats
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest, everything = (
        by_limit.rowsBetween(Window.unboundedPreceding, -1),
        by_limit.rowsBetween(0, Window.unboundedFollowing),
        by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
    )
    budget = F.sum("source_size").over(everything)
    left = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast("double")
    unit = left / F.sum("weight").over(rest)
    shared = limited.withColumn("unit", unit).withColumn("free", F.col("unit") * F.col("weight") <= F.col("limit"))
    level = F.first(F.when(F.col("free"), F.col("unit")), ignorenulls=True).over(everything)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return shared.select("source", "source_size", target.alias("target"))


def weighted_mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = (1, 2, 3),
    repeats: int = 3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document, range-sorted by the time at which the mix has it: doc_id, size, source_size, target,
    ``copies`` (array of pass, finish, taken), taken, and the columns named in ``keep`` as one struct ``row``.

    The shuffle is the order of md5(doc_id), so reruns agree. A hot source is
    summed in slices, never in one task. NULL ids are shuffled like an empty
    id; repeated rows are separate documents; a NULL source is a source; a
    document without words is never taken, and a source without words has
    target 0. Columns of ``docs`` that are not named play no part.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("shuffled"),
        *([F.struct(*keep).alias("row")] if keep else []),
    )
    sent = running_total(base, ["source"], [F.col("shuffled"), F.col("doc_id"), F.col("size")], "size", "before")
    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settle(source_targets(totals, weights, repeats).withColumnRenamed("source", "of"), "targets")
    joined = sent.join(targets, F.col("source").eqNullSafe(F.col("of")))

    def copy(k: int) -> Column:
        start = F.col("before") + F.col("source_size") * k
        taken = F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - start))
        finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target"))
        return F.struct(F.lit(k).alias("pass"), finish.alias("finish"), taken.alias("taken"))

    copies = F.filter(F.array(*[copy(k) for k in range(repeats)]), lambda c: c["taken"] > 0)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["taken"])
    mixed = joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies", *(["row"] if keep else []),
        F.try_element_at("copies", F.lit(1))["finish"].alias("finish"),
    )
    return mixed.repartitionByRange("finish", "doc_id").sortWithinPartitions("finish", "doc_id")


def mixed_documents(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The stream of the mix itself: ``docs`` with each document as often as it is taken, sorted by virtual finish time.

    A copy cut by the budget stays whole if at least half of its words were sent before the cut.
    """
    mixed = weighted_mix(docs, size, keep=docs.columns, **options)
    whole = mixed.select("row", "size", F.explode("copies").alias("copy")).where(F.col("copy.taken") * 2 >= F.col("size"))
    order = [F.col("copy.finish"), F.col("row").getField(options.get("doc_id", "doc_id")), F.col("copy.pass")]
    return whole.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS BIGINT) AS weight,
         source_size * 3 AS cap FROM totals),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM weighted),
level AS (SELECT arg_min(unit, cap / weight) AS level FROM levels WHERE unit * weight <= cap),
targets AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * level) AS target FROM levels, level),
sent AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sized)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, CAST(round(target) AS BIGINT) - before))
     + greatest(0, least(size, CAST(round(target) AS BIGINT) - before - source_size))
     + greatest(0, least(size, CAST(round(target) AS BIGINT) - before - 2 * source_size)) AS BIGINT) AS taken
FROM sent JOIN targets ON sent.source IS NOT DISTINCT FROM targets.source
"""


@query("op4_mixing", MIX_SQL)
def op4_mixing(spark, sf_dir):
    """All documents in the mix, with the words taken of each."""
    mixed = weighted_mix(table(spark, sf_dir, "documents"), count_words(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")

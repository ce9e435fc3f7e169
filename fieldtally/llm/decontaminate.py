"""Benchmark decontamination by spaced-seed hashing, with DataFrame operations only.

A seed mask picks six of eight neighbouring tokens. The two masks below hit
every run of 13 aligned tokens that has at most two substitutions, wherever
those fall (all 78 pairs of places were tried out). Hashes of the picked
tokens are joined between benchmark and documents, and each hit is verified
along its diagonal. Of 10 to 12 tokens they hit any with one substitution, and
from 8 on any without. An item of fewer than 8 tokens is one seed, the hash of
all its tokens.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.session import settle

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
#: From so many tokens on, an item is a passage that may lie anywhere in a document.
PASSAGE = 5


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _seed(words: Column, at: Column, mask: int) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(words, at + k) for k in MASKS[mask]])


def _seeds(docs: DataFrame, words: str) -> DataFrame:
    """One row per position and mask, with its hash ``seed`` and ``back``, the hash one token earlier (0 at the start)."""
    n = F.greatest(F.lit(0), F.size(words) - (SPAN - 1))
    # sequence() counts down when it ends below its start, so texts that are too short are cut first.
    rows = docs.where(F.size(words) >= SPAN).select("*", F.explode(F.sequence(F.lit(0), n * len(MASKS) - 1)).alias("seq"))
    at = rows.select("*", F.expr(f"seq div {len(MASKS)}").cast("int").alias("at"), (F.col("seq") % len(MASKS)).alias("mask"))
    pick = lambda shift: F.when(F.col("mask") == 0, _seed(F.col(words), F.col("at") - shift, 0)).otherwise(
        _seed(F.col(words), F.col("at") - shift, 1)
    )
    return at.drop("seq").withColumn("seed", pick(0)).withColumn("back", F.when(F.col("at") > 0, pick(1)).otherwise(F.lit(0)))


def _short_seeds(docs: DataFrame, words: str, lengths: Sequence[int]) -> DataFrame:
    """One row per run of as many tokens as a short item may have; below PASSAGE tokens, the run must be the whole text."""
    size = F.size(words)
    runs = lambda n: F.transform(F.sequence(F.lit(0), size - n), lambda at: F.struct(at.alias("at"), n.alias("n")))
    none = F.array().cast("array<struct<at:int,n:int>>")
    fits = lambda n: F.when((size == n) | ((size > n) & (n >= PASSAGE)), runs(n)).otherwise(none)
    rows = docs.select("*", F.explode(F.flatten(F.transform(F.array(*map(F.lit, lengths)), fits))).alias("run"))
    seed = F.xxhash64(-F.col("run.n"), F.slice(F.col(words), F.col("run.at") + 1, F.col("run.n")))
    return rows.select(*docs.columns, F.col("run.at").alias("at"), seed.alias("seed"), F.lit(0).cast("long").alias("back"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    substitutions: int = 2,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """doc_id, item_id, start, n_aligned, n_matched and best_window, one row for each document id and benchmark item that
    share a run of ``window`` aligned tokens with at most ``substitutions`` differing.

    Every item is looked for: one of 10 to window - 1 tokens must occur whole
    with at most one substitution, one of 5 to 9 tokens whole and unchanged,
    and an even shorter one, which is common speech inside other text, must be
    all that a document says. ``start`` is the token where the item's alignment
    begins in the document (negative if its head is missing). NULL and empty
    texts leak nothing; a document is worked on by row, so rows that share an
    id, or have none, never mix their texts; NULL ids stay NULL; repeated rows
    give one row; further columns play no part.

    The benchmark's hashes are broadcast while they are at most
    ``broadcast_rows`` (about 20 MB); beyond, both sides are shuffled by hash.
    """
    items = settle(
        benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("item_text")).distinct()
        .select("item_id", tokens(F.col("item_text")).alias("item_words")), "benchmark",
    )
    size = F.size("item_words")
    # At most SPAN - 1 lengths, whatever the benchmark holds. An item is matched by runs of its own length only.
    short = sorted(r.n for r in items.select(size.alias("n")).where(F.col("n").between(1, SPAN - 1)).distinct().collect())
    ways = [_seeds, *([lambda rows, of: _short_seeds(rows, of, short)] if short else [])]
    own = [_seeds(items, "item_words"), *[_short_seeds(items.where(size == n), "item_words", [n]) for n in short]]
    tests = settle(reduce(DataFrame.union, [
        rows.select("item_id", "seed", "back", F.col("at").alias("item_at"), size.alias("n_item")) for rows in own
    ]).distinct(), "seeds")
    test = tests.select("item_id", "item_at", "n_item", F.col("seed").alias("t_seed"), F.col("back").alias("t_back"))
    words = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    # Two hashes of the tokens stand for a row in the shuffle; rows of equal tokens and id find the same.
    words_of = lambda: words.withColumn("row", F.struct("doc_id", F.xxhash64("words").alias("a"), F.hash("words").alias("b")))
    # Where the token before fits too, the run was already hit there: only starts of runs go on.
    starts = (F.col("seed") == F.col("t_seed")) & ((F.col("back") != F.col("t_back")) | (F.col("back") == 0))
    first = F.col("at") - F.col("item_at")
    aligned = lambda doc_words: F.transform(
        F.sequence(F.lit(0), F.col("n_item") - 1), lambda k: F.when(first + k >= 0, F.get(doc_words, first + k))
    )
    if tests.count() <= broadcast_rows:
        # Each way joins before the union: its rows with whole texts are never kept.
        hits = reduce(DataFrame.union, [
            way(words, "words").join(F.broadcast(test), starts).select("doc_id", "item_id", first.alias("start"), aligned(F.col("words")).alias("facing"))
            for way in ways
        ])
    else:
        places = reduce(DataFrame.union, [way(words_of(), "words").select("row", "at", "seed", "back") for way in ways])
        found = places.join(test, starts).groupBy("row").agg(F.collect_set(F.struct("item_id", "n_item", first.alias("start"))).alias("found"))
        texts = words_of().withColumnRenamed("row", "own")
        met = texts.join(found, F.col("own").eqNullSafe(F.col("row"))).select("doc_id", "words", F.inline("found"))
        facing = F.transform(
            F.sequence(F.lit(0), F.col("n_item") - 1), lambda k: F.when(F.col("start") + k >= 0, F.get(F.col("words"), F.col("start") + k))
        )
        hits = met.select("doc_id", "item_id", "start", facing.alias("facing"))
    # At most a few rows per document and item from here on.
    named = items.withColumnRenamed("item_id", "of_item")
    pairs = hits.distinct().join(named, F.col("item_id").eqNullSafe(F.col("of_item"))).select(
        "doc_id", "item_id", "start",
        F.zip_with("facing", "item_words", lambda a, b: F.when(a == b, 1).otherwise(0)).alias("same"),
        F.size(F.filter("facing", lambda w: w.isNotNull())).alias("n_aligned"),
    )
    n = F.size("same")
    span = F.least(n, F.lit(window))
    best = F.array_max(
        F.transform(F.sequence(F.lit(1), n - span + 1), lambda i: F.aggregate(F.slice("same", i, span), F.lit(0), lambda a, v: a + v))
    )
    judged = pairs.select(
        "doc_id", "item_id", "start", "n_aligned", F.aggregate("same", F.lit(0), lambda a, v: a + v).alias("n_matched"),
        best.alias("best_window"), (span - F.when(n >= window, substitutions).when(n >= 10, min(1, substitutions)).otherwise(0)).alias("needed"),
    ).where(F.col("best_window") >= F.col("needed"))
    top = F.max(F.struct("n_matched", "best_window", "n_aligned", "start"))
    return judged.groupBy("doc_id", "item_id").agg(top.alias("top")).select(
        "doc_id", "item_id", "top.start", "top.n_aligned", "top.n_matched", "top.best_window"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item."""
    bad = settle(leaks(docs, benchmark, doc_id=doc_id, **options).select(F.col("doc_id").alias("__leaks")).distinct(), "leaks")
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["__leaks"]), "left_anti")


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    """Every document of the whole table that leaks a benchmark item, with the item and its place."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

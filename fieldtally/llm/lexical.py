"""Ranked lexical search for a set of items, with documents that can't be told apart scored once.

Only the items' terms matter for a score, and of a document's length only the
integer ``m``. So a document is cut down to its term frequencies over the
items' vocabulary and to ``m``; documents whose hash and then whose frequencies
and ``m`` are the same form a class. A class is scored once, and as no result
can hold more than ``k`` of its members, it keeps its ``k`` smallest ids.

Items are taken in blocks with a bounded number of (item, term) entries; all
documents are read once a block, however many items there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import sliced
from fieldtally.session import settle

TOP = 10
#: (item, term) entries of one block of items: what its tasks receive.
BLOCK_TERMS = 200_000
#: Scores a task holds at once.
_CELLS = 1_000_000

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """The terms of a text in order, A to Z in lower case; NULL has none."""
    return F.regexp_extract_all(F.coalesce(F.translate(text, _UPPER, _LOWER), F.lit("")), F.lit(TERM), F.lit(0))


def term_vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (all terms), and the places in ``vocabulary`` with their frequencies, of (doc_id, text)."""
    place = {term.encode(): i for i, term in enumerate(vocabulary)}

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # In UTF-8, the bytes from 0x80 on belong to the characters beyond ASCII, which are all part of terms.
        found = re.compile(rb"[0-9a-z\x80-\xff]+").findall
        for frame, texts in sliced(frames):
            n, at, tf = [], [], []
            for text in texts:
                all_terms = found(text.lower())
                held = sorted((place[t], k) for t, k in Counter(all_terms).items() if t in place)
                n.append(len(all_terms))
                at.append([p for p, _ in held])
                tf.append([k for _, k in held])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "named": frame["named"], "n": n, "at": at, "tf": tf})

    named = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text")
    return named.mapInPandas(part, "doc_id long, named boolean, n long, at array<int>, tf array<long>")


def classes(vectors: DataFrame, n_docs: int, n_terms: int, k: int = TOP) -> DataFrame:
    """m, at, tf and the ``k`` smallest members (named first) of every class of documents with a term of the vocabulary."""
    # In 64-bit integers; an overflow is an error, not a wrong score.
    m = F.lit(100 - 90) + F.expr(f"(90L * n * {n_docs}L) div {n_terms}L")
    rows = vectors.where(F.size("at") > 0).select(m.alias("m"), "at", "tf", "doc_id", "named")
    marked = rows.withColumn("mark", F.xxhash64("m", "at", "tf"))
    same = ["mark", "m", "at", "tf"]
    # The limit by group runs before the shuffle too, so a class of any size sends k rows a task.
    first = Window.partitionBy(*same).orderBy(F.desc("named"), "doc_id")
    kept = marked.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= k)
    members = F.array_sort(F.collect_list(F.struct((~F.col("named")).alias("unnamed"), "doc_id")))
    return kept.groupBy(*same).agg(members.alias("members")).select(
        "m", "at", "tf", F.col("members.doc_id").alias("ids"), F.col("members.unnamed").alias("unnamed"))


def _scored(found: DataFrame, holders: list[list[int]], weight: list[int], n_items: int, k: int) -> DataFrame:
    """item (its number), score, doc_id and named: a task's ``k`` best documents of every item."""
    step = max(16, min(2048, _CELLS // n_items))

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items_of = [np.array(h, np.int64) for h in holders]
        weights = np.array(weight, np.int64)
        floor = np.ones(n_items, np.int64)  # a document below this score has k better ones already
        best = [np.empty(0, np.int64) for _ in range(4)]  # item, score, unnamed, id
        for frame in frames:
            for begin in range(0, len(frame), step):
                piece = frame.iloc[begin : begin + step]
                size = piece["at"].map(len).to_numpy()
                at, tf = np.concatenate(piece["at"].to_numpy()), np.concatenate(piece["tf"].to_numpy())
                row = np.repeat(np.arange(len(piece)), size)
                part_score = weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * piece["m"].to_numpy()[row]))
                order = np.argsort(at, kind="stable")
                at, row, part_score = at[order], row[order], part_score[order]
                edges = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]), len(at)]
                score = np.zeros((n_items, len(piece)), np.int64)
                for lo, hi in zip(edges[:-1], edges[1:]):
                    score[np.ix_(items_of[at[lo]], row[lo:hi])] += part_score[lo:hi]
                item, place = np.nonzero(score >= floor[:, None])
                if not len(item):
                    continue
                value = score[item, place]
                ids, unnamed = piece["ids"].to_numpy(), piece["unnamed"].to_numpy()
                head = np.array([i[0] for i in ids]), np.array([u[0] for u in unnamed])
                # The k best documents of an item lie in the k classes first by score, then by smallest member.
                first = _first(k, item, (head[0][place], head[1][place], -value))
                item, place, value = item[first], place[first], value[first]
                many = np.array([len(ids[p]) for p in place], np.int64)
                fresh = [np.repeat(item, many), np.repeat(value, many), np.concatenate([unnamed[p] for p in place]).astype(np.int64), np.concatenate([ids[p] for p in place])]
                best = [np.concatenate([a, b]) for a, b in zip(best, fresh)]
                first = _first(k, best[0], (best[3], best[2], -best[1]))
                best = [x[first] for x in best]
                full = np.bincount(best[0], minlength=n_items) >= k
                lowest = np.full(n_items, np.iinfo(np.int64).max)
                np.minimum.at(lowest, best[0], best[1])
                floor = np.where(full, lowest, 1)
        if len(best[0]):
            yield pd.DataFrame({"item": best[0], "score": best[1], "doc_id": best[3], "named": best[2] == 0})

    return found.mapInPandas(part, "item long, score long, doc_id long, named boolean")


def _first(k: int, group: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Places of the first ``k`` of every group in the order of ``keys`` (the last key counts most)."""
    order = np.lexsort((*keys, group))
    sorted_group = group[order]
    start = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    turn = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[turn < k]


def lexical_top(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents with a score above 0, ties by ascending id.

    The terms of rows that share an item id are taken together. Documents that
    repeat an id rank one by one; those without an id come after others of the
    same score. NULL and empty texts, of items or documents, have no terms and
    yield nothing; further columns play no part. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    entries = settle(items.select(F.col(item_id).alias("item_id"), F.explode(terms(F.col(item_text))).alias("term")).distinct(), "item-terms")
    blocks = -(-entries.count() // block_terms)
    parts = []
    for block in range(blocks):
        mine = entries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        vocabulary = sorted({t for row in mine for t in row["terms"]})
        if not vocabulary:
            continue
        place = {t: i for i, t in enumerate(vocabulary)}
        holders: list[list[int]] = [[] for _ in vocabulary]
        for number, row in enumerate(mine):
            for t in row["terms"]:
                holders[place[t]].append(number)
        vectors = settle(term_vectors(rows, vocabulary), "term-vectors")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        # At most one row for each term of the block.
        held = {r["p"]: r["df"] for r in vectors.select(F.explode("at").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("df")).collect()}
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))]
        scored = _scored(classes(vectors, n_docs, n_terms, k), holders, weight, len(mine), k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], f"item long, item_id {entries.schema['item_id'].dataType.simpleString()}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.desc("named"), "doc_id")
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        # Bounded like the block itself.
        parts.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), "score"))
    if not parts:
        return entries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    return reduce(DataFrame.union, parts)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') AS ts FROM documents),
     size AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d),
     tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
            FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY r, term),
     w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term FROM benchmark),
     s AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM i JOIN tf USING (term) JOIN w USING (term), size GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""


@query("op13_lexical", SQL)
def op13_lexical(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return lexical_top(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

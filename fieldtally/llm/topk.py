"""Exact top-k by integer inner product over an impact-ordered index, score at a time.

Vectors are cut into blocks. A block's index lists its postings (vector,
dimension) in descending order of impact, the quantised absolute component; a
segment holds the postings of equal impact. All queries of a task go through a
block together: the segments down to some impact are added to the scores in
one matrix product. What is still unread of a dimension is at most its largest
component beyond, which bounds every score from both sides. A query is done
with a block once no more vectors can reach its threshold than are worth
rescoring, and these are rescored exactly. The threshold is the k-th best
lower bound in the block, or the k-th best score of the blocks before it if
that is higher.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.session import settle

#: Vectors per block of the index, blocks and queries that meet in one task.
BLOCK, BLOCKS, QUERIES = 2048, 4, 512
#: A segment holds components that differ by less than this.
STEP = 1
#: A block is rescored when no more vectors are left than this per wanted result, or than this part of the block.
RESCORE, RESCORE_SHARE = 8, 32
#: Shares of the postings after which the bounds are looked at.
ROUNDS = (0.95, 1.0)


def quantised(vector: Column) -> Column:
    """Components as floor(256 x); NULL for vectors that are NULL or hold NULL or non-finite components."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(as_double, lambda x: F.floor(x * 256).cast("long")))


def impact_order(x: np.ndarray) -> np.ndarray:
    """Places of the postings in ``x`` (vectors by dimensions, row by row), highest impact first."""
    return np.argsort(-(np.abs(x) // STEP).ravel(), kind="stable").astype(np.int32)


class ImpactIndex:
    """Impact-ordered postings of a block, cut into ranges of whole segments."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, order: np.ndarray):
        self.ids, self.x = ids, x
        impact = np.abs(x).ravel()[order] // STEP
        cuts = sorted({int(np.searchsorted(-impact, -impact[max(0, int(np.ceil(len(order) * share)) - 1)], "right")) for share in ROUNDS})
        self.most = float(np.abs(x).max(initial=0))
        # Single precision where no product overflows; the bounds leave room for its rounding.
        kind = np.float32 if self.most < 1e15 else np.float64
        self.rounding = (x.shape[1] + 4) * (2 * np.finfo(kind).eps)
        unread = np.abs(x).astype(float)
        self.ranges, done = [], 0
        for cut in cuts:
            here = np.zeros(x.size, kind)
            here[order[done:cut]] = x.ravel()[order[done:cut]]
            unread.ravel()[order[done:cut]] = 0.0
            # One range's postings as a matrix, and the most that any posting after it holds, by dimension.
            self.ranges.append((np.ascontiguousarray(here.reshape(x.shape).T), unread.max(0)))
            done = cut

    def top(self, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows and scores of its ``k`` best vectors with a score of at least ``floor``: higher scores
        first, then smaller ids. Vectors with the query's ``own`` id are left out."""
        n, kind = len(self.x), self.ranges[0][0].dtype
        out = [(np.empty(0, np.int64),) * 2] * len(q)
        force, asked = np.abs(q).astype(float), q.astype(kind)
        slack = self.rounding * force.sum(1) * self.most
        where = np.searchsorted(self.ids, own)
        open_, score = np.arange(len(q)), np.zeros((len(q), n), kind)
        for i, id_ in enumerate(own):  # ids ascend, so a query's own rows are neighbours
            score[i, where[i] : np.searchsorted(self.ids, id_, "right")] = -np.inf
        for turn, (part, unread) in enumerate(self.ranges):
            score += asked[open_] @ part
            reach = force[open_] @ unread + slack[open_]
            # Without a threshold from blocks before, the k-th best lower bound of this one.
            threshold = floor[open_].astype(float)
            new = np.flatnonzero(np.isneginf(threshold))
            if len(new) and n >= k:
                threshold[new] = np.partition(score[new], n - k, axis=1)[:, n - k].astype(float) - reach[new]
            threshold = np.maximum(threshold - reach, np.finfo(kind).min)
            possible = score >= threshold.astype(kind)[:, None]
            few = possible.sum(1) <= max(k * RESCORE, n // RESCORE_SHARE)
            if turn == len(self.ranges) - 1:
                few[:] = True
            done = np.flatnonzero(few)
            place, rows = np.nonzero(possible[done])
            for i, rows in zip(open_[done], np.split(rows, np.searchsorted(place, np.arange(1, len(done))))):
                exact = self.x[rows] @ q[i]
                if len(rows) > 4 * k:
                    good = np.flatnonzero(exact >= np.partition(exact, len(rows) - k)[len(rows) - k])
                    rows, exact = rows[good], exact[good]
                best = np.lexsort((self.ids[rows], -exact))[:k]
                out[i] = rows[best], exact[best]
            open_, score = open_[~few], score[~few]
            if not len(open_):
                break
        return out


def _packed(rows: DataFrame, blocks: DataFrame, kind: str) -> DataFrame:
    """Blocks of vectors (width, block, ids, xs, places): ids, components and impact order as packed numbers."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        x = np.stack(frame["x"].to_numpy()).astype(np.int64)
        return pd.DataFrame({
            "width": [int(frame["width"].iloc[0])], "block": [int(frame["block"].iloc[0])],
            "ids": [frame["id"].to_numpy(np.int64).tobytes()], "xs": [x.tobytes()], "places": [impact_order(x).tobytes()],
        })

    dealt = rows.join(blocks, "width").withColumn("block", F.pmod(F.xxhash64("id", "x"), F.col(kind)))
    return dealt.select("width", "block", "id", "x").groupBy("width", "block").applyInPandas(
        pack, "width int, block long, ids binary, xs binary, places binary")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best vectors of every query, but for those of its own id.

    Some blocks of vectors and some queries meet in a task, so nothing is
    broadcast and no task holds more. Ties go to the smaller id. Vectors and
    queries without id, NULL, empty, or with NULL or non-finite components
    take no part; a vector only meets queries of its own length. Repeated rows
    are vectors of their own, and queries of their own: each has its ranks.
    Further columns play no part.
    """
    clean = lambda df: settle(
        df.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("x"))
        .where("id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
        .select("id", "x", F.size("x").alias("width"), F.monotonically_increasing_id().alias("row")),
        "vectors",
    )
    v, q = clean(vectors), clean(queries)
    ceiling = lambda n, size: F.ceil(F.col(n) / size).cast("long")
    sizes = v.groupBy("width").agg(F.count(F.lit(1)).alias("n")).join(q.groupBy("width").agg(F.count(F.lit(1)).alias("m")), "width")
    plan = settle(sizes.select("width", ceiling("n", block).alias("v_blocks"), ceiling("n", block * BLOCKS).alias("v_groups"), ceiling("m", QUERIES).alias("q_groups")), "plan")
    cells = plan.agg(F.sum(F.col("v_groups") * F.col("q_groups"))).first()[0]
    if not cells:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = settle(_packed(v.select("id", "x", "width"), plan.select("width", "v_blocks"), "v_blocks"), "index")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # The stated query set against all rows: every group of queries meets every group of blocks of its length.
    asked = q.join(plan, "width").withColumn("q_group", F.pmod(F.xxhash64("row"), F.col("q_groups"))).withColumn("v_group", up_to("v_groups"))
    held = index.join(plan, "width").withColumn("v_group", F.pmod(F.col("block"), F.col("v_groups"))).withColumn("q_group", up_to("q_groups"))
    cell = ["width", "q_group", "v_group"]

    def answer(asking: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(blocks):
            width = int(asking["width"].iloc[0])
            x, own, rows = np.stack(asking["x"].to_numpy()).astype(np.int64), asking["id"].to_numpy(np.int64), asking["row"].to_numpy(np.int64)
            # The scores of a query's k best so far; the k-th of them is its threshold for the blocks to come.
            kept = np.full((len(x), k), -np.inf)
            for ids, xs, places in zip(*(blocks.sort_values("block")[c] for c in ("ids", "xs", "places"))):
                index = ImpactIndex(np.frombuffer(ids, np.int64), np.frombuffer(xs, np.int64).reshape(-1, width), np.frombuffer(places, np.int32))
                for i, (at, score) in enumerate(index.top(x, own, k, kept.min(1))):
                    if len(at):
                        found.append((np.full(len(at), rows[i]), np.full(len(at), own[i]), index.ids[at], score))
                        kept[i] = np.sort(np.r_[kept[i], score])[-k:]
        parts = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        # Of what the blocks gave, only the best of the task go on.
        order = np.lexsort((parts[2], -parts[3], parts[0]))
        parts = [c[order] for c in parts]
        starts = np.flatnonzero(np.r_[True, parts[0][1:] != parts[0][:-1]]) if len(order) else np.empty(0, np.int64)
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        return pd.DataFrame({name: c[place < k] for name, c in zip(("row", "query_id", "vec_id", "score"), parts)})

    # Few rows, much work for each: the number of tasks follows the number of cells.
    dealt = lambda df, *cols: df.select(*cell, *cols).repartition(int(cells), *cell).groupBy(*cell)
    partial = dealt(asked, "row", "id", "x").cogroup(dealt(held, "block", "ids", "xs", "places")).applyInPandas(
        answer, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(v.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op6_topk", TOP_SQL)
def op6_topk(spark, sf_dir):
    """The five best vectors for every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))

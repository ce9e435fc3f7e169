"""Quality classifier: random-indexing word vectors pooled per document, then a small calibrated network.

Tokens are runs of letters and digits, or of symbols. A token's vector is the
sum, over all its occurrences in the corpus, of fixed sparse index vectors of
its neighbours. Tokens share a fixed number of hashed rows, so the table of
vectors has the same size for any corpus: it may be summed, collected and
broadcast. Its entries are whole numbers, so no order of summing changes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import RUNS, Tokens, mix, sliced
from fieldtally.session import settle

ROWS, DIM, REACH, NONZERO = 1 << 14, 32, 2, 2
#: Labelled rows that are fitted at most: those first by md5 of their id.
FIT_ROWS = 20_000
#: Rows that are scored at this or more are taken as good.
ACCEPT = 0.3


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the few entries of each row's index vector."""
    seeds = mix(np.arange(ROWS * NONZERO, dtype=np.uint64) + np.uint64(0x51ED2701)).reshape(ROWS, NONZERO)
    return (seeds % np.uint64(DIM)).astype(np.int64), np.where(seeds >> np.uint64(63), 1.0, -1.0)


def _rows_of(tokens: Tokens) -> np.ndarray:
    return (tokens.h & np.uint64(ROWS - 1)).astype(np.int64)


def context_sums(docs: DataFrame, text: str = "text") -> DataFrame:
    """row, n and v0 .. v31 summed over the whole corpus: at most ROWS rows."""
    columns = ["row", "n", *[f"v{i}" for i in range(DIM)]]

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = _index_vectors()
        sums, n = np.zeros(ROWS * DIM), np.zeros(ROWS, np.int64)
        for _, texts in sliced(frames, text):
            tokens = Tokens(texts, RUNS)
            row, of = _rows_of(tokens), tokens.text_of()
            n += np.bincount(row, minlength=ROWS)
            for far in range(1, REACH + 1):
                if len(row) <= far:
                    break
                near = of[:-far] == of[far:]
                left, right = row[:-far][near], row[far:][near]
                for j in range(NONZERO):
                    # A neighbour's entries are turned by its distance, so that order counts.
                    for own, other, turn in ((left, right, far), (right, left, -far)):
                        at = own * DIM + (places[other, j] + turn) % DIM
                        sums += np.bincount(at, weights=signs[other, j], minlength=ROWS * DIM)
        seen = np.flatnonzero(n)
        if len(seen):
            v = np.rint(sums.reshape(ROWS, DIM)[seen]).astype(np.int64)
            yield pd.DataFrame(np.column_stack([seen, n[seen], v]), columns=columns)

    parts = docs.select(text).mapInPandas(part, ", ".join(f"{c} long" for c in columns))
    return parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns[1:]])


def word_vectors(sums: pd.DataFrame) -> np.ndarray:
    """Unit vectors, damped for frequent rows; rows that never occur are zero."""
    out = np.zeros((ROWS, DIM), np.float32)
    if len(sums):
        v = sums[[f"v{i}" for i in range(DIM)]].to_numpy(float)
        length = np.sqrt((v * v).sum(1, keepdims=True))
        share = sums["n"].to_numpy(float) / sums["n"].sum()
        out[sums["row"].to_numpy(int)] = v / np.maximum(length, 1e-9) * (1e-2 / (1e-2 + share))[:, None]
    return out


FEATURES = 3 * DIM


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Per text: mean vector, mean square, and mean product of neighbouring tokens' vectors; zeros without tokens."""
    tokens = Tokens(texts, RUNS)
    out = np.zeros((len(texts), FEATURES), np.float32)
    if not len(tokens):
        return out
    v = vectors[_rows_of(tokens)]
    full = np.flatnonzero(np.diff(tokens.bounds))
    first, n = tokens.bounds[:-1][full], np.diff(tokens.bounds)[full][:, None]
    out[full, :DIM] = np.add.reduceat(v, first) / n
    out[full, DIM : 2 * DIM] = np.add.reduceat(v * v, first) / n
    v[:-1] *= v[1:]
    v[tokens.bounds[1:][full] - 1] = 0
    out[full, 2 * DIM :] = np.add.reduceat(v, first) / n
    return out


@dataclass
class Network:
    """One hidden layer; ``temperature`` divides the logit."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 30, batch: int = 256, l2: float = 1e-4) -> Network:
    """Fit by Adam with fixed seed; the temperature on every seventh row, which the weights never see.

    Without rows, or with one label only, the network says the labels' share
    (0.5 without rows), smoothed by one row of either label.
    """
    x, y = x.astype(float), y.astype(float)
    shift, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    rng = np.random.Generator(np.random.PCG64(7))
    w1 = rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden))
    net = Network(shift, scale, w1, np.zeros(hidden), np.zeros(hidden), 0.0)
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        net.b2 = float(np.log(share / (1 - share)))
        return net
    aside = np.arange(len(x)) % 7 == 6
    z, t = ((x - shift) / scale)[~aside], y[~aside]
    params = [net.w1, net.b1, rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, s, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order, rate = rng.permutation(len(z)), 3e-3 * (1 - epoch / epochs)
        for k in range(0, len(z), batch):
            i = order[k : k + batch]
            a = np.tanh(z[i] @ params[0] + params[1])
            e = (1 / (1 + np.exp(-np.clip(a @ params[2] + params[3][0], -30, 30))) - t[i]) / len(i)
            back = np.outer(e, params[2]) * (1 - a * a)
            grads = [z[i].T @ back + l2 * params[0], back.sum(0), a.T @ e + l2 * params[2], np.array([e.sum()])]
            step += 1
            for p, g, mm, ss in zip(params, grads, m, s):
                mm += 0.1 * (g - mm)
                ss += 0.001 * (g * g - ss)
                p -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(ss / (1 - 0.999**step)) + 1e-8)
    net = Network(shift, scale, params[0], params[1], params[2], float(params[3][0]))
    check = aside if len(np.unique(y[aside])) == 2 else ~aside
    logit = np.clip(net.logit(x[check]), -60, 60)
    loss = lambda c: np.logaddexp(0, np.where(y[check] > 0, -logit, logit) / c).mean()
    net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= 0.3) of every row.

    Only the text is scored. NULL and empty texts, or texts of white space,
    score 0. Rows without id count as held out; repeated rows get equal
    scores; labels that are NULL or whose id is unknown are not learnt.
    """
    sums = context_sums(docs, text).toPandas()  # ROWS rows at most, for any corpus
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(sums))

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, texts in sliced(frames, "text", 1_000_000):
            x = pooled(texts, vectors.value)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "x": list(x), "empty": ~x.any(1)})

    kind = docs.schema[doc_id].dataType.simpleString()
    features = settle(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
            featured, f"doc_id {kind}, x array<float>, empty boolean"
        ), "pooled",
    )
    known = labels.select(F.col(doc_id).alias("l_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("l_id").isNotNull() & ~held_out(F.col("l_id"))).distinct()
    order = [F.md5(F.col("l_id").cast("string")), F.col("l_id"), F.col("y"), F.col("x")]
    # The first FIT_ROWS by hash: a threshold keeps few more, so tasks don't each send as many to the driver.
    share = min(1.0, 1.5 * FIT_ROWS / max(1, known.count()))
    drawn = known.where(F.conv(F.substring(F.md5(F.col("l_id").cast("string")), 1, 8), 16, 10).cast("long") < int(share * 2**32))
    fit = drawn.join(features.where(~F.col("empty")), F.col("l_id") == F.col("doc_id")).orderBy(*order).limit(FIT_ROWS).select("x", "y").toPandas()
    x = np.array(fit["x"].tolist(), np.float32).reshape(len(fit), FEATURES)
    net = fit_network(x, fit["y"].to_numpy())

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            s = net.score(np.array(frame["x"].tolist(), np.float32).reshape(len(frame), FEATURES).astype(float))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": np.where(frame["empty"], 0.0, s)})

    return features.mapInPandas(score, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those whose text the classifier rejects."""
    bad = scored(docs, labels, doc_id, **options).where("predicted = 0").select(F.col("doc_id").alias("__rejected")).distinct()
    bad = settle(bad, "rejected")
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["__rejected"]), "left_anti")


@query("op8_quality")
def op8_quality(spark, sf_dir):
    """Score of every document, learnt from the labels of the rows that are not held out."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

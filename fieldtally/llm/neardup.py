"""Near-duplicate documents by BagMinHash signatures of their five-word shingles.

A shingle that occurs w times stands for w units of height. On each interval
[0, 1), [1, 2), [2, 4), [4, 8) .. of heights runs a Poisson process of its own,
seeded by shingle and interval; a point beyond w is thinned out. Each point
falls on one component, which keeps its earliest point. Two documents agree in
a component with a probability that is exactly their weighted Jaccard
similarity (Ertl, 2018). A process stops as soon as it has passed the latest
component of its document.

40 bands of 7 components propose candidates: a pair at similarity 0.8 shares
a band with probability 0.9999. Every candidate is verified on the texts, or
ruled out by what is known of both: each member of a bucket whose documents
are not one class yet is compared with the bucket's hub, the member with most
company. With x = hub + (what x adds) - (what x lacks), the shared part of x
and y is exact: hub - lacks(x) - lacks(y) + what they add or lack alike. So x
and y are similar only if they add and lack enough alike, and bitmaps of what
each adds and lacks bound that from above. No pair that could be similar is
passed over, and no bucket is dropped, cut or taken apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import Tokens, mix, run_inside, runs
from fieldtally.session import settle

SHINGLE, BANDS, BAND_ROWS, SIMILAR = 5, 40, 7, 0.8
#: Words of the bitmap of what a document adds to its hub or lacks of it.
WORDS_64 = 8
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, Tokens]:
    """(text number, hash) of every run of n words; a text of fewer words is one shingle, one without words none."""
    tokens = Tokens(texts)
    hashes, of = runs(tokens.h, n), tokens.text_of()
    inside = run_inside(tokens.bounds, n, len(tokens))
    count = np.diff(tokens.bounds)
    short = np.flatnonzero((count > 0) & (count < n))
    alone = np.array([runs(tokens.h[tokens.bounds[i] : tokens.bounds[i + 1]], count[i])[0] for i in short], np.uint64)
    return np.concatenate([of[: len(hashes)][inside], short]), np.concatenate([hashes[inside], alone]), tokens


def counted(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) in order, with their counts."""
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.empty(0, int)
    return of[first], h[first], np.diff(np.r_[first, len(h)])


def bag_minhash(of: np.ndarray, h: np.ndarray, weight: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """Signatures (n_texts x size) as the times of the earliest points; infinite for texts without shingles."""
    best = np.full(n_texts * size, np.inf)
    # One process per shingle and interval of heights that its weight reaches.
    levels = np.frexp(np.maximum(weight - 1, 0).astype(float))[1] + 1
    at = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.maximum(low, 1.0)
    doc, top = of[at], weight[at]
    seed = mix(h[at] + mix(level.astype(np.uint64) + np.uint64(1)))
    time, turn = np.zeros(len(at)), 0
    latest = np.full(n_texts, np.inf)
    while len(at):
        draws = 1 if len(doc) > 20_000 else 16
        steps = (np.uint64(turn) + np.arange(1, draws + 1, dtype=np.uint64)) * _GOLD
        bits = mix(seed[:, None] + steps)
        gap = -np.log((bits >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / length[:, None]
        when = time[:, None] + np.cumsum(gap, 1)
        other = mix(bits ^ _GOLD)
        slot = doc[:, None] * size + (other % np.uint64(size)).astype(np.int64)
        high = low[:, None] + (other >> np.uint64(40)).astype(float) * 2.0**-24 * length[:, None] < top[:, None]
        np.minimum.at(best, slot[high], when[high])
        turn += draws
        time = when[:, -1]
        live = np.unique(doc)
        latest[live] = best.reshape(n_texts, size)[live].max(1)
        on = time < latest[doc]
        doc, top, seed, time, low, length = doc[on], top[on], seed[on], time[on], low[on], length[on]
        at = doc
    return best.reshape(n_texts, size)


Bag = tuple[np.ndarray, np.ndarray]


def bags(texts: list[bytes]) -> list[Bag]:
    """Distinct shingles and their counts, in order, of each text."""
    of, h, _ = shingles(texts)
    of, h, w = counted(of, h)
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    return [(h[a:b], w[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def similarity(a: Bag, b: Bag) -> float:
    """Multiset Jaccard similarity."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][left], b[1][right]).sum()
    return float(shared / max(1, a[1].sum() + b[1].sum() - shared))


def weighted_jaccard(a: bytes, b: bytes) -> float:
    """Multiset Jaccard similarity of the shingles of two texts."""
    return similarity(*bags([a, b]))


def difference(hub: Bag, bag: Bag) -> tuple[int, int, np.ndarray]:
    """What ``bag`` lacks of ``hub`` and adds to it, as counts, and a bitmap of both."""
    _, left, right = np.intersect1d(hub[0], bag[0], assume_unique=True, return_indices=True)
    lacks, adds = hub[1].copy(), bag[1].copy()
    both = np.minimum(hub[1][left], bag[1][right])
    lacks[left] -= both
    adds[right] -= both
    marks = np.concatenate([mix(hub[0][lacks > 0]), mix(bag[0][adds > 0] + _GOLD)])
    flags = np.zeros(64 * WORDS_64, bool)
    flags[marks % np.uint64(len(flags))] = True
    return int(lacks.sum()), int(adds.sum()), np.packbits(flags).view(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], *texts: str, limit: int = 1_000_000) -> Iterator[tuple]:
    """Cut Arrow batches so that the texts of a piece have about ``limit`` bytes (more only if one row has); yields the
    piece and its texts as UTF-8. Only a piece's texts become Python objects, whatever the batch holds."""
    for batch in batches:
        columns = [batch.column(c).cast(pa.binary()) for c in texts]
        size = np.cumsum(sum(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)) // limit
        edges = np.r_[np.flatnonzero(np.r_[True, size[1:] != size[:-1]]), len(size)] if len(size) else []
        for lo, hi in zip(edges[:-1], edges[1:]):
            yield batch.slice(lo, hi - lo), *[c.slice(lo, hi - lo).to_pylist() for c in columns]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def signatures(docs: DataFrame) -> DataFrame:
    """mark, id, k1 and k2 (hash of the word sequence), n (shingles) and bands (empty without words) of (mark, id, text)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = BANDS * BAND_ROWS
        for piece, texts in _pieces(batches, "text"):
            of, h, tokens = shingles(texts)
            times = bag_minhash(*counted(of, h), len(texts), size).view(np.uint64).reshape(len(texts), BANDS, BAND_ROWS)
            bands = np.tile(mix(np.arange(BANDS, dtype=np.uint64)), (len(texts), 1))
            for k in range(BAND_ROWS):
                bands = mix(bands * np.uint64(0x9FB21C651E98DF25) + times[:, :, k])
            n = np.bincount(of, minlength=len(texts))
            place = mix(np.arange(len(tokens), dtype=np.uint64) - np.repeat(tokens.bounds[:-1], np.diff(tokens.bounds)).astype(np.uint64))
            total = lambda x: np.diff(np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)][tokens.bounds])
            keys = [mix(total(mix(tokens.h + place))), mix(total(mix(tokens.h * np.uint64(3) ^ place)))]
            ends = np.r_[0, np.cumsum(np.where(n > 0, BANDS, 0))].astype(np.int32)
            yield _batch(
                mark=piece.column("mark"), id=piece.column("id"), k1=keys[0].view(np.int64), k2=keys[1].view(np.int64), n=n.astype(np.int64),
                bands=pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[n > 0].view(np.int64).ravel())),
            )

    return docs.mapInArrow(part, "mark binary, id long, k1 long, k2 long, n long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Those of the distinct pairs (a, b, n_a, n_b) whose texts are similar, as (a, b)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, a, b in _pieces(batches, "t_a", "t_b"):
            found = bags(a + b)
            yes = pa.array([similarity(x, y) >= similar for x, y in zip(found, found[len(a) :])])
            yield _batch(a=piece.column("a").filter(yes), b=piece.column("b").filter(yes))

    # The smaller bag must hold this share of the larger one.
    able = pairs.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (similar - 1e-9)).select("a", "b").distinct()
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t_{c}"))
    return settle(able.join(side("a"), "a").join(side("b"), "b").mapInArrow(part, "a long, b long"), "links")


def _from_hubs(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """hub, id, n, size (of the hub), mass and cost of the difference, and its bitmap, of the distinct (hub, id, n)."""
    part_of = similar / (1 + similar)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, hubs, members in _pieces(batches, "t_a", "t_b"):
            found = bags(hubs + members)
            rows = [difference(*pair) for pair in zip(found, found[len(hubs) :])]
            lacks, adds = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
            bits = np.stack([r[2] for r in rows])
            yield _batch(
                hub=piece.column("a"), id=piece.column("b"), n=piece.column("n"), size=[int(found[i][1].sum()) for i in range(len(hubs))],
                mass=lacks + adds, cost=(1 - part_of) * lacks + part_of * adds, **{f"d{k}": np.ascontiguousarray(bits[:, k]) for k in range(WORDS_64)},
            )

    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t_{c}"))
    both = pairs.select(F.col("hub").alias("a"), F.col("id").alias("b"), "n").distinct().join(side("a"), "a").join(side("b"), "b")
    kinds = ", ".join(f"d{k} long" for k in range(WORDS_64))
    return settle(both.mapInArrow(part, f"hub long, id long, n long, size long, mass long, cost double, {kinds}"), "differences")


def _possible(differences: DataFrame, classes: _Classes, similar: float) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of documents with a common hub, in different components, that may still be similar.

    With p = similar / (1 + similar), x and y are similar if and only if what
    they add or lack alike is at least cost(x) + cost(y) + (2 p - 1) size, for
    cost = (1 - p) lacks + p adds. It is at most what x adds or lacks, less
    one for every bit of x that y has not.
    """
    name = lambda c, by: classes.comp.select(F.col("id").alias(by), F.col("comp").alias(c))
    known = settle(
        differences.join(name("found", "id"), "id", "left").join(name("hub_found", "hub"), "hub", "left")
        .withColumns({"comp": F.coalesce("found", "id"), "hub_comp": F.coalesce("hub_found", "hub")}).drop("found", "hub_found"), "known",
    )
    cols = ["id", "n", "comp", "mass", "cost", *[f"d{k}" for k in range(WORDS_64)]]
    side = lambda df, c: df.select("hub", "size", "hub_comp", *[F.col(x).alias(f"{c}_{x}") for x in cols])
    # In every pair of different components, one is not the hub's.
    left = side(known.where("comp <> hub_comp"), "a")
    right = side(known, "b").withColumnsRenamed({"hub": "hub_b", "size": "size_b", "hub_comp": "hub_comp_b"})
    missing = lambda x, y: reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{x}_d{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}_d{k}")))) for k in range(WORDS_64)])
    needed = F.col("a_cost") + F.col("b_cost") + F.lit((similar - 1) / (1 + similar)) * F.col("size") - 1e-6
    alike = (F.col("a_mass") - missing("a", "b") >= needed) & (F.col("b_mass") - missing("b", "a") >= needed)
    once = (F.col("b_comp") == F.col("hub_comp")) | (F.col("a_id") < F.col("b_id"))
    met = left.join(right, (F.col("hub") == F.col("hub_b")) & (F.col("a_comp") != F.col("b_comp")) & once & alike)
    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b"))


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every node of the links (a, b): comp is the smallest id of its component.

    Every node takes the smallest label among its neighbours, then that
    label's own label, until nothing changes; each step is written, so a lost
    executor costs one step.
    """
    both = settle(links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select("b", "a")).distinct(), "edges")
    comp = settle(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("comp")), "comp")
    while True:
        near = both.join(comp.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("comp").alias("near"))
        step = comp.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = step.select(F.col("id").alias("comp"), F.col("comp").alias("then"))
        comp2 = settle(step.join(jump, "comp", "left").select("id", "was", F.least("comp", F.coalesce("then", "comp")).alias("comp")), "comp")
        if comp2.where("was <> comp").isEmpty():
            return comp2.select("id", "comp")
        comp = comp2.select("id", "comp")


class _Classes:
    """The components that the links found so far make."""

    def __init__(self, texts: DataFrame, similar: float):
        self.texts, self.similar, self.comp = texts, similar, None

    def test(self, pairs: DataFrame) -> None:
        """Verify pairs and let their links merge components."""
        found = _verified(pairs, self.texts, self.similar)
        if self.comp is None:
            self.comp = components(found)
            return
        # Later links only matter between components, however many documents they join.
        of = lambda c: self.comp.select(F.col("id").alias(c), F.col("comp").alias(f"of_{c}"))
        across = found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
            F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")
        )
        merged = components(across.where("a <> b").distinct())
        into = merged.select(F.col("id").alias("comp"), F.col("comp").alias("then"))
        known = self.comp.join(into, "comp", "left").select("id", F.coalesce("then", "comp").alias("comp"))
        self.comp = settle(known.union(merged.join(self.comp.select("id"), "id", "left_anti").select("id", "comp")), "classes")

    def marked(self, members: DataFrame) -> DataFrame:
        """Members (bucket, id, ..) of the buckets that still hold several components, with ``comp`` and ``size``."""
        known = self.comp.withColumnRenamed("comp", "found")
        rows = members.drop("comp", "size").join(known, "id", "left").withColumn("comp", F.coalesce("found", "id")).drop("found")
        mixed = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        return settle(rows.join(mixed.where("lo <> hi").drop("lo", "hi"), "bucket"), "open")


def _with_hubs(open_: DataFrame) -> DataFrame:
    """The members of open buckets with each bucket's hub: the member whose buckets hold most members in all."""
    company = open_.groupBy("id").agg(F.sum("size").alias("company"))
    hubs = open_.select("bucket", "id", "comp").join(company, "id").groupBy("bucket").agg(F.max(F.struct("company", (-F.col("id")).alias("less"), "comp")).alias("top"))
    named = hubs.select("bucket", (-F.col("top.less")).alias("hub"), F.col("top.comp").alias("hub_comp"))
    return settle(open_.join(named, "bucket").where("id <> hub"), "hubs")


def _linked(nodes: DataFrame, named: DataFrame, similar: float) -> DataFrame:
    """(id, comp) of the nodes (id, mark, n, bands) that are similar to another one; ``named`` has the texts by mark."""
    buckets = nodes.select("id", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("lead"), F.max("id").alias("last")).where("lead.id <> last")
    members = settle(buckets.join(shared.select("bucket", "lead"), "bucket"), "members")
    wanted = nodes.select("id", "mark").join(members.select("id").distinct(), "id")
    # Rows with equal marks have equal texts.
    texts = settle(named.select("mark", "text").join(wanted, "mark").select("id", "text").dropDuplicates(["id"]), "texts")
    classes = _Classes(texts, similar)
    # First the smallest of each node's leaders, which joins most of what belongs together.
    nearest = members.where("id <> lead.id").groupBy("id").agg(F.min("lead").alias("lead"), F.min("n").alias("n"))
    classes.test(nearest.select(F.col("lead.id").alias("a"), F.col("id").alias("b"), F.col("lead.n").alias("n_a"), F.col("n").alias("n_b")))
    # In the buckets that hold several components still, the hub against members of others.
    open_ = classes.marked(members.drop("lead"))
    hubs = _with_hubs(open_)
    size_of = open_.select(F.col("id").alias("hub"), F.col("n").alias("hub_n")).distinct()
    classes.test(hubs.where("comp <> hub_comp").select("hub", "id", "n").distinct().join(size_of, "hub").select(
        F.col("hub").alias("a"), F.col("id").alias("b"), F.col("hub_n").alias("n_a"), F.col("n").alias("n_b")))
    # At last every pair of the buckets still open that its two differences from the hub don't rule out.
    rest = _with_hubs(classes.marked(open_))
    classes.test(_possible(_from_hubs(rest.select("hub", "id", "n"), texts, similar), classes, similar))
    return classes.comp


_MARK = "__mark"


def _mark(doc_id: Column, text: Column) -> Column:
    """A digest of a row's id and text: rows that share it differ in nothing that counts here."""
    name = F.coalesce(F.concat(F.lit("i"), doc_id.cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat(name, F.lit(" "), F.coalesce(text, F.lit(""))).cast("binary")))


def _classed(docs: DataFrame, doc_id: str, text: str, similar: float) -> DataFrame:
    """row, id, mark, n, class_id, head and head_mark of every row: the head is the row of the class with the smallest
    id, rows without one last."""
    named = docs.select(
        F.col(doc_id).cast("long").alias("id"), _mark(F.col(doc_id).cast("long"), F.col(text)).alias("mark"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    sigs = settle(signatures(named).withColumn("row", F.monotonically_increasing_id()), "signatures")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark", "row")
    # Equal word sequences are one node, so copies never make pairs.
    exact = settle(sigs.where("n > 0").groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min(place).alias("head")), "exact")
    nodes = sigs.join(exact.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("id"), "mark", "n", "bands")
    of_node = _linked(nodes, named, similar).join(exact.select(F.col("node").alias("id"), "head"), "id")
    of_comp = of_node.groupBy("comp").agg(F.min("head").alias("first"))
    linked = of_node.join(of_comp, "comp").select(F.col("id").alias("node"), "first")
    classes = exact.join(linked, "node", "left").select("k1", "k2", F.coalesce("first", "head").alias("first"))
    found = sigs.select("row", "id", "mark", "k1", "k2", "n").join(classes, ["k1", "k2"], "left")
    of = lambda mine, first: F.when(F.col("n") > 0, F.col(f"first.{first}")).otherwise(F.col(mine))
    return found.select("row", "id", "mark", "n", of("id", "id").alias("class_id"), of("row", "row").alias("head"), of("mark", "mark").alias("head_mark"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """doc_id and class_id of every row: documents linked, directly or in steps, by a similarity of ``similar`` or more
    share a class, named by its smallest id.

    Ids are whole numbers. Rows that repeat an id are one document with
    several texts: each of them links, and they share the class. A row without
    an id is in the class of its text; a class without any id is NULL.
    Documents without words (NULL, empty) are classes of their own. Further
    columns play no part.
    """
    found = settle(_classed(docs, doc_id, text, similar).select("id", "class_id"), "classes")
    several = found.where("id IS NOT NULL").groupBy("id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo <> hi")
    if not several.isEmpty():
        links = found.join(several.select("id", "lo"), "id").where("lo <> class_id").select(F.col("lo").alias("a"), F.col("class_id").alias("b")).distinct()
        into = components(links).select(F.col("id").alias("class_id"), F.col("comp").alias("then"))
        found = found.join(into, "class_id", "left").select("id", F.coalesce("then", "class_id").alias("class_id"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each class of similar texts, the one with the smallest id (rows without an id last).

    Every row stands for itself here: different texts under one id are kept,
    each in its own class, and so are all rows without words.
    """
    found = settle(_classed(docs, doc_id, text, similar).where("n > 0").select("mark", "head_mark"), "heads")
    counted = found.groupBy("mark").agg(F.first(F.col("mark") == F.col("head_mark")).alias("stays"), F.count(F.lit(1)).alias("times"))
    marked = docs.withColumn(_MARK, _mark(F.col(doc_id).cast("long"), F.col(text)))
    named = lambda df: settle(df.select(F.col("mark").alias(_MARK)), "marks")
    kept = marked.join(named(counted.where("NOT stays")), _MARK, "left_anti")
    # Rows with the same id and text as a head: one of them.
    again = named(counted.where("stays AND times > 1"))
    if not again.isEmpty():
        kept = kept.join(again, _MARK, "left_semi").dropDuplicates([_MARK]).union(kept.join(again, _MARK, "left_anti"))
    return kept.select(*docs.columns)


@query("op3_neardup")
def op3_neardup(spark, sf_dir):
    """The class of every document of the whole table."""
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Gradient-boosted regression trees whose rows lie in blocks of bin numbers.

The trees are those of Spark's ``GBTRegressor`` for squared error: the same
bins, the same drawn rows and columns, the same choice of splits (but for gains
that only rounding tells apart), and a ``GBTRegressionModel`` as the result. What differs
is the pass over the rows, of which a few hundred trees need some thousand.
There a row is an object that is made anew by each pass; here rows lie in
blocks, two bytes per row and pair of columns, and a pass counts a block pair
by pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame

from fieldtally.session import file_system, shared_dir

# Rows from which the bins are found, as in Spark; more rows are sampled to about so many.
BIN_ROWS = 10_000
# Trees after which the rows' predictions are written, so that a lost block never means older trees again.
WRITE_EVERY = 20
# Rows per task of a pass: the start of a Python task costs as much as the counting of some 100,000 rows.
TASK_ROWS = 600_000
# Rows per block: few enough that what is made on the way stays in the processor's cache.
BLOCK_ROWS = 32_768
# Gains that differ by less are the same but for the order of additions; the first of them counts, as with equal ones.
SAME_GAIN = 1e-12


def _task_functions():
    """What runs inside the tasks. Nested, so that it travels by value and the tasks need not have this package installed."""

    def first_state(seed: int) -> int:
        """The state that Spark's generator derives from a seed: its hash, twice."""
        low, mask = 0x3C074A61, 0xFFFFFFFF
        halves = []
        for _ in range(2):
            h = low
            data = (seed & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big")
            for i in (0, 4):
                k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & mask
                k = ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask
                h ^= k
                h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
            h ^= 8
            h = (h ^ h >> 16) * 0x85EBCA6B & mask
            h = (h ^ h >> 13) * 0xC2B2AE35 & mask
            low = h ^ h >> 16
            halves.append(low)
        return halves[1] << 32 | halves[0]

    def stepped(x):
        """The states that follow ``x``."""
        x = x ^ (x << np.uint64(21))
        x = x ^ (x >> np.uint64(35))
        return x ^ (x << np.uint64(4))

    def uniform(seed: int, n: int) -> np.ndarray:
        """The first ``n`` doubles of Spark's generator; each takes two of its states.

        The states are made in some thousand lanes at once. A step is linear
        in the bits, so the jump from lane to lane is the xor of one table
        entry per byte, and jumps are put together from jumps.
        """
        lanes = min(4096, max(1, n))
        steps = -(-n // lanes) * 2

        def jumped(jump: np.ndarray, x: np.ndarray) -> np.ndarray:
            table = np.zeros((8, 256), np.uint64)
            for bit in range(8):
                table[:, 1 << bit : 2 << bit] = table[:, : 1 << bit] ^ jump[bit::8, None]
            parts = x.view(np.uint8).reshape(-1, 8)
            out = table[0][parts[:, 0]]
            for i in range(1, 8):
                out ^= table[i][parts[:, i]]
            return out

        # What becomes of each bit after one step, then after as many as a lane has.
        bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
        jump, power = bits, stepped(bits)
        for bit in range(steps.bit_length()):
            if steps >> bit & 1:
                jump = jumped(power, jump)
            power = jumped(power, power)
        x = np.array([first_state(seed)], np.uint64)
        while len(x) < lanes:
            x = np.concatenate([x, jumped(jump, x)])
            jump = jumped(jump, jump)
        x, out = x[:lanes], np.empty((steps // 2, lanes))
        for i in range(steps // 2):
            high = stepped(x)
            x = stepped(high)
            out[i] = (((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (x & np.uint64((1 << 27) - 1))) * 2.0**-53
        return out.T.ravel()[:n]

    def places(pairs: np.ndarray, splits: Sequence[tuple[int, int, int]], depth: int, width: int) -> np.ndarray:
        """The node of each row: 1 is the root, 2i and 2i + 1 are the children of i. Parents come first in ``splits``."""
        kind = np.min_scalar_type(2 << depth)
        at = np.ones(pairs.shape[1], kind)
        for node, column, last in splits:
            pair = pairs[column // 2]
            right = pair - pair // width * width > last if column % 2 else pair >= (last + 1) * width
            at += (at == node) * (right + kind.type(node))
        return at

    def packed(edges: Sequence[np.ndarray], width: int):
        """The rows of a partition as one: the bin numbers of each two columns in one, and the labels."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers, labels = [], []
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, x = batch.column(0), batch.column(1)
                label = y.to_numpy(zero_copy_only=False)
                if y.null_count or x.null_count or not np.isfinite(label).all():
                    raise ValueError("labels and vectors must be there and finite")
                values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
                if values.shape[1] != len(edges) or not np.isfinite(values).all():
                    raise ValueError("vectors must be finite and of one length")
                found = np.zeros((len(edges) + len(edges) % 2, len(label)), np.uint16)
                for i, e in enumerate(edges):
                    found[i] = np.searchsorted(e, values[:, i])
                numbers.append(found[0::2] * np.uint16(width) + found[1::2])
                labels.append(label)
            if labels:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([np.concatenate(numbers, 1).tobytes()], pa.binary()),
                     pa.array([np.concatenate(labels).tobytes()], pa.binary())], ["pairs", "y"])

        return pack

    def opened(part: int, rows):
        for row in rows:
            y = np.frombuffer(row["y"])
            pairs = np.frombuffer(row["pairs"], np.uint16).reshape(-1, len(y))
            for start in range(0, len(y), BLOCK_ROWS):
                piece = slice(start, start + BLOCK_ROWS)
                yield part, start, len(y), pairs[:, piece].copy(), y[piece].copy(), None

    def advanced(splits, values, m: int, rate: float, depth: int, width: int, row_share: float, seed: int):
        """Take what tree ``m - 1`` predicts from what is left to fit, and draw the rows of tree ``m``."""

        def of(blocks):
            for part, start, rows, pairs, target, drawn in blocks:
                if m:
                    told = values[places(pairs, splits, depth, width)]
                    # The first tree fits the labels, the others twice what is left, the slope of the squared error.
                    target = 2.0 * (target - told) if m == 1 else target - 2.0 * rate * told
                if row_share < 1:
                    # One sequence of draws for the rows of a partition, in their order.
                    lot = uniform(seed + m + part + 1, rows) < row_share if not start else lot
                    drawn = lot[start : start + len(target)]
                yield part, start, rows, pairs, target, drawn

        return of

    def counted(splits, nodes: Sequence[int], columns: Sequence[int], depth: int, width: int):
        """Rows, sum and sum of squares of what is to be fitted, per node, column and bin."""

        def of(blocks):
            cells, wanted = width * width, sorted({column // 2 for column in columns})
            rest = len(nodes) * cells
            # Rows that are not drawn, or rest in a leaf, are counted in one place more, which is left out.
            slots = np.full(2 << depth, rest, np.int64)
            slots[np.array(nodes)] = np.arange(len(nodes)) * cells
            both = np.zeros((len(wanted), 3, rest + cells))
            for _, _, _, pairs, target, drawn in blocks:
                base = slots[places(pairs, splits, depth, width)]
                if drawn is not None:
                    base[~drawn] = rest
                index, square = np.empty_like(base), target * target
                for at, pair in enumerate(wanted):
                    np.add(base, pairs[pair], out=index)
                    for i, weights in enumerate((None, target, square)):
                        both[at, i] += np.bincount(index, weights, rest + cells)
            both = both[:, :, :rest].reshape(len(wanted), 3, len(nodes), width, width)
            out = np.zeros((len(nodes), 2 * max(wanted) + 2, width, 3))
            for at, pair in enumerate(wanted):
                out[:, 2 * pair], out[:, 2 * pair + 1] = (np.moveaxis(both[at].sum(axis), 0, -1) for axis in (3, 2))
            yield out

        return of

    return packed, opened, advanced, counted, uniform, first_state


_packed, _opened, _advanced, _counted, _uniform, _first_state = _task_functions()


def _edges(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Where the bins of one column end, about equally many rows in each; ``expected`` rows, the zeros among them implied."""
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    counts = counts.astype(float)
    if not len(found):
        return found
    zeros = expected - counts.sum()
    if zeros > sys.float_info.epsilon * counts.sum() * 100:
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = expected / bins
    kept, before, target = [], counts[0], stride
    for middle, count in zip(middles, counts[1:]):
        if abs(before - target) < abs(before + count - target):
            kept.append(middle)
            target += stride
        before += count
    return np.array(kept)


def bin_edges(rows: DataFrame, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """The bins of every column of (y, array) rows, from all rows or a sample of about ``BIN_ROWS``."""
    share = min(1.0, max(bins * bins, BIN_ROWS) / n)
    if share < 1:
        # The sample of the JVM's own class, which DataFrame.sample is not.
        drawn = int(_first_draw(seed))
        session = rows.sparkSession
        sample = session._jsparkSession.createDataFrame(rows._jdf.javaRDD().sample(False, share, drawn), rows._jdf.schema())
        rows = DataFrame(sample, session)
    x = rows.toArrow().column(1).combine_chunks()
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
    return [_edges(column, share * n, min(bins, n)) for column in values.T]


def _first_draw(seed: int) -> int:
    """The first whole number of Spark's generator."""
    x, mask = _first_state(seed), 0xFFFFFFFFFFFFFFFF
    x ^= x << 21 & mask
    x ^= x >> 35
    x = (x ^ x << 4) & 0xFFFFFFFF
    return x - (x >> 31 << 32)


def _some_columns(columns: int, wanted: int, seed: int) -> list[int]:
    """A random choice of columns, by reservoir."""
    chosen = list(range(wanted))
    for i, draw in enumerate(_uniform(seed, columns - wanted)):
        at = int(draw * (wanted + i + 1))
        if at < wanted:
            chosen[at] = wanted + i
    return chosen


def _impurity(s: np.ndarray) -> np.ndarray:
    """Variance from (rows, sum, sum of squares); 0 without rows."""
    n = np.where(s[..., 0] > 0, s[..., 0], 1.0)
    return np.where(s[..., 0] > 0, (s[..., 2] - s[..., 1] * s[..., 1] / n) / n, 0.0)


def _best_split(counts: np.ndarray, columns: Sequence[int], edges: Sequence[np.ndarray], own: np.ndarray | None):
    """(gain, column, last bin to the left, statistics of the node, the left and the right side); no gain, no split."""
    valid = [c for c in columns if len(edges[c])]
    if not valid:
        return None, 0, 0, counts[columns[0]].sum(0), None, None
    upto = np.cumsum(counts[valid], axis=1)
    left, right = upto[:, :-1], upto[:, -1:] - upto[:, :-1]
    own = left[0, 0] + right[0, 0] if own is None else own
    total = left[..., 0] + right[..., 0]
    share = lambda side: side[..., 0] / np.where(total > 0, total, 1.0)
    gain = _impurity(own) - share(left) * _impurity(left) - share(right) * _impurity(right)
    there = np.arange(left.shape[1]) < np.array([len(edges[c]) for c in valid])[:, None]
    gain = np.where(there & (left[..., 0] >= 1) & (right[..., 0] >= 1) & (gain >= 0), gain, -np.inf)
    c, b = np.unravel_index(np.argmax(gain >= gain.max() - SAME_GAIN * own[2] / own[0]), gain.shape)
    if not gain[c, b] > 0:
        return (None if gain[c, b] < 0 else 0.0), 0, 0, own, None, None
    return float(gain[c, b]), valid[c], int(b), own, left[c, b], right[c, b]


def _grow(state: RDD, edges, depth: int, wanted: int, choices, width: int):
    """One tree on the state's drawn rows: {node: (statistics, impurity, gain or None, column, last bin)}."""
    tree, stats, stack, deep = {}, {1: None}, [1], 1 if state.getNumPartitions() <= 64 else 2
    while stack:
        # Draws belong to nodes in the order in which Spark's stack holds them.
        level, stack = stack, []
        columns = [list(range(len(edges))) if wanted == len(edges) else _some_columns(len(edges), wanted, choices.nextLong()) for _ in level]
        used = sorted({c for chosen in columns for c in chosen})
        splits = [(node, tree[node][3], tree[node][4]) for node in sorted(tree) if tree[node][2]]
        counts = state.mapPartitions(_counted(splits, level, used, depth, width)).treeReduce(lambda a, b: a + b, deep)
        for node, chosen, own in zip(level, columns, counts):
            gain, column, last, mine, left, right = _best_split(own, chosen, edges, stats[node])
            tree[node] = (mine, float(_impurity(mine)) if gain is not None else -1.0, gain, column, last)
            if not gain:
                continue
            for child, side in ((2 * node, left), (2 * node + 1, right)):
                stats[child], spread = side, float(_impurity(side))
                if child >= 1 << depth or abs(spread) < sys.float_info.epsilon:
                    tree[child] = (side, spread, None, 0, 0)
                else:
                    stack.insert(0, child)
    return tree


def _mean(stats: np.ndarray) -> float:
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def _java_tree(session, tree, edges):
    """The tree as Spark's own; two leaves that predict the same are one."""
    jvm = session._jvm
    ml, order = jvm.org.apache.spark.ml, {node: i for i, node in enumerate(tree)}
    doubles = session.sparkContext._gateway.new_array(jvm.double, 3 * len(tree))
    flat = np.concatenate([np.asarray(v[0], float) for v in tree.values()]).astype(">f8").tobytes()
    jvm.java.nio.ByteBuffer.wrap(flat).asDoubleBuffer().get(doubles)
    trimmed, variance = jvm.java.util.Arrays.copyOfRange, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def made(node: int):
        stats, impurity, gain, column, last = tree[node]
        calculator = lambda: variance(trimmed(doubles, 3 * order[node], 3 * order[node] + 3), int(stats[0]))
        if gain:
            (left, a), (right, b) = made(2 * node), made(2 * node + 1)
            if a is None or b is None or a != b:
                split = ml.tree.ContinuousSplit(column, float(edges[column][last]))
                return ml.tree.InternalNode(_mean(stats), impurity, gain, left, right, split, calculator()), None
        return ml.tree.LeafNode(_mean(stats), impurity, calculator()), _mean(stats)

    return made(1)[0]


def fit_trees(kept: DataFrame, n: int, estimator: GBTRegressor) -> GBTRegressionModel:
    """What ``estimator.fit(kept)`` returns, for squared error, columns that are all numbers and no least node size.

    ``kept`` has ``n`` rows of (label, vector), in partitions of which each
    fits into a task's memory at a byte per value. Per tree and level one job
    counts the rows; the driver only sees the sums per node, column and bin.
    """
    if not n:
        raise ValueError("no rows to fit on")
    session, get = kept.sparkSession, estimator.getOrDefault
    depth, rate, row_share, seed, trees = (get(x) for x in ("maxDepth", "stepSize", "subsamplingRate", "seed", "maxIter"))
    rows = kept.select(kept[get("labelCol")].cast("double"), vector_to_array(kept[get("featuresCol")]))
    edges = bin_edges(rows, n, get("maxBins"), seed)
    # A sample a little larger than expected can end in a bin more.
    wanted, width = int(np.ceil(float(get("featureSubsetStrategy")) * len(edges))), max(len(e) for e in edges) + 1
    packed = rows.mapInArrow(_packed(edges, width), "pairs binary, y binary").rdd.mapPartitionsWithIndex(_opened)
    packed = packed.coalesce(max(1, n // TASK_ROWS))
    shared_dir(session)
    before, state, splits, values, grown, written = None, None, [], None, [], None
    try:
        for m in range(trees):
            step = _advanced(splits, values, m, rate, depth, width, row_share, seed)
            before, state = state, (state or packed).mapPartitions(step).persist(StorageLevel.MEMORY_AND_DISK)
            if m % WRITE_EVERY == WRITE_EVERY - 1:
                state.checkpoint()
            tree = _grow(state, edges, depth, wanted, session._jvm.java.util.Random(seed + m), width)
            grown.append(tree)
            if before is not None:
                before.unpersist()
            if state.getCheckpointFile():
                _remove(session, written)
                written = state.getCheckpointFile()
            splits = [(node, tree[node][3], tree[node][4]) for node in sorted(tree) if tree[node][2]]
            values = np.zeros(2 << depth)
            for node, found in tree.items():
                values[node] = _mean(found[0])
    finally:
        for held in (before, state):
            if held is not None:
                held.unpersist()
        _remove(session, written)
    jvm, gateway = session._jvm, session.sparkContext._gateway
    regression = jvm.org.apache.spark.ml.regression
    models, weights = gateway.new_array(regression.DecisionTreeRegressionModel, trees), gateway.new_array(jvm.double, trees)
    for m, tree in enumerate(grown):
        root = _java_tree(session, tree, edges)
        models[m] = regression.DecisionTreeRegressionModel(f"tree_{m}", root, len(edges))
        weights[m] = rate if m else 1.0
    fitted = estimator._create_model(regression.GBTRegressionModel(estimator.uid, models, weights, len(edges)))
    return estimator._copyValues(fitted)


def _remove(session, path: str | None) -> None:
    if path:
        files, folder = file_system(session, path)
        files.delete(folder, True)

"""Sharding along a Hilbert curve over document metadata, with DataFrame operations only.

Source, language and length are quantised, each document gets the index of
its cell on a Hilbert curve, and the globally sorted documents are cut into
runs of equal length. A shard then covers a small box in all three dimensions,
so that a reader that filters on any of them can skip most shards by their
minima and maxima.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import positions, query, table
from fieldtally.session import settle

BITS = 8


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Index (long) of the cell with these coordinates, each from 0 to 2**bits - 1, on a Hilbert curve.

    The transform between axes and transposed index of Skilling (2004), as a
    fold over (bit, axis): either the first coordinate is inverted below the
    bit, or the low bits of the first and the current coordinate are swapped.
    """
    n = len(cells)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])
    axes = F.array(*[c.cast("int") for c in cells])

    def step(x: Column, s: Column) -> Column:
        own, low = F.get(x, s["i"]), s["q"] - 1
        swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        inverts = own.bitwiseAND(s["q"]) != 0
        return F.transform(
            x,
            lambda v, j: F.when(inverts, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(F.when(s["i"] == 0, F.lit(0)).otherwise(swap))).otherwise(v)
            ),
        )

    turned = F.aggregate(steps, axes, step)
    # Gray code: each coordinate takes in the ones before it.
    gray = F.aggregate(
        turned, F.array().cast("array<int>"),
        lambda a, v: F.concat(a, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))))),
    )
    places = F.sequence(F.lit(bits - 1), F.lit(1))

    def settle_low(x: Column) -> Column:
        last = F.element_at(x, -1)
        flip = F.aggregate(
            places, F.lit(0),
            lambda t, b: F.when(F.call_function("getbit", last.cast("long"), b) == 1, t.bitwiseXOR(F.call_function("shiftleft", F.lit(1), b) - 1)).otherwise(t),
        )
        return F.transform(x, lambda v: v.bitwiseXOR(flip))

    # The coordinates' bits, highest first, taken in turn.
    order = F.sequence(F.lit(bits * n - 1), F.lit(0))
    transposed = F.transform(F.array(gray), settle_low)
    picked = lambda x: F.aggregate(
        order, F.lit(0).cast("long"),
        lambda h, p: h * 2 + F.call_function("getbit", F.get(x, (F.lit(n - 1) - p % n).cast("int")).cast("long"), F.floor(p / n).cast("int")),
    )
    return F.get(F.transform(transposed, picked), F.lit(0))


def _codes(docs: DataFrame, column: str, out: str) -> DataFrame:
    """Each value's place among the distinct values, scaled to the cells; order is kept, so minima and maxima prune."""
    values = docs.select(F.col(column).alias(f"{out}_of")).distinct()
    every = Window.orderBy(F.col(f"{out}_of").asc_nulls_first())
    last = F.greatest(F.lit(1), F.count(F.lit(1)).over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - 1)
    place = F.floor((F.row_number().over(every) - 1) * ((1 << BITS) - 1) / last).cast("int")
    return settle(values.select(f"{out}_of", place.alias(out)), "codes")


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    dimensions: Sequence[str] = ("source", "lang"),
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, size, text_crc32, hilbert, shard and slot of every row, and the columns in ``keep`` as a struct ``row``.

    The law is ``rows``: shards hold runs of the curve whose numbers of rows
    differ by one at most; a slot is the row's place in its shard's run. Equal
    texts with equal metadata lie side by side. NULL texts have size 16 and
    crc 0; NULL metadata has a cell of its own; repeated rows have slots of
    their own; an empty table gives no rows. Columns not named play no part.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"d{i}") for i, c in enumerate(dimensions)],
        *([F.struct(*keep).alias("row")] if keep else []),
    )
    for i in range(len(dimensions)):
        # One row per distinct value; its size is known from the files, so the optimizer broadcasts it only if small.
        base = base.join(_codes(base, f"d{i}", f"c{i}"), F.col(f"d{i}").eqNullSafe(F.col(f"c{i}_of")))
    length = F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.col("size") / 16) * 12)).cast("int")
    cells = [*[F.col(f"c{i}") for i in range(len(dimensions))], length]
    kept = ["doc_id", "size", "text_crc32", *(["row"] if keep else [])]
    curve = base.select(*kept, hilbert_index(cells).alias("hilbert"))
    placed = positions(curve, [F.col("hilbert"), F.col("text_crc32"), F.col("size"), F.col("doc_id")], "at", "rows")
    shard = F.expr(f"(at * {shards}) div rows")
    first = F.expr(f"(((at * {shards}) div rows) * rows + {shards - 1}) div {shards}")
    return placed.select(*kept, "hilbert", shard.cast("int").alias("shard"), (F.col("at") - first).alias("slot"))


@query("op10_sharding")
def op10_sharding(spark, sf_dir):
    """All documents in 40 shards of equal row counts along the curve."""
    return hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

"""Substring dedup: passages of 13 words or more that an earlier document has are removed.

1. Documents are dealt to shards of bounded size by id and text, so that rows
   without an id or with a repeated one don't meet in one shard. Each shard picks
   anchor phrases of its texts: of every eight neighbouring six-word runs the
   one with the smallest hash. Every 13-word window holds an anchor, and equal
   windows hold equal ones.
2. Anchors seen in two documents or more are confirmed as recurring phrases.
   Each shard compiles those its texts may hold into an Aho-Corasick automaton
   and streams all its documents through it, which locates every occurrence.
3. The 13-word windows around the occurrences are hashed; of each, the smallest
   document id is kept. A word goes if a window over it starts in a document
   with a smaller id.

Between the steps only hashes and ids are shuffled, at most one row per phrase
or window and shard, so that a passage that half of the documents share is a
few rows; the texts are dealt once and used three times.
"""

from __future__ import annotations

import math

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import Tokens, run_inside, runs, sliced

WINDOW, PHRASE = 13, 6
#: Bytes of text per shard; a shard is one task's work, whatever the size of the table.
SHARD_BYTES = 4_000_000


def anchors(tokens: Tokens, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the anchor phrases: minima of each ``window - phrase + 1`` neighbouring phrases of a text."""
    h = runs(tokens.h, phrase)
    inside = run_inside(tokens.bounds, phrase, len(tokens))
    rank = np.where(inside, h, np.uint64(2**64 - 1))
    reach = window - phrase + 1
    if len(rank) < reach:
        return np.empty(0, int), np.empty(0, np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(rank, reach).min(1)
    least[~run_inside(tokens.bounds, window, len(tokens))[: len(least)]] = 0
    # A phrase is an anchor if it is the least of any window over it; ties are all anchors.
    padded = np.r_[np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)]
    most = np.lib.stride_tricks.sliding_window_view(padded, reach).max(1)
    at = np.flatnonzero((most == rank) & inside & (rank > 0))
    return at, h[at]


def _extent(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest and largest document."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    last = np.r_[first[1:], len(key)] - 1 if len(key) else first
    return key[first], doc[first], doc[last]


def _rows(shard: int, found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    key, lo, hi = _extent(*(np.concatenate(x) for x in zip(*found))) if found else (np.empty(0, np.uint64), np.empty(0, int), np.empty(0, int))
    return pd.DataFrame({"key": key.view(np.int64), "shard": np.full(len(key), shard), "lo": lo, "more": hi - lo})


#: ``lo`` and ``lo + more`` are the smallest and largest id that hold the key in this shard; ``more`` is mostly 0, which packs well.
_ROWS = "key long, shard int, lo long, more long"


def locate(automaton: ahocorasick.Automaton, tokens: Tokens) -> np.ndarray:
    """Word numbers at which patterns (words with a space around each) start, over all texts laid end to end."""
    text = (b" " + b" ".join(tokens.data.split()) + b" ").decode("latin-1")
    starts = [end - length for end, length in automaton.iter(text)]
    first = np.cumsum(np.r_[0, tokens.end - tokens.start + 1])
    # The pattern's leading space stands at start + 1, the word behind it.
    return np.searchsorted(first, np.asarray(starts, int) + 1)


def _recurring(rows: DataFrame, later: bool = False) -> DataFrame:
    """Rows of the keys that two documents or more hold, with the smallest id as ``owner``.

    A key has one row per shard at most. ``later`` leaves out the shards that
    hold the key in its owner only.
    """
    of, high = Window.partitionBy("key"), F.col("lo") + F.col("more")
    seen = rows.withColumn("owner", F.min("lo").over(of)).withColumn("last", F.max(high).over(of))
    return seen.where(high > F.col("owner") if later else F.col("last") > F.col("owner")).select("shard", "key", "owner")


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, phrase: int = PHRASE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed word ranges, end exclusive) and kept (the other words joined by one space).

    Words are runs of bytes other than ASCII white space. Windows are judged
    on the input. NULL texts have no words; texts of fewer than ``window``
    words lose nothing; rows that share an id never take words from each
    other; rows without an id neither lose nor cause anything. Further columns
    play no part. Hashes have 64 bits, over a phrase that has itself recurred.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(2 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(total / shard_bytes))
    dealt = base.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("named"), "text",
    )

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for part, texts in sliced([frame[frame["named"]]]):
            tokens = Tokens(texts)
            at, h = anchors(tokens, window, phrase)
            key, lo, hi = _extent(h, part["doc_id"].to_numpy()[tokens.text_of()[at]])
            found.append((np.r_[key, key], np.r_[lo, hi]))
        return _rows(int(frame["shard"].iloc[0]), found)

    def spread(frame: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
        wanted, found = np.sort(phrases["key"].to_numpy().view(np.uint64)), []
        if not len(wanted) or not len(frame):
            return _rows(0, [])
        named = frame[frame["named"]]
        automaton, known = ahocorasick.Automaton(), np.zeros(len(wanted), bool)
        for _, texts in sliced([named]):
            tokens = Tokens(texts)
            at, h = anchors(tokens, window, phrase)
            place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            fresh = (wanted[place] == h) & ~known[place]
            place, first = np.unique(place[fresh], return_index=True)
            known[place] = True
            for i in at[fresh][first]:
                pattern = (b" " + b" ".join(tokens.word(j) for j in range(i, i + phrase)) + b" ").decode("latin-1")
                automaton.add_word(pattern, len(pattern))
        if not len(automaton):
            return _rows(0, [])
        automaton.make_automaton()
        for part, texts in sliced([named]):
            tokens = Tokens(texts)
            h, near = runs(tokens.h, window, 1), np.zeros(len(tokens) + 1, int)
            # A phrase across two texts counts for nothing: no window of one text covers it.
            hits = locate(automaton, tokens)
            np.add.at(near, np.maximum(hits - (window - phrase), 0), 1)
            np.add.at(near, hits + 1, -1)
            at = np.flatnonzero((np.cumsum(near)[: len(h)] > 0) & run_inside(tokens.bounds, window, len(tokens)))
            key, lo, hi = _extent(h[at], part["doc_id"].to_numpy()[tokens.text_of()[at]])
            found.append((np.r_[key, key], np.r_[lo, hi]))
        return _rows(int(frame["shard"].iloc[0]), found)

    def remove(frame: pd.DataFrame, windows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(windows["key"].to_numpy().view(np.uint64))
        keys, owners = windows["key"].to_numpy().view(np.uint64)[order], windows["owner"].to_numpy()[order]
        out = []
        for part, texts in sliced([frame]):
            tokens = Tokens(texts)
            ids, h = part["doc_id"].to_numpy(), runs(tokens.h, window, 1)
            of = tokens.text_of()[: len(h)]
            gone = np.zeros(len(tokens) + 1, int)
            if len(keys) and len(h):
                place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = (keys[place] == h) & (owners[place] < ids[of]) & run_inside(tokens.bounds, window, len(tokens))
                gone[:-1][np.flatnonzero(hit)] += 1
                gone[np.flatnonzero(hit) + window] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            for i, content in enumerate(texts):
                words, drop = content.split(), gone[tokens.bounds[i] : tokens.bounds[i + 1]]
                edge = np.flatnonzero(np.diff(np.r_[False, drop, False].astype(np.int8)))
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]
                if spans:
                    kept = [w for w, d in zip(words, drop) if not d]
                else:
                    kept = words
                out.append((int(ids[i]), bool(part["named"].iloc[i]), len(words), len(words) - len(kept), spans, b" ".join(kept).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["doc_id", "named", "n_words", "n_removed", "spans", "kept"])

    phrases = _recurring(dealt.groupBy("shard").applyInPandas(choose, _ROWS))
    windows = dealt.groupBy("shard").cogroup(phrases.groupBy("shard")).applyInPandas(spread, _ROWS)
    final = dealt.groupBy("shard").cogroup(_recurring(windows, later=True).groupBy("shard")).applyInPandas(
        remove, "doc_id long, named boolean, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"
    )
    return final.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "spans", "kept")


@query("op1_passages")
def op1_passages(spark, sf_dir):
    """What is left of every document, as a digest."""
    return repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

"""Token counts by byte-pair merging on a heap and a linked list; no identifiers are made.

A piece starts as one symbol per character. The adjacent pair of lowest rank
is popped from a heap again and again (of equal ranks the leftmost), its two
links become one, and the pairs with the new neighbours are pushed. What is
popped after one of its links has changed is passed over. The count is the
number of symbols at the start less the number of merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.llm.wordhash import sliced

#: Counts of pieces and of chunks are kept up to about so many bytes of memory a worker, then forgotten.
KNOWN_BYTES = 120_000_000
#: Bytes that an entry takes beside its text.
_ENTRY = 140
TOKEN_LIMIT = 2048


class MergeCounter:
    """Counts the tokens of texts for a BPE tokenizer file of the ``tokenizers`` library.

    Normalizer and splitting rule are the library's own objects; only the
    merging is done here. The rule must drop white space, as then a text's
    count is the sum over its chunks between white space, and each distinct
    chunk is counted once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-pair merging is counted")
        whole = Tokenizer.from_file(path)
        self.normalize, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        if any(part for part, _ in self.split(" \t\n")) or [p for p, _ in self.split("a b")] != ["a", "b"]:
            raise ValueError("the splitting rule keeps white space")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        # The pair of two symbols, as one number, to its rank; and by rank the symbol that replaces it.
        self.width = max(self.ids.values()) + 1
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(self.ids[left] * self.width + self.ids[right], rank)
            self.made.append(self.ids[left + right])
        added = spec["added_tokens"]
        if any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("only added tokens that stand for exactly their own string are counted")
        longest = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.marks = [a.encode() for a in longest]
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, int] = {}
        self.chunks: dict[bytes, int] = {}
        self.held = 0

    def symbols(self, piece: str) -> list[int]:
        """A piece's symbols before any merge; the last one carries the word's end."""
        named = [*piece[:-1], piece[-1] + self.suffix]
        return [self.ids[s] for s in named if s in self.ids]

    def merged(self, piece: str) -> int:
        """Number of tokens of one piece of the splitting rule."""
        ids = self.symbols(piece)
        n = len(ids)
        rank, width, made = self.rank, self.width, self.made
        # An entry is rank and place of the left link in one number, so the heap orders by rank, then by place.
        heap = [rank[pair] * n + i for i, pair in enumerate([a * width + b for a, b in zip(ids, ids[1:])]) if pair in rank]
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            order, i = divmod(heappop(heap), n)
            j = after[i]
            if j == n or ids[i] < 0 or rank.get(ids[i] * width + ids[j]) != order:
                continue
            # Link j goes, link i stands for both.
            merges += 1
            new = ids[i] = made[order]
            ids[j] = -1
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                found = rank.get(new * width + ids[k])
                if found is not None:
                    heappush(heap, found * n + i)
            if h >= 0:
                found = rank.get(ids[h] * width + new)
                if found is not None:
                    heappush(heap, found * n + h)
        return n - merges

    def _piece(self, piece: str) -> int:
        known = self.pieces.get(piece)
        if known is None:
            known = self.pieces[piece] = self.merged(piece)
            self.held += len(piece) + _ENTRY
        return known

    def _alone(self, text: str) -> int:
        """Tokens of a chunk that may hold special tokens or rare kinds of white space."""
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(self._piece(p) for part in parts if part for p, _ in self.split(self.normalize(part)))

    def _learn(self, chunks: list[bytes]) -> None:
        """Count chunks that are not known yet, most of them in one call of normalizer and splitting rule."""
        plain = []
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            if text.split() == [text] and not any(m in chunk for m in self.marks):
                plain.append((chunk, text))
            else:
                self.chunks[chunk] = self._alone(text)
            self.held += len(chunk) + _ENTRY
        if not plain:
            return
        whole = self.normalize(" ".join([text for _, text in plain]))
        ends = np.cumsum([len(t) + 1 for t in whole.split(" ")])
        pieces = self.split(whole)
        counts = np.array([self._piece(p) for p, _ in pieces], np.int64)
        owner = np.searchsorted(ends, [at for _, (at, _) in pieces], "right")
        totals = np.bincount(owner, counts, len(plain)).astype(np.int64)
        self.chunks.update(zip([chunk for chunk, _ in plain], totals.tolist()))

    def count(self, text: bytes) -> int:
        """Number of tokens of a whole text in UTF-8."""
        chunks = text.split()
        fresh = list(set(chunks).difference(self.chunks))
        if fresh:
            if self.held > KNOWN_BYTES:
                self._forget()
                fresh = list(set(chunks))
            self._learn(fresh)
        return sum(map(self.chunks.__getitem__, chunks))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the path of a tokenizer file, the same on every machine.
    NULL and empty texts have 0 bytes and 0 tokens; rows that repeat an id, or
    have none, are counted one by one; further columns play no part. Nothing
    is shuffled, and a worker holds one batch of texts and a bounded cache.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # A pandas column of numbers can't hold NULL, so whether there is an id travels beside it.
    named = rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text")

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = MergeCounter(tokenizer)
        for frame, texts in sliced(frames):
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "named": frame["named"],
                "n_bytes": [len(t) for t in texts], "n_tokens": [counter.count(t) for t in texts],
            })

    counted = named.mapInPandas(part, "doc_id long, named boolean, n_bytes long, n_tokens long")
    return counted.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op12_token_counts")
def op12_token_counts(spark, sf_dir):
    """Bytes and tokens of every whole document."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

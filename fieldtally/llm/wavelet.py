"""Token ids as wavelet matrices: one compressed payload per shard of documents.

Documents are range partitioned by id, encoded and packed, in order, into
shards of bounded length. A payload holds the ids as bit planes: plane by
plane from the highest bit, with the ids stably sorted by the bit just stored.
The counts of ones per block of bits are stored beside the planes, so it gives
the id at a place, the number of occurrences before a place and the place of
the k-th occurrence from a few blocks.
"""

from __future__ import annotations

import os
import string
import struct
import sys
import zlib
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import query, table
from fieldtally.session import settle

#: Ids in a shard, but for a document that alone has more.
SHARD_IDS = 100_000
#: Bytes of a Python worker's table of known encodings before it starts anew, about.
KNOWN_BYTES = 60_000_000
#: Characters of the texts whose pieces are looked up together, but for a text that alone has more.
CHARS = 6_000_000
_BLOCK = 512
_MAGIC = b"WMX2"


class WaveletMatrix:
    """Bit planes (highest first), each with the number of ones before each block of 512 bits.

    Read from bytes, the counts are there at once and a plane's bits are
    inflated when they are first asked for.
    """

    def __init__(self, n: int, planes: list[np.ndarray | bytes], ones: list[np.ndarray]):
        self.n, self.planes, self.ones, self.depth = n, planes, ones, len(planes)
        self.zeros = [n - int(o[-1]) for o in ones]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length() if len(ids) else 1)
        planes, ones, now = [], [], ids.astype(np.uint16 if depth <= 16 else np.uint32)
        for bit in range(depth - 1, -1, -1):
            up = now & now.dtype.type(1 << bit) != 0
            plane = np.packbits(up)
            per_block = np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), _BLOCK // 8), dtype=np.int64) if len(plane) else np.empty(0, np.int64)
            planes.append(plane)
            ones.append(np.r_[0, np.cumsum(per_block)])
            now = np.concatenate([now[~up], now[up]])
        return cls(len(ids), planes, ones)

    def _bits(self, p: int) -> np.ndarray:
        """The packed bits of a plane."""
        if isinstance(self.planes[p], bytes):
            self.planes[p] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.planes[p]), np.uint8)
        return self.planes[p]

    def to_bytes(self) -> bytes:
        """Magic, length, planes; then of each plane the ones per block and its bits, both compressed, with their lengths."""
        pack = zstandard.ZstdCompressor(level=1).compress
        out = [_MAGIC, struct.pack("<QI", self.n, self.depth)]
        for p in range(self.depth):
            counts, bits = pack(np.diff(self.ones[p]).astype("<u2").tobytes()), pack(self._bits(p).tobytes())
            out += [struct.pack("<II", len(counts), len(bits)), counts, bits]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix")
        n, depth = struct.unpack_from("<QI", data, 4)
        at, planes, ones = 16, [], []
        for _ in range(depth):
            counts, bits = struct.unpack_from("<II", data, at)
            at += 8
            per_block = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + counts]), "<u2")
            ones.append(np.r_[0, np.cumsum(per_block, dtype=np.int64)])
            planes.append(bytes(data[at + counts : at + counts + bits]))
            at += counts + bits
        return cls(n, planes, ones)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, start = i // _BLOCK, i // _BLOCK * _BLOCK // 8
        bits = np.unpackbits(self._bits(plane)[start : start + _BLOCK // 8])[: i % _BLOCK]
        return int(self.ones[plane][block]) + int(bits.sum())

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for p in range(self.depth):
            bit = int(self._bits(p)[i // 8] >> (7 - i % 8) & 1)
            before = self._rank1(p, i)
            i = self.zeros[p] + before if bit else i - before
            value = value << 1 | bit
        return value

    def _span(self, symbol: int, i: int) -> tuple[int, int]:
        """Where the first i places that hold ``symbol`` end up after the last plane."""
        lo, hi = 0, i
        for p in range(self.depth):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if symbol >> (self.depth - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` stands among the first i places."""
        if symbol < 0 or symbol >> self.depth:
            return 0
        lo, hi = self._span(symbol, i)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Place of the k-th occurrence (from 0)."""
        if not 0 <= k < self.count(symbol):
            raise IndexError("no such occurrence")
        at = self._span(symbol, 0)[0] + k
        for p in range(self.depth - 1, -1, -1):
            bit = symbol >> (self.depth - 1 - p) & 1
            wanted = at - self.zeros[p] if bit else at
            # The block that holds the wanted bit, then the bit in it.
            size = np.arange(len(self.ones[p])) * _BLOCK
            before = self.ones[p] if bit else np.minimum(size, self.n) - self.ones[p]
            block = int(np.searchsorted(before, wanted, "right")) - 1
            bits = np.unpackbits(self._bits(p)[block * _BLOCK // 8 : (block + 1) * _BLOCK // 8])[: self.n - block * _BLOCK]
            at = block * _BLOCK + int(np.flatnonzero(bits == bit)[wanted - int(before[block])])
        return at

    def ids(self) -> np.ndarray:
        """All ids in order."""
        # From the lowest plane up: the ids there stand in the order of that plane, and go back to that of the one above.
        out = np.zeros(self.n, np.uint32)
        for p in range(self.depth - 1, -1, -1):
            up = np.unpackbits(self._bits(p))[: self.n].view(bool)
            back = np.empty(self.n, np.uint32)
            back[~up], back[up] = out[: self.zeros[p]], out[self.zeros[p] :] | np.uint32(1 << (self.depth - 1 - p))
            out = back
        return out


class Encoder:
    """Encodes whole texts with a tokenizer, each distinct piece of them once.

    Texts are cut where the vocabulary's splitting rule always cuts, whatever
    stands further left or right: before a single space, which belongs to the
    piece behind it, between a letter or digit and a full stop or comma, and
    on both sides of a single line break between other characters. A text in
    which a piece is a space alone or has other white space at an end is
    encoded as it is.
    """

    def __init__(self, path: str):
        # One thread a task; a pool of its own would hold memory for each of its threads.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Bytes of each token: its characters stand for one byte each.
        names = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for name, number in names.items():
            self.bytes_of[number] = len(name)
        code = np.arange(256)
        self.shown = (code > 0x20) & (code < 0x7F)
        self.wordly = np.isin(code, np.frombuffer((string.ascii_letters + string.digits).encode(), np.uint8))
        self._forget()

    def _forget(self) -> None:
        # Each known piece, and where its ids stand in ``flat``; pieces that cannot stand alone have a negative length.
        self.known = pa.array([], pa.string())
        self.flat, self.first, self.length = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _cut(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """All pieces, one after the other, and the number of the first piece of each text, with their count at the end."""
        raw = [t.encode() for t in texts]
        data = b"".join(raw)
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        # A byte on either side spares the ends of the data an exception.
        b = np.frombuffer(b" " + data + b" ", np.uint8)
        cut = b == 0x20
        # Letters and digits: ASCII, and U+00C0 to U+00FF but for the two signs among them.
        word = lambda at: self.wordly[b[at]] | ((b[at - 1] == 0xC3) & (b[at] != 0x97) & (b[at] != 0xB7))
        marks = np.flatnonzero((b == 0x2E) | (b == 0x2C))
        cut[marks[word(marks - 1)]] = True
        lines = np.flatnonzero(b == 0x0A)
        lines = lines[(self.shown[b[lines - 1]] | word(lines - 1)) & (self.shown[b[lines + 1]] | (b[lines + 1] == 0xC3))]
        cut[lines] = cut[lines + 1] = True
        cut = cut[1:]
        cut[np.r_[0, ends]] = True
        offsets = np.flatnonzero(cut).astype(np.int32)
        return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)), np.searchsorted(offsets, np.r_[0, ends])

    def _together(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has.

        Each piece begins with a space, or a line break and no other white
        space behind it, and ends in none. No token reaches over such a place,
        so some hundred pieces are encoded as one text, and the tokens' bytes
        tell whose they are.
        """
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        runs = offsets[:-1] // 1_024
        edges = offsets[np.r_[np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]), len(pieces)]].tolist()
        data, ids = pieces.buffers()[2].to_pybytes(), []
        for at in range(0, len(edges) - 1, 500):
            some = edges[at : at + 501]
            texts = [data[lo:hi].decode() for lo, hi in zip(some[:-1], some[1:])]
            ids += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids)
        ends = np.searchsorted(np.cumsum(self.bytes_of[flat]) - self.bytes_of[flat], offsets[1:] - offsets[0], "left")
        return flat, np.diff(ends, prepend=0)

    def _add(self, pieces: pa.StringArray, flat: np.ndarray, skip: int, length: np.ndarray) -> None:
        """Keep pieces whose ids follow each other in ``flat``, each behind ``skip`` others."""
        own = np.maximum(length, 0)
        self.first = np.r_[self.first, len(self.flat) + np.cumsum(own + skip) - own]
        self.length, self.flat = np.r_[self.length, length], np.r_[self.flat, flat]
        self.known = pa.concat_arrays([self.known, pieces])

    def _learn(self, pieces: pa.StringArray) -> np.ndarray:
        """The numbers of distinct pieces."""
        if self.known.nbytes + self.flat.nbytes + self.first.nbytes + self.length.nbytes > KNOWN_BYTES:
            self._forget()
        at = pc.index_in(pieces, value_set=self.known)
        fresh = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        unknown = pieces.take(pa.array(fresh))
        # No white space at an end but a single space before it, told by the commonest characters; the few others are looked at one by one.
        usual = pc.match_substring_regex(unknown, r"\A ?[!-~\x{C0}-\x{FF}]((?s:.)*[!-~\x{C0}-\x{FF}])?\z").to_numpy(zero_copy_only=False)
        spaced = pc.starts_with(unknown, " ").to_numpy(zero_copy_only=False)
        for kind, skip in ((usual & spaced, 0), (usual & ~spaced, 1), (~usual, 0)):
            if not kind.any():
                continue
            some = unknown.filter(pa.array(kind))
            at[fresh[kind]] = len(self.known) + np.arange(len(some))
            if kind[~usual].any():
                texts = some.to_pylist()
                body = [p[1:] if p[0] == " " else p for p in texts]
                sound = np.array([p == "\n" or x.strip() == x != "" for p, x in zip(texts, body)], bool)
                ids = [e.ids if s else [] for e, s in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), sound)]
                flat, length = np.fromiter(chain.from_iterable(ids), np.uint32), np.where(sound, list(map(len, ids)), -1)
            else:
                flat, length = self._together(pc.binary_join_element_wise("\n", some, "") if skip else some)
                length = length - skip
            self._add(some, flat, skip, length)
        return at

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces, bounds = self._cut(texts)
        if not len(pieces):
            return [np.empty(0, np.uint32) for _ in texts]
        distinct = pieces.dictionary_encode()
        code = self._learn(distinct.dictionary)[distinct.indices.to_numpy()]
        length = self.length[code]
        odd = np.diff(np.r_[0, np.cumsum(length < 0)][bounds]) > 0
        length = np.maximum(length, 0)
        ends = np.cumsum(length)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.first[code] - ends + length, length)]
        edges = np.r_[0, ends][bounds]
        out = [ids[lo:hi] for lo, hi in zip(edges[:-1], edges[1:])]
        at = np.flatnonzero(odd)
        for i, e in zip(at, self.tokenizer.encode_batch_fast([texts[i] for i in at], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; the pieces of some million characters are looked up together."""
        parts = np.cumsum([len(t) for t in texts]) // CHARS
        edges = np.r_[0, np.flatnonzero(np.diff(parts)) + 1, len(texts)]
        return [ids for lo, hi in zip(edges[:-1], edges[1:]) for ids in self._encode(texts[lo:hi])]


def encoded_shards(docs: DataFrame, tokenizer: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """The written shards: part, shard, first (ids before it in its part), doc_ids, lengths and payload.

    ``tokenizer`` is the path of a tokenizer file, the same on every machine.
    NULL and empty texts are the end id alone; ids ascend, NULL first; rows
    that share an id follow each other in the order of their texts; further
    columns play no part.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Kept by the Python worker, so that its later tasks know the pieces of earlier ones; this module itself may not be there.
        kept = vars(sys.modules.setdefault("_fieldtally_encoders", ModuleType("_fieldtally_encoders")))
        seen = (tokenizer, os.stat(tokenizer).st_mtime_ns)
        if seen not in kept:
            kept[seen] = Encoder(tokenizer)
        encoder, part = kept[seen], TaskContext.get().partitionId()
        ids, names, size, first, shard = [], [], 0, 0, 0

        def packed() -> pd.DataFrame:
            return pd.DataFrame({
                "part": [part], "shard": [shard], "first": [first], "doc_ids": [names], "lengths": [[len(x) for x in ids]],
                "payload": [WaveletMatrix.of(np.concatenate(ids)).to_bytes()],
            })

        for frame in frames:
            for at in range(0, len(frame), 2_500):
                piece = frame.iloc[at : at + 2_500]
                for name, known, coded in zip(piece["doc_id"], piece["named"], encoder.encode(piece["text"].tolist())):
                    if size and size + len(coded) + 1 > shard_ids:
                        yield packed()
                        first, shard = first + size, shard + 1
                        ids, names, size = [], [], 0
                    ids.append(np.r_[coded, np.uint32(end_id)].astype(np.uint32))
                    names.append(int(name) if known else None)
                    size += len(coded) + 1
        if size:
            yield packed()

    ranged = base.repartitionByRange(*order).sortWithinPartitions(*order)
    named = ranged.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text")
    return settle(named.mapInPandas(write, "part int, shard int, first long, doc_ids array<long>, lengths array<long>, payload binary"), "tokens")


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from the shards."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, first, names, lengths, payload in zip(*(frame[c] for c in ("part", "first", "doc_ids", "lengths", "payload"))):
                ids, lengths = WaveletMatrix.from_bytes(payload).ids().astype("<u4"), np.asarray(lengths, np.int64)
                ends = np.cumsum(lengths)
                yield pd.DataFrame({
                    "part": part, "doc_id": pd.array(list(names), "Int64"), "start": first + ends - lengths, "n_tokens": lengths,
                    "ids_crc32": [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths)],
                })

    read_back = shards.mapInPandas(read, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    totals = shards.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    # One row per written part.
    return read_back.join(F.broadcast(before), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


@query("op5_wavelet")
def op5_wavelet(spark, sf_dir):
    """Every document's ids, written and read back."""
    import public_tokenizers

    return read_documents(encoded_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))

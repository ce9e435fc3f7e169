"""Hashes of words and word runs for a batch of texts at once, in numpy.

All texts of a batch are laid end to end; a token's hash is a polynomial over
its bytes, taken from one running sum. Nothing here loops over tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Class of each byte: 0 white space, 1 all else (words).
WORDS = np.where(_SPACE, 0, 1).astype(np.uint8)
#: 0 white space, 1 letters and digits (and all of UTF-8 beyond ASCII), 2 symbols.
RUNS = np.array([0 if _SPACE[i] else 1 if i >= 128 or chr(i).isalnum() else 2 for i in range(256)], np.uint8)

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)


class _Cache(dict):
    """Empty again wherever it is sent."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n + 1, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Tokens of a list of byte strings: ``start`` and ``end`` in ``data``, hash ``h``, and ``bounds``, where text i has
    tokens bounds[i] to bounds[i + 1]."""

    def __init__(self, texts: list[bytes], classes: np.ndarray = WORDS):
        self.data = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(self.data, np.uint8)
        kind = classes[buf]
        edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        cuts = np.concatenate(([0], edge, [len(buf)]))
        solid = kind[cuts[:-1]] > 0
        self.start, self.end = cuts[:-1][solid], cuts[1:][solid]
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(self.start, first)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * _power(_BASE, len(buf) - 1), dtype=np.uint64, out=total[1:])
        self.h = mix((total[self.end] - total[self.start]) * _power(_BACK, len(buf))[self.start])

    def __len__(self) -> int:
        return len(self.h)

    def text_of(self) -> np.ndarray:
        """The text's number for every token."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def runs(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n tokens from each position (the last n - 1 positions are cut off); order matters."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size, out = len(h) - n + 1, np.full(len(h) - n + 1, seed, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[k : k + size]
    return mix(out)


def run_inside(bounds: np.ndarray, n: int, total: int) -> np.ndarray:
    """For each position of ``runs``: whether its n tokens lie in one text."""
    room = np.zeros(max(0, total - n + 1), bool)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= n:
            room[lo : hi - n + 1] = True
    return room


def sliced(frames: Iterable, text: str = "text", limit: int = 2_000_000) -> Iterator[tuple[object, list[bytes]]]:
    """Cut pandas batches so that the texts of a piece have about ``limit`` bytes (more only if one text has);
    yields the piece and its texts as UTF-8, NULL as empty."""
    for frame in frames:
        texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in frame[text]]
        at, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > limit:
                yield frame.iloc[at:i], texts[at:i]
                at, size = i, 0
            size += len(t) + 1
        if at < len(texts):
            yield frame.iloc[at:], texts[at:]

"""Numpy helpers for Arrow batches of texts: flat bytes, word places, hashes of byte ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts, one after the other, and where each starts (and the last ends)."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``size`` bytes of text each; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Ranges:
    """Hashes of byte ranges: polynomials modulo 2**64, from running sums."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                steps = np.full(n, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.inverses[starts]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes that no text border cuts, and for each text the number
    of runs before it (and in all)."""
    edge = np.zeros(len(member) + 1, bool)
    edge[offsets] = True
    begins = member.copy()
    begins[1:] &= ~member[:-1] | edge[1:-1]
    stops = member.copy()
    stops[:-1] &= ~member[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it (and in all)."""
    return runs(~WHITE[data], offsets)


#: Bytes with A to Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_CHUNK = 1 << 20


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges that do not overlap: sums of a mixed number for each byte and its place. Unlike a
    polynomial modulo a power of two it has no structure that regular texts could meet."""
    out = np.zeros(len(starts), U64)
    sizes = ends - starts
    upto = np.cumsum(sizes)
    low = 0
    while low < len(starts):
        before = upto[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(upto, before + _CHUNK, "right")))
        begin = upto[low:high] - sizes[low:high] - before
        place = np.arange(upto[high - 1] - before) - np.repeat(begin, sizes[low:high])
        bytes_of = data[np.repeat(starts[low:high], sizes[low:high]) + place].astype(U64)
        out[low:high] = np.add.reduceat(mixed(bytes_of + (place.astype(U64) << U64(8)) + U64(1)), begin)
        low = high
    return mixed(out + sizes.astype(U64))


_WORDS = 1 << 18


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of at least eight bytes, which may overlap: sums of a mixed number for each eight bytes
    and their place. As with ``token_hashes`` regular texts have nothing to meet in."""
    out = np.zeros(len(starts), U64)
    if not len(starts):
        return out
    eights = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
    sizes = ends - starts
    counts = -(-sizes // 8)
    salts = mixed(np.arange(1, int(counts.max()) + 1, dtype=U64))
    upto = np.cumsum(counts)
    low = 0
    while low < len(starts):
        before = upto[low] - counts[low]
        high = max(low + 1, int(np.searchsorted(upto, before + _WORDS, "right")))
        n = counts[low:high]
        begin = upto[low:high] - n - before
        place = np.arange(upto[high - 1] - before) - np.repeat(begin, n)
        # The last eight bytes end with the range and may overlap those before.
        at = np.minimum(np.repeat(starts[low:high], n) + 8 * place, np.repeat(ends[low:high] - 8, n))
        out[low:high] = np.add.reduceat(mixed(eights[at] ^ salts[place]), begin)
        low = high
    return mixed(out + sizes.astype(U64))

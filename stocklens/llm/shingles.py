"""Distinct word shingles of whole texts as 64-bit hashes, and their minwise signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 1 << 20  # bytes of text hashed at a time

_R = np.random.RandomState(20240611)
_ODD = _R.randint(0, 2**63, 40, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = _ODD[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a byte buffer."""
    inside = ~SEPARATOR[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    within = np.arange(lengths.sum()) - np.repeat(first, lengths)
    powers = np.full(lengths.max(), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[within]
    return starts, _mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64) * _ODD[1])


def _chunks(texts: list[str | None]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
        size += len(chunk[-1]) + 1
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct ``words``-word shingles.

    A-Z is lower-cased; words are runs of bytes other than space and \\t to \\r. A text
    with fewer words gives its whole sequence as one shingle, one without words none.
    """
    for chunk in _chunks(texts):
        data = np.frombuffer(b" ".join(chunk) + b" ", np.uint8)
        bounds = np.cumsum([0] + [len(x) + 1 for x in chunk])
        starts, hashes = word_hashes(data)
        first = np.searchsorted(starts, bounds)
        n = len(hashes) - words + 1
        if n > 0:
            rolled = np.zeros(n, np.uint64)
            for k in range(words):
                rolled += hashes[k : k + n] * _ODD[2 + k]
            rolled = _mixed(rolled)
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            if hi - lo >= words:
                yield np.unique(rolled[lo : hi - words + 1])
            elif hi > lo:
                short = (hashes[lo:hi] * _ODD[2 : 2 + hi - lo]).sum() + np.uint64(hi - lo)
                yield _mixed(np.array([short], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """``size`` minwise values of each nonempty set, as rows of int32."""
    r = np.random.RandomState(77)
    flips = r.randint(0, 2**32, size, dtype=np.uint64).astype(np.uint32)
    factors = r.randint(0, 2**31, size, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), size), np.uint32)
    for k in range(size):
        x = (values ^ flips[k]) * factors[k]
        x ^= x >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(x * np.uint32(0x2C1B3C6D), offsets)
    return out.view(np.int32)

"""Word and window hashes of a batch of texts, as numpy arrays.

All functions work on whole batches: no step is taken word by word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are hashed in runs of about so many bytes; a longer text makes a run of its own.
RUN_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finisher)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def runs(texts: pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text each."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + size, "right")))
        yield first, last
        first = last


def word_spans(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, ends, offsets)`` of the words of ``texts``; null is empty.

    Words of text ``i`` are those from ``offsets[i]`` to ``offsets[i + 1]``.
    """
    parts = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    joined = b" ".join(parts) + b" " * 9
    data = np.frombuffer(joined, np.uint8)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        turn = np.concatenate([[0], turn])
    starts, ends = turn[0::2], turn[1::2]
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    return data, starts, ends, np.searchsorted(starts, bounds)


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: a 64-bit hash for each word, and where each text's begin."""
    data, starts, ends, offsets = word_spans(texts, lower)
    sizes = ends - starts
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = mix(sizes.astype(_U) * _ODD)
    active, at = np.arange(len(starts)), 0
    while len(active):
        left = sizes[active] - at
        chunk = eight[starts[active] + at]
        short = left < 8
        keep = np.where(short, (_U(1) << (np.minimum(left, 7).astype(_U) * _U(8))) - _U(1), ~_U(0))
        out[active] = mix((out[active] ^ (chunk & keep)) * _ODD)
        at += 8
        active = active[left > 8]
    return out, offsets


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive entries; there are ``len - size + 1``."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, _U)
    out = np.full(count, size, _U)
    for i in range(size):
        out = out * _U(0xD1342543DE82EF95) + hashes[i:i + count]
    return mix(out)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)

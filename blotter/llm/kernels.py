"""Numpy kernels over the UTF-8 bytes of a batch of texts.

All of them work on one flat byte buffer with document offsets, so a batch
costs a fixed number of vector passes whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# A fixed odd multiplier and the finishing constants of a 64-bit mixer.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n, kept between calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        tables = []
        for b in (BASE, inverse):
            t = np.full(size, b, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def flatten(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated bytes and the n + 1 offsets of the documents."""
    ends = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=ends[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), ends


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte is left alone."""
    return _LOWER[data]


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the document it lies in."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_IS_SPACE[data]
    begin = inside[1:-1] & ~inside[:-2]
    inner = ends[1:-1]
    inner = inner[inner < len(data)]
    begin[inner] = inside[1:-1][inner]  # a word never crosses two documents
    starts = np.flatnonzero(begin)
    last = inside[1:-1] & ~inside[2:]
    cut = inner[inner > 0] - 1
    last[cut] = inside[1:-1][cut]
    stops = np.flatnonzero(last) + 1
    doc = np.searchsorted(ends, starts, side="right") - 1
    return starts, stops, doc


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from one prefix sum."""
    power, inverse = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * power[: len(data)], out=prefix[1:])
    h = (prefix[stops] - prefix[starts]) * inverse[starts]
    return mix(h ^ (stops - starts).astype(np.uint64) * MIX_B)


def slices(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``limit`` bytes, with the number of the first."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield first, texts[first : k + 1]
            first, held = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    import pyarrow as pa

    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]

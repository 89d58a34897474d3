"""Vectorised word and shingle hashing over Arrow batches of texts.

Words are the runs of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text,
with A-Z read as a-z.  Many texts are hashed in one numpy pass; work is cut
into chunks of a few MB of text, so memory does not follow the batch size
(one text is always hashed whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit (splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null reads as empty."""
    return [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``limit`` bytes (one text at least)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and each text's offsets in them (len + 1)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lens = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(lens)))
    inside = ~IS_SPACE[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), first
    size = ends - starts
    before = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(before, size)
    part = LOWER_VALUES[buf[inside]] * powers(int(size.max()))[at]
    return mix(np.add.reduceat(part, before) + size.astype(np.uint64)), first


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text; a text
    with fewer words has its whole word sequence as one, one without words none."""
    words, first = word_hashes(texts)
    n = np.diff(first)
    pw = powers(width)
    out = []
    if len(words) >= width:
        full = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for j in range(width):
            full += words[j : j + len(full)] * pw[j]
        full = mix(full)
    for i in range(len(texts)):
        a, k = int(first[i]), int(n[i])
        if k == 0:
            out.append(np.zeros(0, dtype=np.uint64))
        elif k < width:
            short = (words[a : a + k] * pw[:k]).sum(dtype=np.uint64) + U64(k) * U64(0xD1B54A32D192ED03)
            out.append(mix(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.unique(full[a : a + k - width + 1]))
    return out

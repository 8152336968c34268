"""Byte-level text helpers that run inside Arrow tasks.

Texts are handled as UTF-8 bytes.  A null text counts as an empty one everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: maximal runs of letters, digits and non-ASCII characters."""
    return text.translate(NORMAL).split()


def byte_column(column: pa.Array) -> list[bytes]:
    """An Arrow string column as bytes, nulls as b''."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts in runs of about ``size`` bytes, so that work arrays stay small; a longer text is a run of its own."""
    out: list[bytes] = []
    held = 0
    for text in texts:
        out.append(text)
        held += len(text)
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch in one array and the n + 1 offsets of the texts in it."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def segment_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a small-integer array over each segment; empty segments give 0."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an unsigned array."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values; one entry per start, len - width + 1 in all."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15 | 1) + values[k : k + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out

"""Word shingles and minimum hashes over whole Arrow batches, vectorised in numpy.

The text bytes of a batch are hashed in one pass: a prefix sum of
``table[byte] * BASE**position`` (mod 2**64) makes the hash of any byte range two
look-ups, so words, and sums over runs of words, need no Python loop. Only the
distinct values and the minima are taken document by document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BASE = U(int(_rng.integers(0, 2**63)) * 2 + 1)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_LETTER = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (the murmur finaliser)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x = x * U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[key] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def words_of(data: np.ndarray, bounds: np.ndarray, fold: bool = True):
    """Word hashes of concatenated UTF-8 texts.

    ``data`` holds the bytes, ``bounds`` the n+1 offsets of the texts in it.
    Returns (hashes of all words, n+1 offsets of the texts in them).
    """
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = word[inner]  # a text's first byte begins a word
    ends = np.empty(len(data), bool)
    ends[:-1] = word[:-1] & (~word[1:] | begins[1:])
    ends[-1] = word[-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    letters = _LETTER[_LOWER] if fold else _LETTER
    np.cumsum(letters[data] * up[: len(data)], out=total[1:])
    hashes = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    return hashes, np.searchsorted(s, bounds)


def shingles_of(hashes: np.ndarray, at: np.ndarray, width: int = 5):
    """Hashes of all runs of ``width`` words, with repeats.

    A text of fewer words has its whole sequence as its only shingle, one without
    words has none. Returns (hashes, n+1 offsets of the texts in them).
    """
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    to = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(to[-1], np.uint64)
    if len(out) == 0:
        return out, to
    first = np.repeat(at[:-1] - to[:-1], count) + np.arange(to[-1])
    size = np.repeat(np.minimum(n, width), count)
    full = size == width
    out[:] = size.astype(np.uint64) * _PLACE[-1]
    for k in range(width):
        has = full if k else slice(None)
        at_k = first if k == 0 else first[full] + k
        out[has] += hashes[at_k] * _PLACE[k]
    for k in range(1, width - 1):  # what shorter texts have
        short = np.flatnonzero(~full & (size > k))
        out[short] += hashes[first[short] + k] * _PLACE[k]
    return mix(out), to


class Permutations:
    """``count`` universal hashes a*x+b mod 2**64 (a odd, so each permutes the values)."""

    def __init__(self, count: int, seed: int):
        r = np.random.Generator(np.random.PCG64(seed))
        self.a = (r.integers(0, 2**63, count, dtype=np.uint64) * U(2) + U(1))[:, None]
        self.b = r.integers(0, 2**63, count, dtype=np.uint64)[:, None] * U(2)

    def minima(self, values: np.ndarray, block: int = 1024) -> np.ndarray:
        """The minimum of every permutation over ``values`` (at least one)."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(values), block):
            h = self.a * values[None, i : i + block]
            h += self.b
            np.minimum(least, h.min(axis=1), out=least)
        return least


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array without nulls, and the n+1 offsets."""
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 19):
    """Slices of a batch with at most about ``most`` bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)

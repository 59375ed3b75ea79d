"""Canonical length-limited Huffman codes over integer ids, vectorised in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits, by package-merge; 0 for absent ids."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    if n > 1 << most:
        raise ValueError(f"{n} symbols don't fit in codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaf, row = [], np.zeros(0)
    for _ in range(most):
        merged = np.concatenate([weights, row])
        at = np.argsort(merged, kind="stable")
        leaf.append(at < n)
        merged = merged[at]
        even = len(merged) // 2 * 2
        row = merged[:even:2] + merged[1:even:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(leaf):
        leaves = int(flags[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


class Code:
    """A canonical code: shorter codes first, then smaller ids."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths = np.asarray(lengths, np.uint8)
        self.most = int(lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        size = lengths[order].astype(np.int64)
        spans = (1 << (self.most - size)).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(spans)])
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (starts[:-1] >> (self.most - size)).astype(np.uint64)
        self.symbol = np.zeros(1 << self.most, np.uint32)
        self.width = np.zeros(1 << self.most, np.uint8)
        self.symbol[: starts[-1]] = np.repeat(order, spans)
        self.width[: starts[-1]] = np.repeat(size, spans)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids`` as bytes, and the bit offset of every ``every``-th id."""
        if len(ids) == 0:
            return b"", np.zeros(0, np.int64)
        size = self.lengths[ids].astype(np.int64)
        if not size.all():
            raise ValueError("an id has no code")
        at = np.cumsum(size) - size
        bits = int(at[-1] + size[-1])
        out = np.zeros(bits // 64 + 2, np.uint64)
        word, room = at >> 6, 64 - (at & 63) - size
        code = self.codes[ids]
        high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] = np.add.reduceat(high, first)  # codes don't overlap, so sums are unions
        over = np.flatnonzero(room < 0)
        out[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
        return out.byteswap().tobytes()[: (bits + 7) // 8], at[::every]

    def decode(self, data: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of segments that begin at the bits ``starts`` and have ``counts`` ids, by table look-ups on all segments at once."""
        total = int(counts.sum())
        out = np.empty(total, np.uint32)
        if total == 0:
            return out
        padded = np.frombuffer(data + bytes(8), np.uint8)
        window = np.ndarray((len(padded) - 4,), ">u4", padded, strides=(1,))
        at, to = starts.astype(np.int64), np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        at, to, left = at[order], to[order], counts[order]
        shift, mask = 32 - self.most, (1 << self.most) - 1
        alive = len(left)
        for k in range(int(left[0])):
            while alive and left[alive - 1] <= k:
                alive -= 1
            p = at[:alive]
            peek = (window[p >> 3].astype(np.int64) >> (shift - (p & 7))) & mask
            out[to[:alive] + k] = self.symbol[peek]
            p += self.width[peek]
        return out

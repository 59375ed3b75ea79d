"""Hashed byte n-grams of whole Arrow batches, and linear models over their frequencies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .shingles import bytes_of, pieces

SPACE = 1 << 16  # of hashed n-grams
ORDERS = (2, 3, 4)
_MULTIPLY = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
#: Lower case for ASCII; all that is no letter becomes a space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def fold(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes in lower case (ASCII and Latin-1 letters), other ASCII as spaces."""
    out = _FOLD[data]
    upper = (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[:-1] == 0xC3)
    out[1:][upper] += 0x20
    return out


def hashes(data: np.ndarray, bounds: np.ndarray):
    """For each order the hashed n-gram that begins at each byte; SPACE where none fits in its text."""
    padded = np.concatenate([fold(data), np.zeros(4, np.uint8)]).astype(np.uint32)
    n = len(data)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    packed = padded[:n].copy()
    for order in range(2, max(ORDERS) + 1):
        packed |= padded[order - 1 : order - 1 + n] << np.uint32(8 * (order - 1))
        if order in ORDERS:
            h = ((packed * _MULTIPLY[order % 3] + np.uint32(order)) >> np.uint32(16)).astype(np.int32)
            h[left < order] = SPACE
            yield h


def parts(texts: pa.Array, most: int = 1 << 18):
    """Slices of about ``most`` bytes, so that what is made for each byte stays small."""
    for batch in pieces(pa.RecordBatch.from_arrays([texts], names=["x"]), "x", most):
        yield batch.column("x")


def counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, frequencies) of each text; frequencies are scaled to length 1."""
    return [x for part in parts(texts) for x in _counts(part)]


def _counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    data, bounds = bytes_of(texts)
    if len(data) == 0:
        return [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * len(texts)
    every = np.stack(list(hashes(data, bounds)), axis=1)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        own, n = np.unique(every[a:b], return_counts=True)
        keep = own < SPACE
        own, n = own[keep], n[keep].astype(float)
        out.append((own.astype(np.int32), (n / max(np.sqrt((n**2).sum()), 1e-9)).astype(np.float32)))
    return out


def mean_scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """For each text the mean weight of its n-grams, under each column of ``weights`` (SPACE + 1 rows, the last zero)."""
    found = [_mean_scores(part, weights) for part in parts(texts)]
    return np.concatenate(found) if found else np.zeros((0, weights.shape[1]))


def _mean_scores(texts: pa.Array, weights: np.ndarray, cells: int = 1 << 20) -> np.ndarray:
    data, bounds = bytes_of(texts)
    out = np.zeros((len(texts), weights.shape[1]))
    if len(data) == 0:
        return out
    every, step = list(hashes(data, bounds)), max(1, cells // max(1, weights.shape[1]))
    for a in range(0, len(data), step):  # so many table cells at a time, however long a text
        b = min(len(data), a + step)
        total = sum(weights[h[a:b]] for h in every)
        first, last = np.searchsorted(bounds, a, side="right") - 1, np.searchsorted(bounds, b, side="left")
        own = np.arange(first, last)
        own = own[np.minimum(bounds[own + 1], b) > np.maximum(bounds[own], a)]
        out[own] += np.add.reduceat(total, np.maximum(bounds[own], a) - a, axis=0, dtype=np.float64)
    return out / np.maximum(np.diff(bounds), 1)[:, None]


def svm(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, epochs: int = 8, penalty: float = 1e-4, seed: int = 5, balance: bool = True) -> np.ndarray:
    """Weights of a linear support vector machine, by averaged stochastic subgradient steps (the frequencies sum to a constant, so no bias is needed)."""
    w, mean = np.zeros(SPACE + 1), np.zeros(SPACE + 1)
    share = {s: 0.5 * len(signs) / max(1, (signs == s).sum()) for s in (-1, 1)} if balance else {-1: 1.0, 1: 1.0}
    order, scale, t, taken = np.random.default_rng(seed), 1.0, 0, 0
    for epoch in range(epochs):
        for i in order.permutation(len(rows)):
            t += 1
            at, x = rows[i]
            rate = 1.0 / (penalty * (t + 1.0 / penalty))
            scale *= 1 - rate * penalty
            if signs[i] * scale * (w[at] @ x) < 1:
                w[at] += (rate * signs[i] * share[int(signs[i])] / scale) * x
        if epoch >= epochs // 2:
            mean += scale * w
            taken += 1
    return mean / max(1, taken)


def platt(values: np.ndarray, truth: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of the logistic curve 1 / (1 + exp(-(a * value + b))) that fits a truth of 0 and 1, with targets drawn in a little."""
    if len(values) == 0 or truth.min() == truth.max():
        return 1.0, 0.0
    scale = max(float(np.abs(values).std()), float(np.abs(values).mean()), 1e-9)
    x = np.stack([values / scale, np.ones(len(values))], axis=1)
    pos, neg = truth.sum(), len(truth) - truth.sum()
    y = np.where(truth == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-6 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

"""Document quality by co-training of a content view and a page-metadata view.

Content: a linear model over hashed n-grams of letters. Metadata: where a page is from
(source, language) and its layout (length, lines, shares of capitals, digits and signs),
each number cut at quantiles, in a logistic model. Neither sees what the other does.

Each starts from the labelled examples. For ROUNDS rounds each scores a pool without
labels, and its most confident ones, by class as in the labels, become examples of the
other. Both are then calibrated on labelled documents kept apart, and the score of a
document is the chance from the sum of their calibrated log-odds, weighted as fits best
there. Fitting takes at most SAMPLE labelled rows of each class and POOL rows without
label (of which ROUNDS * STEP at most become examples of a view), chosen by a hash of id
and text, of texts up to LONGEST characters; all documents are scored.

Edge cases: a null text is scored as an empty one; null source or language is a value of
its own; without labels of both classes every score is the share of good rows; null
labels, and all labels of an id that has both, are ignored; equal rows are one example;
repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_of_id, ship, table
from .ngrams import counts, logistic, mean_scores, platt, svm
from .sampling import agreed, drawn, fetched, hashed
from .shingles import bytes_of, pieces

SAMPLE = 1500
POOL = 2000
ROUNDS = 4
STEP = 100
LONGEST = 50_000
BINS = 8
_HASHED = 64
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[65:91] = 1  # capitals
_CLASSES[97:123] = 2
_CLASSES[128:] = 3
_CLASSES[48:58] = 4
_CLASSES[32] = 5
_CLASSES[10] = 6
for _c in b"!\"#$%&'*+/:;<=>@[\\]^_`{|}~":
    _CLASSES[_c] = 7


def layout(texts: pa.Array) -> np.ndarray:
    """Length and shares of kinds of characters of each text."""
    data, bounds = bytes_of(texts)
    n = np.diff(bounds)
    kinds = np.zeros((len(n), 8))
    if len(data):
        which = np.repeat(np.arange(len(n)), n) * 8 + _CLASSES[data]
        kinds = np.bincount(which, minlength=8 * len(n)).reshape(-1, 8).astype(float)
    size = np.maximum(n, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2] + kinds[:, 3], 1)
    return np.stack([np.log1p(n), kinds[:, 1] / letters, kinds[:, 3] / letters, kinds[:, 4] / size, kinds[:, 5] / size, kinds[:, 6] / size,
        kinds[:, 7] / size, size / (kinds[:, 5] + kinds[:, 6] + 1)], axis=1)


def _slot(value: str | None, salt: str) -> int:
    return zlib.crc32(f"{salt}|{'-' if value is None else '+' + value}".encode()) % _HASHED


@dataclass
class Meta:
    """The metadata view: cuts of the numbers, and a weight for each slot."""

    cuts: np.ndarray
    weights: np.ndarray

    def slots(self, numbers: np.ndarray, source: list, lang: list) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, numbers[:, i]) + i * (BINS + 1) for i, c in enumerate(self.cuts)], axis=1)
        first = len(self.cuts) * (BINS + 1)
        names = np.array([[first + _slot(s, "source"), first + _HASHED + _slot(x, "lang")] for s, x in zip(source, lang)], np.int64).reshape(-1, 2)
        return np.concatenate([binned, names], axis=1)

    def margins(self, slots: np.ndarray) -> np.ndarray:
        return self.weights[slots].sum(axis=1) + self.weights[-1]


def _meta_fit(meta: Meta, slots: np.ndarray, y: np.ndarray) -> None:
    size = len(meta.cuts) * (BINS + 1) + 2 * _HASHED + 1
    x = np.zeros((len(slots), size))
    x[np.arange(len(slots))[:, None], slots] = 1
    x[:, -1] = 1
    w, share = np.zeros(size), np.where(y == 1, 0.5 * len(y) / max(1, y.sum()), 0.5 * len(y) / max(1, (1 - y).sum()))
    for _ in range(12):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.eye(size), x.T @ (share * (y - p)) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    meta.weights = w


@dataclass
class Model:
    content: np.ndarray
    meta: Meta | None
    curves: list[tuple[float, float]]
    mix: np.ndarray

    def scores(self, texts: pa.Array, source: list, lang: list) -> np.ndarray:
        """(content, metadata, both) for each document."""
        if self.meta is None:
            return np.tile(logistic(self.mix[:1]), (len(texts), 3))
        c = self.curves[0][0] * mean_scores(texts, self.content)[:, 0] + self.curves[0][1]
        m = self.curves[1][0] * self.meta.margins(self.meta.slots(layout(texts), source, lang)) + self.curves[1][1]
        return np.stack([logistic(c), logistic(m), logistic(self.mix[0] + self.mix[1] * c + self.mix[2] * m)], axis=1)


def fit(labelled: list[tuple], pool: list[tuple], rounds: int = ROUNDS, step: int = STEP) -> Model:
    """A model from (text, source, lang, label) and (text, source, lang) rows."""
    y = np.array([r[3] for r in labelled], int)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros((0x10001, 1), np.float32), None, [], np.array([np.log(share / (1 - share))]))
    rows = [r[:3] for r in labelled] + list(pool)
    texts = pa.array([r[0] for r in rows], pa.string())
    features, numbers = counts(texts), layout(texts)
    meta = Meta(np.quantile(numbers, np.arange(1, BINS + 1) / (BINS + 1), axis=0).T, np.zeros(1))
    slots = meta.slots(numbers, [r[1] for r in rows], [r[2] for r in rows])
    known = np.arange(len(y))
    apart = known % 4 == 3  # for calibration
    own: list[dict[int, int]] = [{i: y[i] for i in known[~apart]}, {i: y[i] for i in known[~apart]}]
    share = y.mean()
    for turn in range(rounds + 1):
        at = np.array(list(own[0]))
        w = svm([features[i] for i in at], np.where(np.array(list(own[0].values())) == 1, 1, -1), epochs=4)
        at = np.array(list(own[1]))
        _meta_fit(meta, slots[at], np.array(list(own[1].values())))
        margins = [np.array([w[f[0]] @ f[1] for f in features]), meta.margins(slots)]
        if turn == rounds or not len(pool):
            break
        for view in (0, 1):
            free = np.array([i for i in range(len(y), len(rows)) if i not in own[1 - view]], int)
            ranked = free[np.argsort(margins[view][free], kind="stable")]
            bad, good = max(1, round(step * (1 - share))), max(1, round(step * share))
            own[1 - view].update({i: 0 for i in ranked[:bad] if margins[view][i] < 0})
            own[1 - view].update({i: 1 for i in ranked[len(ranked) - good :] if margins[view][i] > 0})
    content = w.astype(np.float32)[:, None]
    content[-1] = 0
    raw = mean_scores(texts, content)[:, 0]
    curves = [platt(raw[: len(y)][apart], y[apart]), platt(margins[1][: len(y)][apart], y[apart])]
    z = np.stack([np.ones(len(y)), curves[0][0] * raw[: len(y)] + curves[0][1], curves[1][0] * margins[1][: len(y)] + curves[1][1]], axis=1)[apart]
    return Model(content, meta, curves, _mixed(z, y[apart]))


def _mixed(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.array([0.0, 0.5, 0.5])
    for _ in range(50):
        p = logistic(z @ w)
        w = w + np.clip(np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(3), z.T @ (y - p) - 0.5 * (w - [0, 0.5, 0.5])), -1, 1)
    return np.array([w[0], max(w[1], 0.0), max(w[2], 0.0)])


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, pool: int = POOL, longest: int = LONGEST) -> tuple[list[tuple], list[tuple]]:
    """Bounded labelled rows of each class, and rows without any label, by the smallest hashes of id and text."""
    scratch = Scratch(docs.sparkSession, "quality")
    short = docs.where(F.col("text").isNotNull() & (F.char_length("text") <= longest))
    h, columns = hashed(31, "doc_id", "text"), [F.col("text"), F.col("source").cast("string"), F.col("lang").cast("string")]
    rows = short.select(F.col("doc_id").alias("id"), h.alias("h"))
    labelled = fetched(short, drawn(rows.join(agreed(labels, "doc_id", "quality"), "id"), scratch, most, 2), "doc_id", h, columns)
    marked = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("id")).distinct()
    others = rows.where("id is not null").join(marked, "id", "left_anti").withColumn("label", F.lit(0))
    free = fetched(short, drawn(others, scratch, pool, 1), "doc_id", h, columns)
    scratch.clear()
    return labelled, [r[:3] for r in free]


def score(docs: DataFrame, model: Model, keep: list[Column] = ()) -> DataFrame:
    """The columns ``keep`` plus content_score, meta_score and score of each whole text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("__text"), F.col("source").cast("string").alias("__source"),
        F.col("lang").cast("string").alias("__lang"))
    kept = source.columns[:-3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "__text", 1 << 20):
                found = sent.value.scores(batch.column("__text"), batch.column("__source").to_pylist(), batch.column("__lang").to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(found[:, i]) for i in range(3)]], names=[*kept, *names])

    names = ["content_score", "meta_score", "score"]
    schema = source.select(kept).schema
    for x in names:
        schema = schema.add(x, "double")
    return source.mapInArrow(run, schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    held_out = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    model = fit(*sample(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out)))
    return score(docs, model, [F.col("doc_id"), held_out.alias("held_out")]).withColumn("kept", F.col("score") >= 0.5)

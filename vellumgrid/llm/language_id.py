"""Language identification in two levels: first the family, then the language in it.

One linear support vector machine for each family says how a text differs from the other
families; within the best family, one-versus-one machines of its languages vote. All work
on the frequencies of hashed byte n-grams of the whole text, so scoring is table look-ups
in numpy. The machines are fitted on at most SAMPLE labelled rows of each language,
chosen by a hash of id and text, of texts up to LONGEST characters; that sample, and
nothing that grows with the input, comes to the driver. Languages are learned from the
commonest down to LANGUAGES of them and as long as their machines, families and pairs,
are MACHINES at most (some 256 kB each); rarer values of a dirty column are no examples.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is every
text if nothing can be learned; with one learned language all others get it; rows with a
null language or id are no examples but get a prediction; repeated rows are predicted
alike; other columns pass through where asked for.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_of_id, ship, table
from .ngrams import counts, logistic, mean_scores, platt, svm
from .sampling import drawn, fetched, hashed
from .shingles import bytes_of, pieces

SAMPLE = 1000
LONGEST = 50_000
LANGUAGES = 100
MACHINES = 256
UNKNOWN = "und"
#: What the pipeline asks of a score; clean texts of a word or two come near to one half.
LEAST = 0.3
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb yi fy",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be bg mk sr hr bs sl pl cs sk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """A language's family; those that aren't listed are one family together."""
    return _FAMILY.get(lang.split("-")[0].lower(), "other")


def learnable(langs: list[str], machines: int = MACHINES) -> list[str]:
    """The first of ``langs``, in order, whose families and pairs need no more than ``machines``."""
    out: list[str] = []
    sizes: dict[str, int] = {}
    for x in langs:
        more = dict(sizes)
        more[family(x)] = more.get(family(x), 0) + 1
        if len(more) + sum(n * (n - 1) // 2 for n in more.values()) > machines:
            continue
        sizes = more
        out.append(x)
    return out


@dataclass
class Model:
    """Machines as columns of one table: families first, then pairs of languages."""

    families: list[str]
    languages: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    curves: list[tuple[float, float]]

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        if not self.families:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        raw = mean_scores(texts, self.weights)
        p = np.stack([logistic(a * raw[:, i] + b) for i, (a, b) in enumerate(self.curves)], axis=1)
        n = len(self.families)
        best = p[:, :n].argmax(axis=1)
        sure = p[np.arange(len(p)), best] / np.maximum(p[:, :n].sum(axis=1), 1e-12)
        lang, score = np.empty(len(p), object), sure.copy()
        where = {pair: n + i for i, pair in enumerate(self.pairs)}
        for k, name in enumerate(self.families):
            rows, own = np.flatnonzero(best == k), self.languages[name]
            votes, chance = np.zeros((len(rows), len(own))), np.ones((len(rows), len(own)))
            for i, j in combinations(range(len(own)), 2):
                q = p[rows, where[own[i], own[j]]]
                votes[:, i] += q >= 0.5
                votes[:, j] += q < 0.5
                chance[:, i] = np.minimum(chance[:, i], q)
                chance[:, j] = np.minimum(chance[:, j], 1 - q)
            # most votes, then the better chance, then the later name (own is in order); chances are below 2
            rank = 2 * votes + chance
            top = len(own) - 1 - rank[:, ::-1].argmax(axis=1) if len(own) else np.zeros(len(rows), int)
            lang[rows] = np.array(own, object)[top]
            score[rows] *= chance[np.arange(len(rows)), top]
        return lang.tolist(), score.tolist()


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model from (text, language) examples; languages beyond what MACHINES allow are left out, rarer ones first."""
    seen = Counter(x for _, x in rows)
    may = set(learnable(sorted(seen, key=lambda x: (-seen[x], x))))
    rows = [r for r in rows if r[1] in may]
    langs = sorted(may)
    texts = pa.array([x for x, _ in rows], pa.string())
    features = counts(texts)
    fam = np.array([family(x) for _, x in rows])
    lang = np.array([x for _, x in rows])
    families = sorted({family(x) for x in langs})
    own = {f: [x for x in langs if family(x) == f] for f in families}
    pairs = [p for f in families for p in combinations(own[f], 2)]
    columns, curves = [], []
    for part, truth in [*[(np.ones(len(rows), bool), fam == f) for f in families], *[(np.isin(lang, p), lang == p[0]) for p in pairs]]:
        at = np.flatnonzero(part)
        w = svm([features[i] for i in at], np.where(truth[at], 1, -1)) if truth[at].min() != truth[at].max() else np.zeros(0x10001)
        columns.append(w)
    weights = np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros((0x10001, 0), np.float32)
    weights[-1:] = 0
    raw = mean_scores(texts, weights)
    for i, (part, truth) in enumerate([*[(np.ones(len(rows), bool), fam == f) for f in families], *[(np.isin(lang, p), lang == p[0]) for p in pairs]]):
        curves.append(platt(raw[part, i], truth[part].astype(int)))
    return Model(families, own, pairs, weights, curves)


def sample(labelled: DataFrame, id: str, text: str, lang: str, most: int = SAMPLE, longest: int = LONGEST) -> list[tuple[str, str]]:
    """At most ``most`` (text, language) rows of each of the LANGUAGES commonest languages, by the smallest hashes of id and text."""
    scratch = Scratch(labelled.sparkSession, "language")
    good = labelled.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull() & F.col(f"`{id}`").isNotNull() & (F.char_length(F.col(f"`{text}`")) <= longest))
    # (the language is hashed too: a row that repeats with another one is another example)
    h = F.xxhash64(hashed(11, id, text), F.col(f"`{lang}`"))
    pairs = good.select(F.col(f"`{id}`").alias("id"), h.alias("h"), F.col(f"`{lang}`").alias("label"))
    rows = fetched(good, drawn(pairs, scratch, most, LANGUAGES), id, h, [F.col(f"`{text}`")])
    scratch.clear()
    return rows


def lettered(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter."""
    data, bounds = bytes_of(texts)
    ascii_letters = np.concatenate([[0], np.cumsum((data | 0x20) - np.uint8(97) < 26)])
    out = ascii_letters[bounds[1:]] > ascii_letters[bounds[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[Column] = ()) -> DataFrame:
    """The columns ``keep`` plus lang_pred and score of each whole text."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    source = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kept = source.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "__text", 1 << 20):
                texts = batch.column("__text")
                lang, score = sent.value.predict(texts)
                for i in np.flatnonzero(~lettered(texts)):
                    lang[i], score[i] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*kept, "lang_pred", "score"])

    return source.mapInArrow(run, source.drop("__text").schema.add("lang_pred", "string").add("score", "double"))


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``.

    Rows without a letter go. Where nothing could be learned all others stay.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text, 1 << 20):
                texts = batch.column(text).fill_null("")
                good = lettered(texts)
                if sent.value.families:
                    good &= np.array(sent.value.predict(texts)[1]) >= least
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    model = fit(sample(docs.where(~held_out), "doc_id", "text", "lang"))
    return predict(docs, model, keep=[F.col("doc_id"), held_out.alias("held_out")])

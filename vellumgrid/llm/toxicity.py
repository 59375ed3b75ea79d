"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: lower case, homoglyphs of Latin letters (Cyrillic, Greek, full
width) replaced, invisible characters dropped, everything but letters, digits and the
signs that can stand for letters a space. Digits and signs between letters are read as
letters; at a word's ends they may as well not belong to it ("idiot!", "$cum"), so it is
read both ways. The automaton finds all terms in one pass over the whole folded text:
words, and stems (a word's beginning). Terms inside an exception phrase don't count. The weights of what is found are summed and normalised by length; a
logistic curve of both sums gives the score.

The lexicon is learned: a term's weight is its smoothed log-odds among toxic documents;
a stem replaces its words where it is as telling and several words share it. Exception
phrases are given or learned (a term with its neighbour that only clean documents have).
The curve is fitted on scores of documents by the lexicon of the other half, so that
chance terms don't look better than they are. Near copies count once. Learning takes at most SAMPLE labelled
rows of each class, chosen by a hash of id and text, with texts up to LONGEST characters.

Edge cases: null and empty texts have no term and the lowest score; without labels of
both classes the lexicon is empty and all scores are the share of toxic rows; null labels,
and all labels of an id that has both, are ignored; equal rows are one example; repeated
documents are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_of_id, ship, table
from .fingerprints import signatures
from .ngrams import logistic
from .sampling import agreed, drawn, fetched, hashed

SAMPLE = 2000
LONGEST = 50_000
TERMS = 20_000
#: Estimated Jaccard similarity of near copies.
NEAR = 0.8
STEMS = range(4, 9)
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
        "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g",
        "ı": "i", "ⅼ": "l", "ո": "n", "օ": "o", "ս": "u",
}
_FOR_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_SIGNS = "@$!"
_READ = str.maketrans(_FOR_LETTERS)
_NO_SIGNS = str.maketrans(_SIGNS, " " * len(_SIGNS))
#: Digits and signs, by code point; other code points are looked up at 0x7F.
_SPECIAL = np.zeros(0x80, bool)
_SPECIAL[[ord(x) for x in "0123456789" + _SIGNS]] = True
_DROPPED = 0xFFFF


def _tables() -> np.ndarray:
    out = np.full(1 << 16, 0x20, np.uint32)
    for i in range(1 << 16):
        c = chr(i - 0xFEE0) if 0xFF01 <= i <= 0xFF5E else chr(i)
        low = c.lower()
        low = low if len(low) == 1 else c
        low = _LOOKALIKES.get(low, low)
        if (low.isalnum() or low in _SIGNS) and ord(low) < _DROPPED:
            out[i] = ord(low)
        elif i in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF) or 0x300 <= i < 0x370:
            out[i] = _DROPPED
    return out


_cached: list[np.ndarray] = []


def fold(text: str) -> str:
    """A text as the automaton sees it, with a space at both ends; after a line break, other readings of some of its words."""
    if not _cached:
        _cached.append(_tables())
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    out = np.where(codes < 0x10000, _cached[0][np.minimum(codes, 0xFFFE)], codes)
    out = out[out != _DROPPED]
    gap = out == 0x20
    out = out[~(gap & np.concatenate([[False], gap[:-1]]))]
    plain = out.astype("<u4").tobytes().decode("utf-32-le", "replace")
    special = np.flatnonzero(_SPECIAL[np.minimum(out, 0x7F)])
    if not len(special):
        return plain
    spaces = np.flatnonzero(out == 0x20)
    parts: list[str] = []
    others: list[str] = []
    done = 0
    for k in np.unique(np.searchsorted(spaces, special)).tolist():
        start, stop = int(spaces[k - 1]) + 1, int(spaces[k])
        word = _read(plain[start:stop], others)
        parts.append(plain[done:start] + word)
        done = stop if word else stop + 1  # without a word, without its space
    plain = "".join(parts) + plain[done:]
    return f"{plain}\n {' '.join(others)} " if others else plain


def _read(word: str, others: list[str]) -> str:
    """A word with digits or signs as it is read first; other readings go to ``others``."""
    core = word.strip("0123456789" + _SIGNS)
    if not core:  # a number
        return " ".join(word.translate(_NO_SIGNS).split())
    if core != word:  # what is at its ends may belong to it
        lead, tail = word[: word.index(core)], word[word.index(core) + len(core) :]
        others.extend({x.translate(_READ) for x in (lead + core, core + tail, word) if x != core})
    return core.translate(_READ)


def words_in(folded: str) -> list[str]:
    """The words of a folded text in order, without other readings."""
    return folded.partition("\n")[0].split()


@dataclass
class Lexicon:
    """Terms as the automaton holds them (" word " or " stem") with weights, exception phrases, and the curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0]))

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            made.add_word(term, (len(term), weight, False))
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        made.make_automaton()
        return made

    def totals(self, texts: list[str], machine=None) -> np.ndarray:
        """For each text the weights found in it, and its words."""
        machine = machine or self.automaton()
        parts = [fold(x) for x in texts]
        ends = np.cumsum([len(x) for x in parts])
        out = np.zeros((len(texts), 2))
        out[:, 1] = [max(0, x.partition("\n")[0].count(" ") - 1) for x in parts]
        if not self.weights:
            return out
        found = [(at, *what) for at, what in machine.iter("".join(parts))]
        free = sorted((at - n + 1, at) for at, n, _, is_free in found if is_free)
        begins = np.array([a for a, _ in free], np.int64)
        reach = np.maximum.accumulate(np.array([-1, *(b for _, b in free)], np.int64))  # how far those that begin so early go
        last, size = np.array([[at, n] for at, n, _, is_free in found if not is_free], np.int64).reshape(-1, 2).T
        weight = np.array([w for _, _, w, is_free in found if not is_free])
        counts = reach[np.searchsorted(begins, last - size + 1, side="right")] < last
        np.add.at(out[:, 0], np.searchsorted(ends, last[counts], side="right"), weight[counts])
        return out

    def scores(self, totals: np.ndarray) -> np.ndarray:
        return logistic(_features(totals) @ self.curve)


def _features(totals: np.ndarray) -> np.ndarray:
    found, words = np.maximum(totals[:, 0], 0), totals[:, 1]
    return np.stack([np.ones(len(totals)), np.log1p(found), np.log1p(1000 * found / (words + 20))], axis=1)


def _terms(words: list[set[str]], toxic: np.ndarray) -> dict[str, float]:
    """Telling words and stems with their log-odds."""
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
    stems: dict[bool, Counter] = {True: Counter(), False: Counter()}
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    least = max(2, round(0.01 * n1))
    for own, t in zip(words, toxic):
        if t:
            seen[True].update(own)
            stems[True].update({w[:n] for w in own for n in STEMS if len(w) >= n})
    most: dict[str, int] = {}
    for w, a in seen[True].items():
        for n in STEMS:
            if len(w) >= n:
                most[w[:n]] = max(most.get(w[:n], 0), a)
    for counter in (seen, stems):  # only what toxic documents have often enough can be telling
        counter[True] = Counter({x: n for x, n in counter[True].items() if n >= least})
    stem_of = {w: [s for s in (w[:n] for n in STEMS if len(w) >= n) if s in stems[True]] for w in set().union(*words)} if words else {}
    for own, t in zip(words, toxic):
        if not t:
            seen[False].update(own & seen[True].keys())
            stems[False].update({s for w in own for s in stem_of[w]})
    odds = lambda a, b: float(np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1)))
    telling = lambda a, b: a >= least and odds(a, b) >= 2.5 and b * n1 * 20 <= a * max(n0, 1)
    longer: dict[str, list[str]] = {}
    for s in stems[True]:
        if len(s) > STEMS[0]:
            longer.setdefault(s[:-1], []).append(s)
    out: dict[str, float] = {}
    chosen: set[str] = set()
    for s, a in sorted(stems[True].items(), key=lambda x: len(x[0])):
        if telling(a, stems[False][s]) and a >= 1.5 * most[s] and not any(s[:n] in chosen for n in STEMS if n < len(s)):
            while more := [x for x in longer.get(s, ()) if stems[True][x] >= 0.98 * a]:
                s = more[0]  # as telling, and less of a word's beginning left open
            chosen.add(s)
            out[f" {s}"] = odds(a, stems[False][s])
    for w, a in seen[True].items():
        if telling(a, seen[False][w]) and not any(w[:n] in chosen for n in STEMS):
            out[f" {w} "] = odds(a, seen[False][w])
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:TERMS])


def _exceptions(lexicon: Lexicon, folded: list[str], toxic: np.ndarray, least: int = 3) -> tuple[str, ...]:
    """A telling word with its neighbour, if ``least`` clean documents and no toxic one have it."""
    telling = {t.strip() for t in lexicon.weights if t.endswith(" ")}
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for text, t in zip(folded, toxic):
        words = words_in(text)
        seen[bool(t)].update({f"{a} {b}" for a, b in zip(words, words[1:]) if a in telling or b in telling})
    return tuple(sorted(p for p, n in seen[False].items() if n >= least and not seen[True][p]))


def _curve(totals: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on centred features, by damped Newton steps."""
    raw, y = _features(totals)[:, 1:], toxic.astype(float)
    mean, std = raw.mean(axis=0), np.maximum(raw.std(axis=0), 1e-9)
    x = np.concatenate([np.ones((len(raw), 1)), (raw - mean) / std], axis=1)
    ridge = np.diag([1e-6, 0.5, 0.5])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + w @ ridge @ w / 2)

    w = np.zeros(3)
    for _ in range(100):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    slopes = np.maximum(w[1:] / std, 0)
    return np.array([w[0] - slopes @ mean, *slopes])


def _apart(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Examples without near copies of earlier ones, whose every word would look telling."""
    seen: dict[tuple[int, bytes], list[int]] = {}
    out, own = [], []
    for start in range(0, len(rows), 500):
        part = rows[start : start + 500]
        for row, minima in zip(part, signatures(pa.array([x for x, _ in part], pa.string()))):
            bands = [(i, minima[i : i + 4].tobytes()) for i in range(0, len(minima), 4)]
            others = sorted({k for b in bands for k in seen.get(b, ())})
            # (a shared passage gives a shared band; only sets that are as like as near copies count)
            if others and (np.array([own[k] for k in others]) == minima).mean(axis=1).max() >= NEAR:
                continue
            for b in bands:
                seen.setdefault(b, []).append(len(out))
            out.append(row)
            own.append(minima)
    return out


def learn(rows: list[tuple[str, int]]) -> Lexicon:
    """A lexicon and its curve from (text, 0 or 1)."""
    rows = _apart(rows)
    toxic = np.array([t for _, t in rows], int)
    if len(rows) == 0 or toxic.min() == toxic.max():
        share = (toxic.sum() + 1) / (len(rows) + 2)
        return Lexicon({}, (), np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    texts = [x for x, _ in rows]
    folded = [fold(x) for x in texts]
    words = [set(x.split()) for x in folded]
    half, totals = np.arange(len(rows)) % 2, np.zeros((len(rows), 2))
    for side in (0, 1):
        other, own = np.flatnonzero(half != side), np.flatnonzero(half == side)
        totals[own] = Lexicon(_terms([words[i] for i in other], toxic[other])).totals([texts[i] for i in own])
    out = Lexicon(_terms(words, toxic))
    out.exceptions = _exceptions(out, folded, toxic)
    out.curve = _curve(totals, toxic)
    return out


def sample(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = SAMPLE,
    longest: int = LONGEST) -> list[tuple[str, int]]:
    """At most ``most`` (text, label) rows of each class, by the smallest hashes of id and text."""
    scratch = Scratch(docs.sparkSession, "toxic")
    short = docs.where(F.col(f"`{text}`").isNotNull() & (F.char_length(F.col(f"`{text}`")) <= longest))
    h = hashed(23, id, text)
    pairs = short.select(F.col(f"`{id}`").alias("id"), h.alias("h")).join(agreed(labels, id, label), "id")
    rows = fetched(short, drawn(pairs, scratch, most, 2), id, h, [F.col(f"`{text}`")])
    scratch.clear()
    return rows


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: list[Column] = ()) -> DataFrame:
    """The columns ``keep`` plus found (weights), words and score of each whole text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # TERMS terms at most
    source = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kept = source.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        machine = own.automaton()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                totals = own.totals(batch.column("__text").to_pylist(), machine)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(totals[:, 0]), pa.array(totals[:, 1].astype(np.int64)),
                    pa.array(own.scores(totals))], names=[*kept, "found", "words", "score"])

    return source.mapInArrow(run, source.drop("__text").schema.add("found", "double").add("words", "long").add("score", "double"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    lexicon = learn(sample(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out)))
    return score(docs, lexicon, keep=[F.col("doc_id"), held_out.alias("held_out")]).select("doc_id", "held_out", "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

"""Benchmark decontamination by the q-gram lemma over diagonal bands.

Texts and benchmark items are folded alike: lower case, every run of characters that are
neither letters nor digits one space. An item of m characters that occurs with at most
k edits shares at least m - Q + 1 - k * Q of its character q-grams with the place where
it occurs, all on diagonals (place in the text minus place in the item) within k of each
other. So shared q-grams are counted in diagonal bands that overlap by half, each at least
twice k wide: one band holds them all. Bands that meet the bound are verified by an
alignment that is confined to the band; everything else is provably no match.

k is EDITS of the item's length, less for items so short that the bound would vanish;
items of fewer than Q folded characters are no evidence and match nothing.

The index of the items is sent to all executors. Its size is checked: items beyond BLOCK
characters (some 36 MB of index) are taken in as many blocks as needed, each against all
documents. Where a q-gram that texts repeat is also common among the items, what a batch
makes of them is bounded too: beyond EXPANDED the texts, and then the items, are halved.

Edge cases: null and empty texts and items match nothing; no items or no documents give
an empty result; repeated documents and items each give their rows; other columns are
ignored. Positions are those of the original text, in code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table

Q = 8
EDITS = 0.10
BLOCK = 1_000_000
EXPANDED = 4_000_000
_BITS = 22
U = np.uint64
_MULTIPLY = U(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    fold = np.arange(1 << 16, dtype=np.uint32)
    plain = np.zeros(1 << 16, bool)
    for i in range(1 << 16):
        c = chr(i)
        plain[i] = c.isalnum()
        low = c.lower()
        if len(low) == 1:
            fold[i] = ord(low)
    return fold, plain


_cached: list[tuple[np.ndarray, np.ndarray]] = []


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The folded code points of a text, and the place of each in it."""
    if not _cached:
        _cached.append(_tables())
    fold, plain = _cached[0]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(codes, 0xFFFF)
    out = np.where(codes < 0x10000, fold[small], codes)
    gap = ~plain[small] & (codes < 0x10000)
    out[gap] = 0x20
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    at = np.flatnonzero(keep)
    return out[at], at


def grams(codes: np.ndarray) -> np.ndarray:
    """A hash of each run of Q code points."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    codes = codes.astype(np.uint64)
    out = codes[: len(codes) - Q + 1].copy()
    for j in range(1, Q):
        out *= U(0x100000001B3)
        out += codes[j : len(codes) - Q + 1 + j]
    return (out ^ (out >> U(29))) * _MULTIPLY


@dataclass
class Index:
    """The q-grams of a block of items."""

    ids: np.ndarray
    codes: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    width: np.ndarray
    keys: np.ndarray
    start: np.ndarray
    item: np.ndarray
    place: np.ndarray
    parts: list["Index"] = field(default_factory=list)

    def halves(self) -> list["Index"]:
        """Indexes of the first and the second half of the items."""
        if not self.parts:
            half = len(self.ids) // 2
            self.parts = [_index(self.ids[a:b], self.codes[a:b], self.edits[a:b]) for a, b in ((0, half), (half, len(self.ids)))]
        return self.parts

    def filter(self) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[self.keys >> U(64 - _BITS)] = True
        return out


def build(items: list[tuple[int, str]], edits: float = EDITS) -> Index:
    ids, codes = [], []
    for i, text in items:
        c = folded(text or "")[0]
        c = c[1:] if len(c) and c[0] == 0x20 else c
        c = c[:-1] if len(c) and c[-1] == 0x20 else c
        if i is not None and len(c) >= Q:
            ids.append(i)
            codes.append(c)
    size = np.array([len(c) for c in codes], np.int64)
    return _index(np.array(ids, np.int64), codes, np.minimum((size * edits).astype(np.int64), (size - Q) // Q))


def _index(ids: np.ndarray, codes: list[np.ndarray], k: np.ndarray) -> Index:
    size = np.array([len(c) for c in codes], np.int64)
    hashes = [grams(c) for c in codes]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    keys, start = np.unique(flat[order], return_index=True)
    return Index(ids, codes, k, size - Q + 1 - k * Q, 2 * (k + 1), keys, np.concatenate([start, [len(flat)]]), item[order], place[order])


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of ``item`` in ``text`` on the diagonals low..high, if it has at most k edits."""
    lo, width = low - k, high - low + 2 * k + 1
    pad = np.full(max(0, -lo), 0xFFFFFFFF, np.uint32)
    body = np.concatenate([pad, text[max(0, lo) : max(0, lo + width + len(item))]])
    body = np.concatenate([body, np.full(max(0, width + len(item) - len(body)), 0xFFFFFFFF, np.uint32)])
    row, step = np.zeros(width, np.int64), np.arange(width)
    for i, c in enumerate(item):
        new = row + (body[i : i + width] != c)
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        row = np.minimum.accumulate(new - step) + step
        if row.min() > k:
            return None
    best = int(row.argmin())
    return int(row[best]), lo + best + len(item)


def first_of(item: np.ndarray, text: np.ndarray, end: int, edits: int) -> int:
    """Where the occurrence of ``item`` begins that ends before ``end`` with ``edits`` edits; of several places the one that makes it longest."""
    back, body = item[::-1], text[max(0, end - len(item) - edits) : end][::-1]
    row, step = np.arange(len(body) + 1), np.arange(len(body) + 1)
    for c in back:
        new = np.append(row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (body != c)))
        row = np.minimum.accumulate(new - step) + step
    return end - int(np.flatnonzero(row == row.min())[-1])


def matches(index: Index, texts: list[str], seen: np.ndarray | None = None, expanded: int = EXPANDED) -> list[tuple[int, int, int, int, int]]:
    """(number of the text, item id, start, end, edits) of every item that occurs in a text; the best place of each."""
    if len(index.ids) == 0:
        return []
    seen = index.filter() if seen is None else seen
    parts = [folded(x) for x in texts]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    _found(index, seen, [x for x, _ in parts], list(range(len(parts))), 0, expanded, best)
    rows = []
    for (d, i), (edits, end, first) in sorted(best.items()):
        origin = parts[d][1]
        first, last = max(0, min(first, len(origin) - 1)), min(end, len(origin))
        rows.append((d, int(index.ids[i]), int(origin[first]), int(origin[last - 1]) + 1, edits))
    return rows


def _found(index: Index, seen: np.ndarray, parts: list[np.ndarray], numbers: list[int], before: int, expanded: int,
    best: dict[tuple[int, int], tuple[int, int, int]]) -> None:
    """Put (edits, end, start) in folded text of the best place of every item into ``best``, by number of text and item (``before`` are in other halves)."""
    gap = np.zeros(1, np.uint32)
    flat = np.concatenate([y for x in parts for y in (x, gap)] or [gap])
    bounds = np.concatenate([[0], np.cumsum([len(x) + 1 for x in parts])])
    h = grams(flat)
    at = np.flatnonzero(seen[h >> U(64 - _BITS)])
    if len(at) == 0 or len(index.keys) == 0:
        return
    j = np.searchsorted(index.keys, h[at])
    j[j == len(index.keys)] = 0
    good = index.keys[j] == h[at]
    at, j = at[good], j[good]
    n = index.start[j + 1] - index.start[j]
    to = np.cumsum(n)
    if len(to) == 0:
        return
    if to[-1] > expanded and len(parts) > 1:
        half = len(parts) // 2
        for own in (slice(None, half), slice(half, None)):
            _found(index, seen, parts[own], numbers[own], before, expanded, best)
        return
    if to[-1] > expanded and len(index.ids) > 1:
        for k, half in enumerate(index.halves()):
            _found(half, half.filter(), parts, numbers, before + k * len(index.halves()[0].ids), expanded, best)
        return
    which = np.arange(to[-1]) + np.repeat(index.start[j] - (to - n), n)
    item, place, where = index.item[which], index.place[which], np.repeat(at, n)
    doc = np.searchsorted(bounds, where, side="right") - 1
    diagonal = where - place - bounds[doc] + len(flat)  # positive
    width = index.width[item]
    pair, span = doc * len(index.ids) + item, 3 * len(flat)
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for shift in (0, 1):
        band = (diagonal + shift * (width // 2)) // width
        key = pair * span + band
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        count = np.diff(np.concatenate([edge, [len(key)]]))
        p, b = pair[order], band[order]
        edge, count = edge[full := count >= index.need[p[edge] % len(index.ids)]], count[full]
        for e, n in zip(edge, count):
            # the bound is on q-grams of the item, so one that the text repeats counts once
            if len(np.unique(place[order[e : e + n]])) < index.need[p[e] % len(index.ids)]:
                continue
            d, i = divmod(int(p[e]), len(index.ids))
            if out.get((d, i), (1, 0))[0] == 0:
                continue
            w = int(index.width[i])
            low = int(b[e]) * w - shift * (w // 2) - len(flat)
            found = align(index.codes[i], parts[d], low, low + w - 1, int(index.edits[i]))
            if found and found[0] <= index.edits[i] and found < out.get((d, i), (1 << 30, 0)):
                out[d, i] = found
    for (d, i), (edits, end) in out.items():
        best[numbers[d], before + i] = (edits, end, first_of(index.codes[i], parts[d], min(end, len(parts[d])), edits))


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, start, end, edits): a row for each document and item that occurs in it, with the place of the best occurrence."""
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    out = None
    for index in _indexes(docs, benchmark, item_id, item_text, edits, block):
        found = source.mapInArrow(_scan(index), "doc_id long, item_id long, start long, end long, edits long")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", edits: float = EDITS,
    block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` in which no item occurs; each is judged by its own text, whatever its id."""
    for index in _indexes(docs, benchmark, item_id, item_text, edits, block):
        docs = docs.mapInArrow(_clean(index, text), docs.schema)
    return docs


def _indexes(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, edits: float, block: int) -> Iterator:
    """The items' indexes, each of about ``block`` characters, sent to the executors."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{item_text}`").alias("t"))
    size = items.agg(F.sum(F.char_length("t")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        yield spark.sparkContext.broadcast(build([(r["i"], r["t"]) for r in rows], edits))


def _parts(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` characters at most, one text at least."""
    start, n = 0, 0
    for i, x in enumerate(texts):
        if i > start and n + len(x) > most:
            yield start, i
            start, n = i, 0
        n += len(x)
    if start < len(texts):
        yield start, len(texts)


def _scan(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        seen = index.filter()
        for whole in batches:
            ids, texts = whole.column("id").to_pylist(), whole.column("text").to_pylist()
            for start, stop in _parts(texts):
                rows = matches(index, texts[start:stop], seen)
                columns = list(zip(*[(ids[start + d], i, a, b, e) for d, i, a, b, e in rows])) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "start", "end", "edits"])

    return run


def _clean(sent, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        seen = index.filter()
        for whole in batches:
            texts = [x or "" for x in whole.column(text).to_pylist()]
            for start, stop in _parts(texts):
                good = np.ones(stop - start, bool)
                good[[row[0] for row in matches(index, texts[start:stop], seen)]] = False
                yield whole.slice(start, stop - start).filter(pa.array(good))

    return run


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))

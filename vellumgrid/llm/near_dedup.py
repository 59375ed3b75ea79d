"""Near-duplicate groups by HyperMinHash registers, confirmed on whole shingle sets.

1. One pass over the texts takes each document's set of distinct shingles. Every one of
   BUCKETS seeded hashes keeps, of its minimum over the set, the count of leading zeros
   and the MANTISSA bits after the first one: a 16-bit register. Rows of equal sets
   (a 128-bit digest) become one class with a number of its own, so copies cost nothing
   further, and an id that has several texts has a class for each.
2. BANDS bands of ROWS registers are grouped. Each class of a group is linked to the
   smallest one: stars, not pairs. Their connected components are the clusters; every
   pair that shares a band lies in one cluster.
3. The sets of clustered classes meet by cluster. In a task, registers are compared first,
   by the Jaccard estimate corrected for the chance that registers of different minima
   collide; what stays above a margin below the threshold (DEVIATIONS standard deviations)
   is confirmed on the whole sets by an inverted index. The task reports a spanning forest
   of the confirmed links: as many rows as documents at most.
   A cluster above CLUSTER shingles or MEMBERS classes is divided by set size (a link needs sizes within the
   threshold's ratio, so only neighbouring levels meet) and then by hash into blocks, and
   every pair of blocks that could hold a link meets in a task of its own. That is the
   exact way for what is too large; nothing is capped.
   Only rows whose id stands for a clustered class are read again for this.
4. Components of the confirmed links and of the classes that share an id; the smallest id
   of a component names it.

What can be lost: a link whose two sets share no band. At the threshold of 0.85 that has
a probability of (1 - 0.85**5)**32 < 1e-8; above it, less.

Edge cases: null or empty texts and texts without a word have the empty set and no link;
an empty table gives an empty result; every row is returned. Rows that repeat an id are
judged by their own texts, each with its own set, and those with a set are linked with
each other, so they share a component (a row of the empty set is linked with nothing, not
even with other rows of its id). Rows with a null id are linked with nothing and kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ship, table
from .components import components
from .shingles import Permutations, bytes_of, pieces, shingles_of, words_of

WIDTH = 5
BANDS = 32
ROWS = 5
BUCKETS = BANDS * ROWS
MANTISSA = 10
SEED = 77
PERCENT = 85
DEVIATIONS = 7.0
CLUSTER = 1_000_000
MEMBERS = 1024
#: Ids, counted, that may go to all executors: some 64 MB there.
SENT = 2_000_000
_hashes: list[Permutations] = []


def _permutations() -> Permutations:
    if not _hashes:
        _hashes.append(Permutations(BUCKETS, SEED))
    return _hashes[0]


def registers(minima: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 64-bit minima, packed in 16 bits."""
    left = minima.copy()
    zeros = np.zeros(minima.shape, np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        none = left < (np.uint64(1) << np.uint64(64 - step))
        zeros[none] += np.uint64(step)
        left[none] <<= np.uint64(step)
    mantissa = (left << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((np.minimum(zeros, 63) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def collision(n: float, m: float) -> float:
    """Chance that the registers of two disjoint sets of n and m values are equal."""
    i = np.arange(1, 64, dtype=float)[:, None]
    j = np.arange(2**MANTISSA, dtype=float)[None, :]
    low, step = 2.0**-i, 2.0 ** -(i + MANTISSA)
    a, b = low + j * step, low + (j + 1) * step
    share = lambda k: np.exp(k * np.log1p(-np.minimum(a, 1 - 1e-15))) - np.exp(k * np.log1p(-np.minimum(b, 1 - 1e-15)))
    return float((share(n) * share(m)).sum())


_chance: dict[tuple[int, int], float] = {}


def corrected(equal: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates from the number of equal registers; set sizes are taken to the power of two above."""
    up = lambda x: int(max(0, int(x) - 1)).bit_length()
    levels, at = np.unique(np.ceil(np.log2(np.maximum(m, 1))).astype(int), return_inverse=True)
    for k in levels:
        if (up(n), int(k)) not in _chance:
            _chance[up(n), int(k)] = collision(2.0 ** up(n), 2.0 ** int(k))
    c = np.array([_chance[up(n), int(k)] for k in levels])[at]
    return np.clip((equal / BUCKETS - c) / (1 - c), 0, 1)


def sketches(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, set: digest, sketch: registers) of whole texts; digest and sketch are null for the empty set."""
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _permutations()
        for whole in batches:
            for batch in pieces(whole, "text"):
                data, at = bytes_of(batch.column("text"))
                hashes, to = shingles_of(*words_of(data, at), WIDTH)
                size, digests, least, has = [], [], [], []
                for a, b in zip(to, to[1:]):
                    own = np.unique(hashes[a:b])
                    size.append(len(own))
                    has.append(len(own) > 0)
                    digests.append(digest(own))
                    least.append(p.minima(own) if len(own) else np.zeros(BUCKETS, np.uint64))
                packed = registers(np.array(least)).tobytes()
                step = 2 * BUCKETS
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(size, pa.int64()), pa.array(digests, pa.binary()),
                        pa.array([packed[i * step : (i + 1) * step] if h else None for i, h in enumerate(has)], pa.binary())],
                        names=["id", "n_shingles", "set", "sketch"]
                )

    return source.mapInArrow(run, "id long, n_shingles long, set binary, sketch binary")


def digest(shingles: np.ndarray) -> bytes | None:
    """The address of a set of sorted distinct shingles; None for the empty set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sets_of(docs: DataFrame, text: str) -> DataFrame:
    """(set: digest, shingles: packed sorted distinct hashes) of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                data, at = bytes_of(batch.column("text"))
                hashes, to = shingles_of(*words_of(data, at), WIDTH)
                sets = [np.unique(hashes[a:b]) for a, b in zip(to, to[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([digest(x) for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary())], names=["set", "shingles"])

    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return source.mapInArrow(run, "set binary, shingles binary")


class Postings:
    """For sets in order: which sets hold each value of the k-th one."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        self.at = np.concatenate([[0], np.cumsum(size)])
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        self.code = code.astype(np.int32)
        order = np.argsort(self.code, kind="stable")
        self.holder = np.repeat(np.arange(len(sets), dtype=np.int32), size)[order]
        self.start = np.searchsorted(self.code[order], np.arange(self.code.max(initial=-1) + 2))

    def shared(self, k: int) -> np.ndarray:
        """How many values set k shares with each set."""
        codes = self.code[self.at[k] : self.at[k + 1]]
        a, n = self.start[codes], self.start[codes + 1] - self.start[codes]
        to = np.cumsum(n)
        return np.bincount(self.holder[np.arange(to[-1]) + np.repeat(a - (to - n), n)], minlength=len(self.at) - 1)


def forest(ids: np.ndarray, sets: list[np.ndarray], sketch: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets: 100 * shared >= percent * union.

    Sets go in order of size. Each is held against the earlier ones that are large enough,
    by registers and then by whole sets, and linked to one of each component it meets.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets = [sets[i] for i in order]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    sketch = sketch[order]
    root = np.arange(len(order))
    t = percent / 100
    margin = t - DEVIATIONS * np.sqrt(t * (1 - t) / BUCKETS)
    postings, out = None, []
    for k in range(1, len(order)):
        rest = np.arange(np.searchsorted(size[:k], -(-size[k] * percent // 100)), k)
        if len(rest) == 0:
            continue
        rest = rest[corrected((sketch[rest] == sketch[k]).sum(axis=1), int(size[k]), size[rest]) >= margin]
        if len(rest) > 8:
            postings = postings or Postings(sets)
            shared = postings.shared(k)[rest]
        else:
            shared = np.array([len(np.intersect1d(sets[k], sets[j], assume_unique=True)) for j in rest], np.int64)
        rest = rest[100 * shared >= percent * (size[k] + size[rest] - shared)]
        met, first = np.unique(root[rest], return_index=True)
        out += [(int(ids[order[k]]), int(ids[order[j]])) for j in rest[first]]
        if len(met):
            root[np.isin(root, met)] = met[0]
            root[k] = met[0]
    return out


def deal(members: DataFrame, scratch: Scratch, percent: int, limit: int, most: int, by: str = "no") -> DataFrame:
    """``members`` (cluster, n_shingles and more) plus tasks: the names of those in which a member is compared.

    Clusters up to ``limit`` shingles and ``most`` members are one task. Larger ones, of
    which there are at most the input's size divided by the limits, are divided by level
    of size and hash of ``by`` into blocks; a task is a pair of blocks.
    """
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / -np.log(percent / 100)).cast("int")
    per = members.groupBy("cluster", level.alias("level")).agg(F.sum("n_shingles").alias("n"), F.count("*").alias("rows"))
    load = F.greatest(F.col("n") / limit, F.col("rows") / most)
    whole = per.groupBy("cluster").agg(F.greatest(F.sum("n") / limit, F.sum("rows") / most).alias("load"),
        F.collect_list(F.struct("level", F.ceil(2 * load).cast("int").alias("blocks"))).alias("levels"))
    large = scratch.keep(whole.where("load > 1").select("cluster", F.map_from_entries("levels").alias("blocks")), "large")
    blocks = lambda step: F.element_at("blocks", F.col("level") + step)
    b = F.pmod(F.xxhash64(by), blocks(0)).cast("int")
    name = lambda lo, i, j, kind: F.concat_ws("/", F.lit(kind), lo.cast("string"), i.cast("string"), j.cast("string"))
    count = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(count(blocks(0)), lambda k: name(F.col("level"), F.least(b, k), F.greatest(b, k), "s"))
    up = F.transform(count(blocks(1)), lambda k: name(F.col("level"), b, k, "u"))
    down = F.transform(count(blocks(-1)), lambda k: name(F.col("level") - 1, k, b, "u"))
    dealt = members.withColumn("level", level).join(large, "cluster", "left")
    return dealt.withColumn("tasks", F.when(F.col("blocks").isNull(), F.array(F.lit("whole"))).otherwise(F.concat(same, up, down))).drop("level", "blocks")


def only(docs: DataFrame, ids: DataFrame, id: str, how: str = "left_semi", most: int = SENT) -> DataFrame:
    """The rows of ``docs`` whose id is in (or, ``left_anti``, isn't in) the kept table ``ids`` (__id).

    Up to ``most`` ids, as counted, go to all executors, so that no text is shuffled.
    """
    few = ids.count() <= most
    return docs.join(F.broadcast(ids) if few else ids, F.col(f"`{id}`").cast("long") == F.col("__id"), how)


def clustered(bands: DataFrame, scratch: Scratch) -> DataFrame:
    """(no, cluster) of the classes that share a ``key`` with others, from (no, key): stars around each key's smallest, never pairs."""
    least = bands.groupBy("key").agg(F.min("no").alias("first"), F.max("no").alias("last")).where("first < last").select("key", "first")
    stars = bands.join(least, "key").where("no <> first").select(F.col("no").alias("a"), F.col("first").alias("b"))
    return components(stars, scratch).select(F.col("id").alias("no"), F.col("component").alias("cluster"))


def compared(docs: DataFrame, members: DataFrame, scratch: Scratch, run: Callable[[pa.Table], pa.Table], schema: str, columns: tuple[str, ...],
    id: str, text: str, percent: int, limit: int, most: int) -> DataFrame:
    """``run`` on the ``columns`` and shingles of each task of the clusters ``members`` (cluster, no, head, n_shingles, set and more)."""
    heads = scratch.keep(members.select(F.col("head").alias("__id")).distinct(), "heads")
    # (an id may repeat, with one text or several: a set is wanted once, and only if it is a member's)
    sets = sets_of(only(docs.select(F.col(f"`{id}`"), F.col(f"`{text}`")), heads, id), text).dropDuplicates(["set"])
    tasks = deal(members, scratch, percent, limit, most).select("set", "cluster", "tasks", *columns)
    dealt = sets.join(tasks, "set").select("cluster", F.explode("tasks").alias("task"), *columns, "shingles")
    return dealt.select(F.xxhash64("cluster", "task").alias("deal"), *columns, "shingles").groupBy("deal").applyInArrow(run, schema)


def confirmed(docs: DataFrame, members: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", percent: int = PERCENT,
    limit: int = CLUSTER, most: int = MEMBERS) -> DataFrame:
    """A spanning forest (a, b) of the links within the clusters ``members`` (cluster, no, head, n_shingles, set, sketch)."""

    def run(t: pa.Table) -> pa.Table:
        numbers = t.column("no").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
        sketch = np.array([np.frombuffer(x.as_buffer(), np.uint16) for x in t.column("sketch")])
        found = forest(numbers, sets, sketch, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return compared(docs, members, scratch, run, "a long, b long", ("no", "sketch"), id, text, percent, limit, most)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT, limit: int = CLUSTER, most: int = MEMBERS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "near")
    all_docs = scratch.keep(sketches(docs, id, text), "sketches")
    sets = all_docs.where("set is not null and id is not null")
    classes = sets.groupBy("set").agg(F.min("id").alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    classes = scratch.keep(classes.withColumn("no", F.monotonically_increasing_id()), "classes")
    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width)) for i in range(BANDS)])
    clusters = clustered(classes.where("n_shingles > 1").select("no", F.explode(keys).alias("key")), scratch)
    members = scratch.keep(classes.join(clusters, "no"), "members")
    links = scratch.keep(confirmed(docs, members, scratch, id, text, percent, limit, most), "confirmed")
    # classes that an id has beside its first one are linked with that
    often = sets.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    several = sets.join(often, "id", "left_semi").select("id", "set").distinct().join(classes.select("set", "no"), "set")
    own = several.join(several.groupBy("id").agg(F.min("no").alias("a")), "id").where("no <> a").select("a", F.col("no").alias("b"))
    joined = components(links.unionByName(own), scratch).select(F.col("id").alias("no"), "component")
    linked = scratch.keep(classes.select("no", "head").join(joined, "no"), "linked")
    named = linked.join(linked.groupBy("component").agg(F.min("head").alias("least")), "component").select("no", "least")
    heads_of = classes.select("no", "set", "head").join(named, "no", "left").select("set", F.coalesce("least", "head").alias("component"))
    out = all_docs.select("id", "n_shingles", "set").join(heads_of, "set", "left").select("id", "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
    done = scratch.keep(out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))), "near")
    scratch.clear(done)
    return done


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near duplicates.

    An id goes, with all its rows, if a row of it has a smaller id in its group. Of rows
    that repeat an id that stays, the one with the smallest text stays, an empty one only
    if there is no other; rows with a null id all stay.
    """
    scratch = Scratch(docs.sparkSession, "near")
    near = near_duplicates(docs, id, text, percent).where("id is not null")
    per = scratch.keep(near.groupBy("id").agg(F.min("component_id").alias("least"),
        F.count("*").alias("rows")).where("least < id or rows > 1").select(F.col("id").alias("__id"),
        (F.col("least") < F.col("id")).alias("gone")), "gone")
    own = only(docs, per.where("gone").select("__id"), id, "left_anti")
    again = per.where("not gone").select("__id")
    if not again.isEmpty():
        columns = [F.col(f"`{c}`") for c in docs.columns]
        words = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        order = F.struct(words == "", words, F.xxhash64(F.to_json(F.struct(*columns))))
        firsts = only(own, again, id).groupBy(F.col(f"`{id}`").alias("__id")).agg(F.min_by(F.struct(*columns), order).alias("__row")).select("__row.*")
        own = only(own, again, id, "left_anti").unionByName(firsts)
    return own


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT r, doc_id, array_to_string(l[i : i + {WIDTH - 1}], ' ') AS g FROM (SELECT r, doc_id, l, unnest(range(1, greatest(len(l) - {WIDTH - 2}, 2))) AS i FROM w WHERE len(l) > 0)),
n AS (SELECT r, doc_id, count(*) AS k FROM s GROUP BY r, doc_id),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= {PERCENT} * (a.k + b.k - c) UNION SELECT a.r, b.r FROM n a JOIN n b ON a.doc_id = b.doc_id AND a.r < b.r),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
t AS (SELECT r AS x, r AS y FROM w UNION SELECT t.x, u.y FROM t JOIN u ON t.y = u.x),
m AS (SELECT x AS r, min(doc_id) AS component_id FROM t JOIN w ON w.r = t.y GROUP BY x)
SELECT w.doc_id, coalesce(k, 0) AS n_shingles, component_id, w.doc_id IS NOT DISTINCT FROM component_id AS kept FROM w JOIN m ON m.r = w.r LEFT JOIN n ON n.r = w.r
"""

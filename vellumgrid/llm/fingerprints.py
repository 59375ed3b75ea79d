"""Document fingerprints: MinHash over word shingles, banded and joined in Spark.

A document's set is its distinct shingles of five words (lower-cased A-Z; fewer words
make one shingle). PERMUTATIONS universal hashes a*x+b mod 2**64 run over all shingles
in numpy; the minimum of each is the signature. The printed fingerprint keeps BITS bits
of each minimum in hexadecimal, and likeness() corrects the agreement by the chance that
unequal minima agree in those bits, so it estimates the sets' Jaccard similarity.

near_pairs() joins signatures by bands in Spark. Stars around a band's smallest member
only form clusters; in each cluster all sets are compared, and a spanning forest of the
links whose whole sets are similar enough comes back, so a whole cluster of n makes n-1
rows, not n squared. A large cluster is divided into blocks; every two that could hold a
link meet, with a forest of their own. A link of similarity s shares a band with a chance
of 1 - (1 - s**4)**32: over 0.9999999 at 0.8.

Edge cases: null and empty texts, and texts without a word, have the empty set, whose
fingerprint is EMPTY; it is like itself (1) and like nothing else (0). Equal texts have
equal fingerprints. Repeated rows each give a row; null ids come first in the order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, ship, table
from .components import components
from .near_dedup import CLUSTER, MEMBERS, SENT, Postings, clustered, compared, digest
from .shingles import Permutations, bytes_of, mix, pieces, shingles_of, words_of

PERMUTATIONS = 128
BITS = 8
WIDTH = 5
SEED = 2024
BANDS = 32
SIMILARITY = 0.8
EMPTY = "-"
_CHANCE = 2.0**-BITS
_hashes: dict[tuple[int, int], Permutations] = {}


def _permutations(count: int = PERMUTATIONS, seed: int = SEED) -> Permutations:
    if (count, seed) not in _hashes:
        _hashes[count, seed] = Permutations(count, seed)
    return _hashes[count, seed]


def _minima(hashes: np.ndarray, to: np.ndarray) -> np.ndarray:
    p = _permutations()
    out = np.full((len(to) - 1, PERMUTATIONS), np.iinfo(np.uint64).max, np.uint64)
    for i, (a, b) in enumerate(zip(to, to[1:])):
        if b > a:
            out[i] = p.minima(hashes[a:b])
    return out


def signatures(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    """A row of minima for each text; all ones for an empty set."""
    data, at = bytes_of(texts)
    return _minima(*shingles_of(*words_of(data, at), width))


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each band of rows of minima; the band is part of it."""
    rows = PERMUTATIONS // bands
    key = np.zeros((len(signature), bands), np.uint64)
    for k in range(rows):
        key = mix(key + signature[:, k : rows * bands : rows])
    return mix(key + np.arange(1, bands + 1, dtype=np.uint64)[None, :])


def printed(signature: np.ndarray) -> list[str]:
    """The fingerprints of rows of minima."""
    empty = (signature == np.iinfo(np.uint64).max).all(axis=1)
    # the low bits of a minimum are as good as random; mixing the high ones in costs nothing
    small = ((signature >> np.uint64(17)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return [EMPTY if e else row.tobytes().hex() for e, row in zip(empty, small)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of minima, from what the fingerprints keep."""
    shift, mask = np.uint64(17), np.uint64((1 << BITS) - 1)
    same = (((a >> shift) & mask) == ((b >> shift) & mask)).mean(axis=1)
    full = np.iinfo(np.uint64).max
    empty = (a == full).all(axis=1).astype(int) + (b == full).all(axis=1)
    out = np.clip((same - _CHANCE) / (1 - _CHANCE), 0.0, 1.0)
    return np.where(empty == 2, 1.0, np.where(empty == 1, 0.0, out))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", bands: int = BANDS) -> DataFrame:
    """(id, fingerprint, n_shingles, set: digest, bands: keys) of whole texts; set is null for the empty set."""
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                data, at = bytes_of(batch.column("text"))
                hashes, to = shingles_of(*words_of(data, at), WIDTH)
                sets = [np.unique(hashes[a:b]) for a, b in zip(to, to[1:])]
                size = np.array([len(x) for x in sets], np.int64)
                found = _minima(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)]))
                keys = band_keys(found, bands).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(printed(found)), pa.array(size), pa.array([digest(x) for x in sets], pa.binary()),
                        pa.array(list(keys), pa.list_(pa.int64()))], names=["id", "fingerprint", "n_shingles", "set", "bands"]
                )

    return source.mapInArrow(run, "id long, fingerprint string, n_shingles long, set binary, bands array<long>")


def _forest(ids: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int, float]]:
    """A spanning forest (larger id, smaller id, jaccard) of the links of at least ``similarity`` between sets."""
    postings, root, out = Postings(sets), np.arange(len(sets)), []
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    for k in range(1, len(sets)):
        shared = postings.shared(k)[:k]
        jaccard = shared / (size[k] + size[:k] - shared)
        near = np.flatnonzero(jaccard >= similarity)
        met, first = np.unique(root[near], return_index=True)
        out += [(max(int(ids[k]), int(ids[j])), min(int(ids[k]), int(ids[j])), float(jaccard[j])) for j in near[first]]
        if len(met):
            root[np.isin(root, met)] = met[0]
            root[k] = met[0]
    return out


def near_pairs(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, id: str = "doc_id", text: str = "text",
    scratch: Scratch | None = None, limit: int = CLUSTER, most: int = MEMBERS) -> DataFrame:
    """(id, like, jaccard): links of ids to smaller ones whose whole sets are as similar as asked.

    Every two sets that share a band are compared, and those of a cluster that are linked
    by any chain of similar pairs are linked by the rows returned. Rows of equal sets are
    first reduced to their smallest id, which they are linked to with jaccard 1. An id
    with several texts stands for each of its sets; rows with a null id have no link.
    """
    scratch = scratch or Scratch(docs.sparkSession, "prints")
    prints = scratch.keep(fingerprints(docs, id, text, bands).drop("fingerprint"), "prints")
    sets = prints.where("set is not null and id is not null")
    classes = sets.groupBy("set").agg(F.min("id").alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = scratch.keep(classes.withColumn("no", F.monotonically_increasing_id()), "classes")
    copies = sets.select("id", "set").join(classes.select("set", F.col("head").alias("like")), "set").where("id <> like").select("id", "like",
        F.lit(1.0).alias("jaccard")).distinct()
    clusters = clustered(classes.select("no", F.explode("bands").alias("key")), scratch)
    members = scratch.keep(classes.drop("bands").join(clusters, "no"), "members")

    def run(t: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
        found = _forest(t.column("head").to_numpy(), sets, similarity)
        return pa.table({"id": pa.array([x[0] for x in found], pa.int64()), "like": pa.array([x[1] for x in found], pa.int64()),
            "jaccard": pa.array([x[2] for x in found], pa.float64())})

    # (blocks by size: a link needs sizes within the ratio of the threshold)
    percent = max(1, min(99, int(100 * similarity)))
    links = compared(docs, members, scratch, run, "id long, like long, jaccard double", ("head",), id, text, percent, limit, most)
    return links.where("id <> like").distinct().unionByName(copies)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(ids: list, texts: list[str], before: list[str], own: np.ndarray, nexts: np.ndarray) -> list[pa.Array]:
    """Columns of _RESULT for texts, those that stand before them, and the signatures of both."""
    cuts = [len(x) // 3 for x in texts]
    edited = [x[: len(x) - n] + y[:n] for x, y, n in zip(texts, before, cuts)]
    changed = signatures(pa.array(edited, pa.string()))
    return [
        pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()), pa.array(printed(own), pa.string()),
            pa.array(printed(changed), pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, nexts)),
    ]


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Fingerprints of each text, and of it with its last third replaced by the start of the text before it in order of id (the next in descending order).

    Rows are range-partitioned and sorted by id and text once; null ids come first and
    the row before the first one is the last. A partition gives the results of all its
    rows but its first, and the texts of its first and last; those few, two for each
    partition that has rows, are joined by the partitions' order for the rest.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = scratch or Scratch(spark, "edited")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = plain.repartitionByRange(n, F.asc_nulls_first("id"), "h").sortWithinPartitions(F.asc_nulls_first("id"), "h",
        "text").select(F.spark_partition_id().alias("part"), "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, sig, part = None, None, None, None
        for whole in batches:
            for batch in pieces(whole, "text"):
                ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
                own = signatures(batch.column("text"))
                before, nexts = [last[1] if last else "", *texts[:-1]], np.concatenate([own[:1] if sig is None else sig[None], own[:-1]])
                skip = first is None
                if skip:
                    first, part = (ids[0], texts[0]), batch.column("part")[0].as_py()
                last, sig = (ids[-1], texts[-1]), own[-1]
                rows = _edited(ids[skip:], texts[skip:], before[skip:], own[skip:], nexts[skip:])
                none = len(ids) - skip
                yield pa.RecordBatch.from_arrays([*rows, *[pa.nulls(none, t) for t in edge]], names=names)
        if first is not None:
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, t) for t in kinds], pa.array([part], pa.int32()), pa.array([first[0]], pa.int64()),
                pa.array([first[1]], pa.string()), pa.array([last[1]], pa.string())], names=names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    edge = [pa.int32(), pa.int64(), pa.string(), pa.string()]
    names = [*(x.split()[0] for x in _RESULT.split(", ")), "part", "first_id", "first_text", "last_text"]
    done = scratch.keep(ordered.mapInArrow(run, f"{_RESULT}, part int, first_id long, first_text string, last_text string"), "edited")
    edges = done.where("part is not null")
    # (numbers alone are put in order in one task, a row for each partition)
    own = W.orderBy("part")
    order = edges.select("part", F.coalesce(F.lag("part").over(own), F.max("part").over(own.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("previous"))
    firsts = edges.select("part", "first_id", "first_text").join(order, "part").join(edges.select(F.col("part").alias("previous"), "last_text"), "previous")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before = batch.column("first_text"), batch.column("last_text")
            yield pa.RecordBatch.from_arrays(_edited(batch.column("first_id").to_pylist(), texts.to_pylist(), before.to_pylist(), signatures(texts),
                signatures(before)), names=names[:7])

    return done.where("part is null").select(*names[:7]).unionByName(firsts.select("first_id", "first_text", "last_text").mapInArrow(rest, _RESULT))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and near_group: the smallest id that verified links of 0.8 or more lead to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = edited_fingerprints(docs)
    scratch = Scratch(spark, "groups")
    groups = scratch.keep(components(near_pairs(docs, scratch=scratch), scratch, "id", "like").select(F.col("id").alias("__id"), "component"), "groups")
    scratch.clear(groups)
    few = groups.count() <= SENT
    joined = prints.join(F.broadcast(groups) if few else groups, F.col("doc_id") == F.col("__id"), "left")
    return joined.select(*prints.columns, F.coalesce("component", "doc_id").alias("near_group"))

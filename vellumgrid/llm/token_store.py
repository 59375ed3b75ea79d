"""Token ids in a compact binary table: canonical length-limited Huffman blocks.

Layout of a store, a folder of two Parquet tables that Spark's committer writes, so a
lost executor costs a task and never leaves half a file:

``code``    one row for each id that occurs: id, count, bits. The canonical code follows
            from the lengths alone.
``blocks``  one row for each block of about BLOCK ids, in ascending doc_id order:
            shard, seq (number of its first document in the shard), n_ids, doc_ids and sizes
            (its documents, whole), checkpoints (the bit offset of every EVERY-th id),
            crc (of the packed bits), payload (the bits).

Blocks decode on their own, and so does every stretch between two checkpoints: the
decoder looks codes up in one table for all stretches at once. A document is never
divided, so a reader needs one block to have it.

Edge cases: null and empty texts hold only the end id; an empty corpus is an empty
store; documents with one doc_id are kept each, in the order of their text, null ids
first. Other columns of the input are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, ship, table
from .huffman import Code, code_lengths
from .word_ids import ids_at

MODEL = "word_bpe_49k.json"
END = 2
BLOCK = 65_536
EVERY = 512
MOST_BITS = 18
#: Blocks that a reader decodes at once.
TOGETHER = 16


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _ordered(docs: DataFrame, id: str, text: str) -> DataFrame:
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return plain.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")


def width_of(model: str) -> str:
    """The numpy type that holds every id of a tokenizers file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(model).get_vocab_size() <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", model: str | None = None, end: int | None = END) -> DataFrame:
    """A kept table (shard, seq, doc_id, ids packed as ``width_of`` the model says), ordered by doc_id over the shards."""
    path = model or _public(MODEL)
    ship(docs.sparkSession)
    width = width_of(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seq = ids_at(path), 0
        for batch in batches:
            ids, to = words.encode(batch.column("text"))
            if end is not None:
                ids, to = _ended(ids, to, end)
            n = batch.num_rows
            packed = ids.astype(width)
            offsets = pa.py_buffer((to * packed.itemsize).astype(np.int32).tobytes())
            column = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(packed.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(np.arange(seq, seq + n)), batch.column("doc_id"), column],
                names=["shard", "seq", "doc_id", "ids"])
            seq += n

    source = _ordered(docs, id, text).select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    return scratch.keep(source.mapInArrow(run, "shard int, seq long, doc_id long, ids binary"), "ids")


def _ended(ids: np.ndarray, to: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's."""
    to = to + np.arange(len(to))
    out, own = np.empty(to[-1], np.int64), np.ones(to[-1], bool)
    own[to[1:] - 1] = False
    out[own], out[~own] = ids, end
    return out, to


def _packed(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids of a column of packed ids, n+1 offsets of its rows in them)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole.view(width), (at - at[0]) // np.dtype(width).itemsize


def _counts(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(_packed(batch.column("ids"), width)[0], minlength=len(total))
            got[: len(total)] += total
            total = got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "count"])

    return run


def write_store(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", model: str | None = None, end: int | None = END,
    block: int = BLOCK, every: int = EVERY, most: int = MOST_BITS) -> None:
    """Tokenize every whole text and write the store below ``path``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    model = model or _public(MODEL)
    width = width_of(model)
    ids = tokenized(docs, scratch, id, text, model, end)
    code = ids.select("ids").mapInArrow(_counts(width), "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).collect()  # bounded by the vocabulary
    counts = np.zeros(max((r["id"] for r in code), default=-1) + 1, np.int64)
    for r in code:
        counts[r["id"]] = r["count"]
    lengths = code_lengths(counts, max(most, int(max(1, np.count_nonzero(counts)) - 1).bit_length()))
    used = np.flatnonzero(lengths)
    rows = pa.table({"id": pa.array(used, pa.int64()), "count": pa.array(counts[used], pa.int64()), "bits": pa.array(lengths[used].astype(np.int32), pa.int32())})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/code")
    sent = spark.sparkContext.broadcast(lengths)  # a byte for each id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(sent.value)
        held: list[tuple[int, int, int, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            sizes = [len(x[3]) for x in held]
            data, at = coder.encode(np.concatenate([x[3] for x in held]), every)
            row = {"shard": held[0][0], "seq": held[0][1], "n_ids": sum(sizes), "doc_ids": [x[2] for x in held], "sizes": sizes,
                "checkpoints": at.tolist(), "crc": zlib.crc32(data), "payload": data}
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        n = 0
        for batch in batches:
            every_id, to = _packed(batch.column("ids"), width)
            for shard, seq, doc, a, b in zip(*(batch.column(c).to_pylist() for c in ("shard", "seq", "doc_id")), to.tolist(), to[1:].tolist()):
                if held and (held[0][0] != shard or held[-1][1] != seq - 1):
                    yield flush()
                    n = 0
                held.append((shard, seq, doc, every_id[a:b]))
                n += b - a
                if n >= block:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    arrow = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())), ("checkpoints", pa.list_(pa.int64())), ("crc", pa.int64()), ("payload", pa.binary())])
    blocks = ids.mapInArrow(run, "shard int, seq long, n_ids long, doc_ids array<long>, sizes array<long>, checkpoints array<long>, crc long, payload binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    scratch.drop(ids)


def read_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.parquet(f"{path}/code").select("id", "bits").collect()  # bounded by the vocabulary
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    return Code(lengths)


def read_store(spark: SparkSession, path: str, ids: bool = True, every: int = EVERY) -> DataFrame:
    """Per document of the store: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the ids of all documents before. Shards' totals are few (one for
    each partition that wrote); the sums within a shard are taken shard by shard.
    """
    ship(spark)
    sent = spark.sparkContext.broadcast(read_code(spark, path).lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("shard_start"))
    index = blocks.select("shard", "seq", (F.sum("n_ids").over(W.partitionBy("shard").orderBy("seq")) - F.col("n_ids")).alias("at"))
    starts = index.join(before, "shard").select("shard", "seq", (F.col("at") + F.col("shard_start")).alias("block_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(sent.value)
        for whole in batches:
            for start in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(start, TOGETHER)
                payloads = batch.column("payload").to_pylist()
                for shard, seq, crc, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "seq", "crc")), payloads):
                    if zlib.crc32(payload) != crc:
                        raise ValueError(f"block {shard}/{seq} is damaged")
                n_ids, points = (batch.column(c).to_numpy() for c in ("n_ids", "n_points"))
                at = batch.column("checkpoints").flatten().to_numpy() + np.repeat(8 * (np.cumsum([len(x) for x in payloads]) - [len(x) for x in payloads]), points)
                # stretches are of ``every`` ids, but for the last one of each block
                segments, last = np.full(len(at), every), np.cumsum(points) - 1
                segments[last[points > 0]] = (n_ids - every * (points - 1))[points > 0]
                got = coder.decode(b"".join(payloads), at, segments).astype("<u4")
                sizes, n_docs = batch.column("sizes").flatten().to_numpy(), batch.column("n_docs").to_numpy()
                ends, block_ends = np.cumsum(sizes), np.cumsum(n_ids)
                within = ends - sizes - np.repeat(block_ends - n_ids, n_docs)
                parts = [got[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
                columns = [pa.array(np.repeat(batch.column("shard").to_numpy(), n_docs)), pa.array(np.repeat(batch.column("seq").to_numpy(), n_docs)),
                    batch.column("doc_ids").flatten(), pa.array(within), pa.array(sizes), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(parts, pa.binary())] if ids else [])], names=names)

    names = ["shard", "seq", "doc_id", "within", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    whole = blocks.withColumns({"n_docs": F.size("sizes").cast("long"), "n_points": F.size("checkpoints").cast("long")})
    docs = whole.mapInArrow(run, "shard int, seq long, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)
    return docs.join(starts, ["shard", "seq"]).select("doc_id", (F.col("block_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if ids else []))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = Scratch(spark, "store").path("documents")
    write_store(docs, path)
    return read_store(spark, path, ids=False)

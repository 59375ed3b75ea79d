"""Token counts of huge documents by overlap resynchronisation.

A document up to ``chunk`` characters is encoded at once. A longer one is cut into
chunks that overlap; each is encoded with the byte offsets of its tokens, and
neighbours are spliced at a boundary that both have and that is *stable*: a place
before a space that follows another character. The vocabulary is checked to hold no
piece with a space after another character, so no merge ever crosses such a place
and what the tokenizer does on one side can't depend on the other. The first such
place of a chunk may be an artefact of its start and isn't used. Where an overlap has
no such place it is doubled, up to the whole document.

Edge cases: null and empty texts have 0 tokens; a text of spaces only, or without any
space, is encoded whole however long it is; rows are independent, so repeated rows,
repeated ids and null ids each give a row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table

MODEL = "piece_bpe_32k.model"
CHUNK = 16_384
OVERLAP = 256
LIMIT = 4096
SPACE = "▁"


class Pieces:
    """A sentencepiece model with the byte length of each piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        for i, name in enumerate(names):
            if SPACE in name.lstrip(SPACE) and not self.model.is_control(i):
                raise ValueError(f"piece {name!r} joins across a space: no boundary is proven stable")
        self.size = np.array([1 if self.model.is_byte(i) else len(n.replace(SPACE, " ").encode()) for i, n in enumerate(names)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def ends(self, ids: list[int], size: int) -> np.ndarray | None:
        """Byte offsets of the tokens' ends; None where the model changed the text."""
        at = np.cumsum(self.size[ids]) - 1  # the model puts a space before a text
        return at if len(at) and at[-1] == size else None


@functools.lru_cache(maxsize=4)
def pieces_at(path: str) -> Pieces:
    return Pieces(path)


def stable(data: np.ndarray) -> np.ndarray:
    """Byte places before a space that follows another character."""
    space = data == 0x20
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


class _Chunk:
    """text[a:b], encoded, with the byte offsets of its tokens' ends."""

    def __init__(self, pieces: Pieces, text: str, a: int, b: int):
        part = text[a:b]
        self.a, self.b = a, b
        self.data = np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8)
        self.ids = np.asarray(pieces.encode([part])[0], np.int64)
        self.ends = pieces.ends(self.ids, len(self.data))


def splice(left: _Chunk, right: _Chunk, text: str) -> tuple[int, int, int] | None:
    """A stable boundary that both chunks have: tokens of ``left`` before it, of ``right`` before it, its byte place in ``right``."""
    if left.ends is None or right.ends is None:
        return None
    shift = len(text[left.a : right.a].encode("utf-8", "surrogatepass"))
    places = stable(right.data[: len(left.data) - shift])
    i, j = np.searchsorted(left.ends, places + shift), np.searchsorted(right.ends, places)
    good = (left.ends[np.minimum(i, len(left.ends) - 1)] == places + shift) & (right.ends[np.minimum(j, len(right.ends) - 1)] == places)
    found = np.flatnonzero(good)
    return (int(i[found[0]]) + 1, int(j[found[0]]) + 1, int(places[found[0]])) if len(found) else None


def encode_long(pieces: Pieces, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
    """The ids of a long text, the same as if it were encoded at once."""
    out: list[np.ndarray] = []
    left = _Chunk(pieces, text, 0, min(len(text), chunk + overlap))
    taken = 0  # tokens of left that are before its first proven boundary
    while left.b < len(text):
        width = overlap
        while width < left.b - left.a:
            right = _Chunk(pieces, text, left.b - width, min(len(text), left.b + chunk))
            joined = splice(left, right, text)
            if joined and joined[0] >= taken:
                break
            width *= 2
        else:  # no boundary up to the start of left: take both as one chunk
            left = _Chunk(pieces, text, left.a, min(len(text), left.b + max(chunk, left.b - left.a)))
            if left.a:
                taken = int(np.searchsorted(left.ends, start)) + 1 if left.ends is not None else -1
            if taken < 0:
                return np.asarray(pieces.encode([text])[0], np.int64)
            continue
        out.append(left.ids[taken : joined[0]])
        left, taken, start = right, joined[1], joined[2]
    return np.concatenate([*out, left.ids[taken:]])


def count_tokens(pieces: Pieces, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Tokens of each text: short ones in one call, long ones by overlapping chunks."""
    short = [i for i, x in enumerate(texts) if len(x) <= chunk + overlap]
    out = [0] * len(texts)
    for i, ids in zip(short, pieces.encode([texts[i] for i in short])):
        out[i] = len(ids)
    for i, x in enumerate(texts):
        if len(x) > chunk + overlap:
            out[i] = len(encode_long(pieces, x, chunk, overlap))
    return out


def token_counts(docs: DataFrame, text: str = "text", model: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without ``text``, plus n_bytes (UTF-8) and n_tokens.

    ``model`` is the path of a sentencepiece file that every executor can read. Other
    columns pass through; columns named n_bytes or n_tokens are replaced.
    """
    ship(docs.sparkSession)
    path = model or _public(MODEL)
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = source.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_at(path)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column("__text")
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pc.binary_length(texts).cast("int64"),
                        pa.array(count_tokens(pieces, texts.to_pylist(), chunk, overlap), pa.int64())],
                    names=[*kept, "n_bytes", "n_tokens"],
                )

    return source.mapInArrow(run, schema)


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)

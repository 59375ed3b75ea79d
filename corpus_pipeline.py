"""A training corpus from ``documents``: five stages, each one of the operators of ``vellumgrid.llm``.

1. ``language`` keeps documents whose language is known (not ``und``, score of 0.3 or more).
2. ``near_dedup`` keeps one document of each group that is linked by a similarity of 0.8.
3. ``decontaminate`` drops documents in which a benchmark item occurs.
4. ``mix`` repeats or leaves out whole documents so that sources meet their targets.
5. ``token_store`` writes token ids in Huffman blocks and reads the digest of each document.

Every stage works on all that the one before kept. All but the last return the columns
they were given. Null ids, texts, sources and languages, repeated rows, empty tables and
further columns are allowed; what each stage does with them stands in its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellumgrid.llm.common import Scratch, table
from vellumgrid.llm.decontaminate import decontaminated
from vellumgrid.llm.language_id import accepted, fit, sample
from vellumgrid.llm.near_dedup import deduplicated
from vellumgrid.llm.source_mix import repetitions
from vellumgrid.llm.token_store import read_store, write_store

#: Percent of shared shingles that make two documents near duplicates here.
SIMILARITY = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, fit(sample(docs, "doc_id", "text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs, percent=SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetitions(docs)


def token_store(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "store").path("corpus")
    write_store(docs, path)
    return read_store(spark, path, ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_store", token_store),
]

#: Linear support vector machines, alignments and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.clear(docs)  # what the stage read is not needed any more
    return STAGES[-1][1](spark, docs, sf_dir)

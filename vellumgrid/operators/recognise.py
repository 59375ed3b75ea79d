"""Recognition: model adapters, confidences, the choice between two passes, and elements.

Models stay outside: an adapter is a function from Arrow batches to Arrow batches that
loads what it needs once in each worker. Filters come before adapters, since a Python
function is called for every row that reaches it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import font_size
from ..functions.text import strip, top_probability
from ..plans.variants import SINGLE_BLOCK_LABELS, Variant
from ..sources.shipping import ship


def adapted(rows: DataFrame, load: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows`` through an outside model: ``load`` runs once in a task, its result once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            yield model(batch)

    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def failed_reads(text: str = "text", confidence: str = "confidence") -> dict:
    """What a failed recognition counts as: an empty text of confidence 0."""
    return {text: F.coalesce(F.col(text), F.lit("")), confidence: F.coalesce(F.col(confidence), F.lit(0.0))}


def large_enough(lines: DataFrame, rules: Variant) -> DataFrame:
    """Lines worth a model call."""
    return lines.where((F.col("y1") - F.col("y0") >= rules.line_height) & (F.col("x1") - F.col("x0") >= rules.line_width))


def confidences(steps: DataFrame, key: str, logits: str) -> DataFrame:
    """Mean over a key's steps of the largest softmax value; steps without scores don't count, and none at all give 0."""
    return steps.groupBy(key).agg(F.coalesce(F.avg(F.when(F.size(logits) > 0, top_probability(F.col(logits)))), F.lit(0.0)).alias("confidence"))


def winners(reads: DataFrame) -> DataFrame:
    """(page_id, region_id, n1, n2, winner) from (page_id, region_id, label, pass, text): 1, 2, or 0 if neither read anything."""
    full = lambda n: F.count_if((F.col("pass") == n) & (F.length(strip(F.col("text"))) > 0))
    both = reads.groupBy("page_id", "region_id").agg(F.max("label").alias("label"), full(1).alias("n1"), full(2).alias("n2"))
    first = (F.col("n1") > 0) & ~F.col("label").isin(*SINGLE_BLOCK_LABELS)
    choice = F.when(first, 1).when((F.col("n2") > 0) & (F.col("n2") >= F.col("n1")), 2).when(F.col("n1") > 0, 1).otherwise(0)
    return both.select("page_id", "region_id", "label", "n1", "n2", choice.alias("winner"))


def elements(lines: DataFrame, regions: DataFrame, rules: Variant) -> DataFrame:
    """Lines with boxes relative to their region (by region_id) as elements in page pixels; a line without a box has its region's."""
    of = regions.select("page_id", "region_id", F.col("label").alias("source_label"), F.col("position").alias("reading_position"),
        *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")])
    joined = lines.join(of, ["page_id", "region_id"])
    moved = {c: F.coalesce(F.col(c) + F.col("r_x0" if c[0] == "x" else "r_y0"), F.col(f"r_{c}")) for c in ("x0", "y0", "x1", "y1")}
    placed = joined.withColumns(moved).where(F.length(strip(F.col("text"))) > 0)
    return placed.withColumn("font_size", font_size(F.col("y1") - F.col("y0"), rules.font)).drop("r_x0", "r_y0", "r_x1", "r_y1")

"""Bounded samples of labelled rows for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

_SPACE = 1 << 30


def hashed(seed: int, id: str, text: str) -> Column:
    """What a row is drawn by: equal for rows of equal id and text only, so that an id that repeats is not drawn at once."""
    return F.xxhash64(F.lit(seed), F.col(f"`{id}`").cast("string"), F.col(f"`{text}`"))


def agreed(labels: DataFrame, id: str, label: str, values: tuple[int, ...] = (0, 1)) -> DataFrame:
    """(id, label) of ids whose labels all say the same; null ids and labels, and other values, are ignored."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.col("id").isNotNull() & F.col("label").isin(*values))
    return known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("id", "label")


def drawn(rows: DataFrame, scratch: Scratch, most: int, classes: int) -> DataFrame:
    """Of (id, h, label) at most ``most`` distinct (id, h) of each of the ``classes`` commonest labels, by the smallest h.

    Only counts of labels, ``classes`` at most, come to the driver; what is ranked in a
    task is some 1.3 * ``most`` rows, as the bar on h is set from the counts.
    """
    kept = scratch.keep(rows.distinct(), "drawn")
    counted = kept.groupBy("label").count().orderBy(F.desc("count"), "label").limit(classes).collect()
    place = F.pmod(F.col("h"), F.lit(_SPACE))
    bar = F.lit(-1)
    for r in counted:
        bar = F.when(F.col("label") == F.lit(r["label"]), F.lit(int(min(1.0, 1.3 * (most + 50) / r["count"]) * _SPACE))).otherwise(bar)
    order = W.partitionBy("label").orderBy(place, "h", "id")
    return scratch.keep(kept.where(place <= bar).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most), "chosen")


def fetched(docs: DataFrame, chosen: DataFrame, id: str, h: Column, columns: list[Column]) -> list:
    """The chosen rows with ``columns``, each once, in order of label and rank; as many as ``chosen`` has."""
    names = [f"c{i}" for i in range(len(columns))]
    source = docs.select(F.col(f"`{id}`").alias("id"), h.alias("h"), *[c.alias(n) for c, n in zip(columns, names)])
    rows = source.join(F.broadcast(chosen), ["id", "h"]).groupBy("label", "rank").agg(*[F.min(F.struct(*names)).alias("row")])
    return [(*r["row"], r["label"]) for r in sorted(rows.collect(), key=lambda r: (r["label"], r["rank"]))]

"""Reports as relations: counts of what was kept and dropped, sizes, and what to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import lookup, rgb
from ..functions.text import REASONS
from ..plans.variants import DEFAULT_COLOUR, LABEL_COLOURS, SEGMENT_COLOURS


def reasons(judged: DataFrame) -> DataFrame:
    """Lines of a page by what became of them, from a column ``reason``."""
    name = F.element_at(F.array(*[F.lit(x) for x in REASONS]), F.col("reason") + 1)
    return judged.groupBy("page_id", name.alias("reason")).agg(F.count("*").alias("n"))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.groupBy("page_id").agg(F.count_if(F.col("reason") == 0).alias("accepted"), F.count_if(F.col("reason") > 0).alias("filtered"))


def totals(judged: DataFrame, key: str) -> DataFrame:
    """Pages with lines, and lines kept and dropped, of a file."""
    return judged.groupBy(key).agg(F.countDistinct("page_id").alias("pages"), F.count_if(F.col("reason") == 0).alias("accepted"),
        F.count_if(F.col("reason") > 0).alias("filtered"))


def captions(lines: DataFrame) -> DataFrame:
    """The starts of texts that reports and pictures show: 40, 55 and 60 characters."""
    return lines.select("page_id", "line_no", *[F.substring("text", 1, n).alias(f"first_{n}") for n in (40, 55, 60)])


def artefact_lines(listed: DataFrame) -> DataFrame:
    """One line of text for each file: its name, and kilobytes at the right."""
    return listed.select(F.format_string("  %-55s %6d KB", "name", "kb").alias("line"))


def order_lines(ordered: DataFrame) -> DataFrame:
    """The final order as text: place, segment, line in it, and the start of the text."""
    return ordered.select("page_id", F.format_string("%4d  seg %2d  line %3d  %-40s",
        F.row_number().over(W.partitionBy("page_id").orderBy("seg_no", "line_in_seg")), "seg_no", "line_in_seg",
        F.substring("text", 1, 40)).alias("line"))


def labels(routed: DataFrame) -> DataFrame:
    return routed.groupBy("page_id", "label").agg(F.count("*").alias("n"))


def unknown(routed: DataFrame) -> DataFrame:
    """Distinct labels of a page that nothing is known about, in order."""
    return routed.where("route = 'unknown'").groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"))


def sizes(lines: DataFrame) -> DataFrame:
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return lines.groupBy("page_id").agg(*[f(x).alias(f"{n}_{k}") for k, x in (("w", w), ("h", h)) for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))])


def drawn_regions(regions: DataFrame) -> DataFrame:
    """Rectangles of labelled regions, in order of position (999 where missing)."""
    colour = lookup(LABEL_COLOURS, F.col("label"), F.lit(DEFAULT_COLOUR))
    at = rgb(colour)
    return regions.select("page_id", F.coalesce("position", F.lit(999)).alias("z"), "region_id", "x0", "y0", "x1", "y1",
        *[at[i].alias(c) for i, c in enumerate("rgb")], F.concat_ws(" ", F.col("position").cast("string"), "label").alias("caption"))


def drawn_lines(told: DataFrame) -> DataFrame:
    """Rectangles of lines in their segment's colour, with the first 40 characters."""
    colour = F.element_at(F.array(*[F.lit(c) for c in SEGMENT_COLOURS]), ((F.col("seg_no") - 1) % len(SEGMENT_COLOURS)).cast("int") + 1)
    return told.select("page_id", "line_no", "x0", "y0", "x1", "y1", colour.alias("colour"), F.substring("text", 1, 40).alias("caption"))


def marked(hist: DataFrame, gutters: DataFrame, bucket: float = 4.0, near: float = 12.0) -> DataFrame:
    """Histogram rows with the middle of each bucket and whether a gutter is near it."""
    centre = (F.col("bucket") + 0.5) * bucket
    is_near = F.exists("gutters", lambda g: F.abs(centre - g) < near)
    return hist.join(gutters.select("page_id", "gutters"), "page_id").select("page_id", "bucket", "cnt", centre.alias("centre"), is_near.alias("near_gutter"))


def column_labels(gutters: DataFrame, width: float) -> DataFrame:
    """(page_id, col, lo, hi, at): columns between gutters and where their names go."""
    edges = F.concat(F.array(F.lit(0.0)), F.col("gutters"), F.array(F.lit(float(width))))
    spans = gutters.select("page_id", edges.alias("e")).select("page_id", "e", F.explode(F.sequence(F.lit(1), F.size("e") - 1)).alias("col"))
    lo, hi = F.element_at("e", F.col("col")), F.element_at("e", F.col("col") + 1)
    return spans.select("page_id", "col", lo.alias("lo"), hi.alias("hi"), ((lo + hi) / 2 - 20).alias("at"))

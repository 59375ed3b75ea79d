"""The invisible text layer of a page, its metadata, and the checks around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import font_size
from ..functions.text import pdf_date, strip, xmp, xmp_date
from ..plans.variants import Page, Variant


def text_layer(elements: DataFrame, pages: DataFrame, rules: Variant, page: Page = Page()) -> DataFrame:
    """Elements in points; pages carry page_w and page_h in points, and elements of unknown pages go."""
    sx, sy = F.col("page_w") / page.width, F.col("page_h") / page.height
    size = F.greatest(F.lit(4.0), font_size(F.col("y1") - F.col("y0"), rules.font) * sy)
    joined = elements.join(pages.select("page_id", "page_w", "page_h"), "page_id")
    return joined.select("page_id", "elem_no", "text", (F.col("x0") * sx).alias("x_pt"), (F.col("y1") * sy).alias("y_pt"), size.alias("font_pt"),
        F.lit(3).alias("render_mode"))


def redactions(pages: DataFrame, elements: DataFrame, **rules: Variant) -> DataFrame:
    """page_id, and for each rule set by its name whether the page's old text layer goes."""
    n = elements.groupBy("page_id").agg(F.count("*").alias("n"))
    has = F.length(strip(F.coalesce("existing_text", F.lit("")))) > 0
    held = pages.select("page_id", has.alias("has")).join(n, "page_id", "left")
    read = F.coalesce("n", F.lit(0)) > 0
    return held.select("page_id", *[(F.col("has") & (F.lit(True) if v.clears_empty else read)).alias(name) for name, v in rules.items()])


def inserted(layer: DataFrame, ok: str = "ok") -> DataFrame:
    """(page_id, elements, inserted): an element whose insertion failed counts as one that wasn't inserted."""
    return layer.groupBy("page_id").agg(F.count("*").alias("elements"), F.count_if(F.coalesce(F.col(ok), F.lit(False))).alias("inserted"))


def empty_pages(pages: DataFrame, lines: DataFrame) -> DataFrame:
    return pages.join(lines, "page_id", "left_anti").select("page_id")


def characters(layer: DataFrame, key: str = "doc") -> DataFrame:
    """Characters that can be read back, and whether there are any."""
    n = F.sum(F.length(strip(F.col("text"))))
    return layer.groupBy(key).agg(F.coalesce(n, F.lit(0)).cast("long").alias("chars"), (F.coalesce(n, F.lit(0)) > 0).alias("success"))


def metadata(files: DataFrame, author: str, subject: str, creator: str, producer: str) -> DataFrame:
    """(name, title, created, xmp) from (name, at)."""
    at = xmp_date(F.col("at"))
    packet = xmp(F.col("name"), F.lit(author), F.lit(subject), F.lit(creator), F.lit(producer), at, at)
    return files.select("name", F.col("name").alias("title"), pdf_date(F.col("at")).alias("created"), packet.alias("xmp"))


def names(files: DataFrame) -> DataFrame:
    """The names that go with a file's stem through the run."""
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    return files.select("*", stem.alias("stem"), *[F.concat(stem, F.lit(end)).alias(alias) for alias,
        end in (("temp", "_ocr_temp.pdf"), ("final", "_final.pdf"), ("review", "_review.jpg"))])

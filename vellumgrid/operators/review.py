"""Side-by-side review: text spans of a page's existing layer and the canvas that holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

PADDING, OFFSET, BUFFER = 40.0, 10.0, 20


def spans(pages: DataFrame) -> DataFrame:
    """(page_id, span_no, text, x, y, size) of the first page's nested layer.

    ``blocks`` holds array<struct<lines: array<struct<spans: array<struct<text, chars,
    x0, y0, x1, y1, size, descent>>>>>>; a span's text is ``text`` or its joined ``chars``.
    Where no span has text, ``words`` (array<struct<x0, y0, x1, y1, text>>) stand in; words
    and blocks of fewer than five fields never reach this schema.
    """
    first = pages.where("page_num = 1")
    flat = F.flatten(F.transform("blocks", lambda b: F.flatten(F.transform(b["lines"], lambda line: line["spans"]))))
    text = lambda s: strip(F.coalesce(s["text"], F.array_join(s["chars"], ""), F.lit("")))
    rich = F.filter(F.transform(flat, lambda s: F.struct(text(s).alias("text"), (s["x0"] - OFFSET).alias("x"),
        (F.col("pix_h") - s["y1"] + s["descent"]).alias("y"), s["size"].alias("size"))), lambda s: F.length(s["text"]) > 0)
    guess = lambda w: F.greatest(F.lit(12), (w["y1"] - w["y0"]).cast("int")).cast("double")
    plain = F.filter(F.transform("words", lambda w: F.struct(strip(w["text"]).alias("text"), (w["x0"] - OFFSET).alias("x"),
        (F.col("pix_h") - w["y1"]).alias("y"), guess(w).alias("size"))), lambda s: F.length(s["text"]) > 0)
    either = F.when(F.size(rich) > 0, rich).otherwise(plain)
    return first.select("page_id", F.posexplode(either).alias("span_no", "s")).select("page_id", "span_no", "s.text", "s.x", "s.y", "s.size")


def cascade(pages: DataFrame) -> DataFrame:
    """(page_id, span_no, text, x, y, size) by the first way of reading the layer that doesn't fail.

    ``raw`` and ``dicts`` are arrays of spans (text, x0, y1, size, descent), ``plain`` and
    ``words`` arrays of (n, x0, y0, x1, y1, text), n being the fields that were there. A
    way that failed is null. The next way is tried only after a failure, but words
    also where the way that worked found no text. Pieces of fewer than five fields go.
    """
    filled = lambda x: F.filter(x, lambda s: F.length(s["text"]) > 0)
    rich = lambda c: filled(F.transform(c, lambda s: F.struct(strip(s["text"]).alias("text"), (s["x0"] - OFFSET).alias("x"),
        (F.col("pix_h") - s["y1"] + s["descent"]).alias("y"), s["size"].alias("size"))))
    guess = lambda w: F.greatest(F.lit(12), (w["y1"] - w["y0"]).cast("int")).cast("double")
    whole = lambda c: F.filter(c, lambda w: w["n"] >= 5)
    flat = lambda c: filled(F.transform(whole(c), lambda w: F.struct(strip(w["text"]).alias("text"), (w["x0"] - OFFSET).alias("x"),
        (F.col("pix_h") - w["y1"]).alias("y"), guess(w).alias("size"))))
    found = F.coalesce(rich("raw"), rich("dicts"), flat("plain"))
    either = F.when(F.size(found) > 0, found).otherwise(flat("words"))
    return pages.where("page_num = 1").select("page_id", F.posexplode(either).alias("span_no", "s")).select("page_id", "span_no", "s.text", "s.x", "s.y", "s.size")


def canvas(pages: DataFrame, placed: DataFrame) -> DataFrame:
    """(page_id, ocr_w, ocr_h, all_w, all_h) from pages (pix_w, pix_h) and placed text boxes (x, y, w, h); a page without text has a canvas of its own size."""
    around = placed.groupBy("page_id").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max(F.col("x") + F.col("w")).alias("x1"),
        F.max(F.col("y") + F.col("h")).alias("y1"))
    own = lambda lo, hi, pix: F.coalesce(F.greatest((F.col(hi) - F.col(lo) + 2 * PADDING).cast("int"), F.col(pix)) + BUFFER, F.col(pix))
    sized = pages.join(around, "page_id", "left").withColumns({"ocr_w": F.when(F.col("x0").isNull(),
        F.col("pix_w")).otherwise(own("x0", "x1", "pix_w")), "ocr_h": F.when(F.col("x0").isNull(),
        F.col("pix_h")).otherwise(own("y0", "y1", "pix_h"))})
    return sized.select("page_id", "ocr_w", "ocr_h", (F.col("pix_w") + F.col("ocr_w")).alias("all_w"), F.greatest("pix_h", "ocr_h").alias("all_h"))

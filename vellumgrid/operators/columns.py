"""Columns and stories of a page: centre histogram, gutters, column of each line, story breaks.

Counting shuffles (page, bucket) sums, not lines. What follows works on one small array for
each page, bounded by its width in buckets; only stories put the lines of one column in a
row, since a break depends on where the open story began.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.variants import Columns, Page

RULES, PAGE = Columns(), Page()
DOUBLES = "array<double>"


def histogram(lines: DataFrame, page: Page = PAGE, rules: Columns = RULES) -> DataFrame:
    """(page_id, bucket, cnt) of line centres, of narrow lines only where a page has any; buckets off the page are left out."""
    narrow = (F.col("x1") - F.col("x0") <= rules.narrow * page.width).cast("int")
    bucket = (((F.col("x0") + F.col("x1")) / 2) / rules.bucket).cast("int")
    counted = lines.groupBy("page_id", bucket.alias("bucket")).agg(F.sum(narrow).alias("few"), F.count("*").alias("all"))
    any_narrow = F.max("few").over(W.partitionBy("page_id")) > 0
    cnt = F.when(any_narrow, F.col("few")).otherwise(F.col("all"))
    return counted.select("page_id", "bucket", cnt.alias("cnt")).where((F.col("cnt") > 0) & F.col("bucket").between(0, _buckets(page, rules) - 1))


def _buckets(page: Page, rules: Columns) -> int:
    return int(page.width / rules.bucket) + 2


def peak(hist: DataFrame) -> DataFrame:
    """The fullest bucket (the first of equals), its count, and how many buckets hold any."""
    top = F.max_by("bucket", F.struct("cnt", -F.col("bucket")))
    return hist.groupBy("page_id").agg(top.alias("bucket"), F.max("cnt").alias("cnt"), F.count("*").alias("occupied"))


def gaps(hist: DataFrame, page: Page = PAGE, rules: Columns = RULES) -> DataFrame:
    """(page_id, gaps): middles of runs of nearly empty buckets, between full neighbours or the page's edges."""
    end = _buckets(page, rules)
    full = F.sort_array(F.collect_list(F.when(F.col("cnt") > rules.near_zero, F.col("bucket"))))
    walls = hist.groupBy("page_id").agg(F.concat(F.array(F.lit(-1)), full, F.array(F.lit(end))).alias("w"))
    runs = F.transform(F.slice("w", F.lit(1), F.size("w") - 1), lambda a, i: F.struct((a + 1).alias("a"), F.element_at("w", i + 2).alias("b")))
    wide = F.filter(runs, lambda r: (r["b"] - r["a"]) * rules.bucket >= rules.gap)
    return walls.select("page_id", F.transform(wide, lambda r: (r["a"] + r["b"] - 1) / 2.0 * rules.bucket).cast(DOUBLES).alias("gaps"))


def merged(gutters: Column, rules: Columns = RULES) -> Column:
    """Sorted gutters; one closer than ``merge`` to the last becomes the mean with it."""
    near = lambda acc, g: (F.size(acc) > 0) & (g - F.try_element_at(acc, F.lit(-1)) < rules.merge)
    step = lambda acc, g: F.when(near(acc, g), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
        F.array((F.try_element_at(acc, F.lit(-1)) + g) / 2))).otherwise(F.concat(acc, F.array(g)))
    return F.aggregate(F.sort_array(gutters), F.array().cast(DOUBLES), step)


def inside_margins(gutters: Column, page: Page = PAGE, rules: Columns = RULES) -> Column:
    margin = page.width * rules.margin
    return F.filter(gutters, lambda g: (g > margin) & (g < page.width - margin))


def wide_columns(gutters: Column, page: Page = PAGE, rules: Columns = RULES) -> Column:
    """Gutters left after the narrowest column, while too narrow, lost its right gutter (its left one at the page's edge)."""
    least = page.width * rules.column

    def step(acc: Column, _: Column) -> Column:
        edges = F.concat(F.array(F.lit(0.0)), acc, F.array(F.lit(page.width)))
        widths = F.transform(F.sequence(F.lit(1), F.size(acc) + 1), lambda i: F.element_at(edges, i + 1) - F.element_at(edges, i))
        drop = F.least(F.array_position(widths, F.array_min(widths)).cast("int"), F.size(acc))
        return F.when((F.size(acc) > 0) & (F.array_min(widths) < least), F.filter(acc, lambda g, i: i + 1 != drop)).otherwise(acc)

    turns = F.when(F.size(gutters) > 0, F.sequence(F.lit(1), F.size(gutters))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(turns, gutters, step)


def gutters(lines: DataFrame, page: Page = PAGE, rules: Columns = RULES) -> DataFrame:
    """(page_id, raw, merged, removed: rounded, gutters)."""
    found = gaps(histogram(lines, page, rules), page, rules).select("page_id", F.col("gaps").alias("raw"), merged(F.col("gaps"), rules).alias("merged"))
    kept = found.withColumn("inner", inside_margins(F.col("merged"), page, rules))
    rounded = lambda c: F.transform(c, lambda g: F.bround(g).cast("int"))
    return kept.select("page_id", "raw", "merged", F.sort_array(F.array_except(rounded("merged"), rounded("inner"))).alias("removed"),
        wide_columns(F.col("inner"), page, rules).alias("gutters"))


def in_columns(lines: DataFrame, page_gutters: DataFrame, page: Page = PAGE, rules: Columns = RULES) -> DataFrame:
    """``lines`` with is_header and col (0 for headers, else from 1), columns cut at their gutters; a line with nothing left goes."""
    joined = lines.join(page_gutters.select("page_id", "gutters"), "page_id", "left").withColumn("gutters", F.coalesce("gutters", F.array().cast(DOUBLES)))
    w, cy = F.col("x1") - F.col("x0"), (F.col("y0") + F.col("y1")) / 2
    header = (cy <= rules.header_zone * page.height) | ((w / page.width > rules.header_width) & (cy <= rules.header_top * page.height))
    k = F.size(F.filter("gutters", lambda g: F.col("x0") + w / 2 > g))
    placed = joined.withColumn("is_header", header).withColumn("__k", k)
    left, right = F.try_element_at("gutters", F.when(F.col("__k") > 0, F.col("__k"))), F.try_element_at("gutters", F.col("__k") + 1)
    x0 = F.when(~F.col("is_header") & (F.col("x0") < left), left + 2).otherwise(F.col("x0"))
    x1 = F.when(~F.col("is_header") & (F.col("x1") > right), right - 2).otherwise(F.col("x1"))
    cut = placed.withColumns({"__x0": x0, "__x1": x1, "col": F.when(F.col("is_header"), 0).otherwise(F.col("__k") + 1)})
    return cut.where("is_header or __x1 > __x0").withColumns({"x0": F.col("__x0"), "x1": F.col("__x1")}).drop("__x0", "__x1", "__k", "gutters")


def stories(placed: DataFrame, rules: Columns = RULES, also: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, line_no, is_header, col, sub, seg_no, line_in_seg, note, the box, and the columns ``also``) in reading order.

    A story ends at a gap of ``photo_gap``, or of ``story_gap`` once it spans more than
    ``story_span``; headers are one segment before all columns.
    """
    row = F.struct("y0", "line_no", "y1", "x0", "x1", *also)
    grouped = placed.groupBy("page_id", "is_header", "col").agg(F.array_sort(F.collect_list(row)).alias("all"))
    start = F.struct(F.lit(0).alias("sub"), F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("bottom"),
        F.array().cast("array<int>").alias("subs"))

    def step(s: Column, r: Column) -> Column:
        gap, span = r["y0"] - s["bottom"], s["bottom"] - s["top"]
        new = F.coalesce((gap >= rules.photo_gap) | ((gap >= rules.story_gap) & (span > rules.story_span)), F.lit(False)) & ~F.col("is_header")
        sub = s["sub"] + new.cast("int")
        return F.struct(sub.alias("sub"), F.when(new | s["top"].isNull(), r["y0"]).otherwise(s["top"]).alias("top"), r["y1"].alias("bottom"),
            F.concat(s["subs"], F.array(sub)).alias("subs"))

    split = grouped.withColumn("__subs", F.aggregate("all", start, step)["subs"]).withColumn("__n", F.array_max("__subs") + 1)
    flat = split.select("page_id", "is_header", "col", "__n", F.explode(F.arrays_zip(F.col("all").alias("r"), F.col("__subs").alias("sub"))).alias("z"))
    note = F.when(F.col("is_header"), "HEADER").otherwise(F.concat(F.lit("Col "), F.col("col").cast("string"),
        F.when(F.col("__n") > 1, F.chr(F.lit(97) + F.col("sub"))).otherwise("")))
    seg = F.dense_rank().over(W.partitionBy("page_id").orderBy("col", "sub"))
    lined = flat.select("page_id", "is_header", "col", "__n", "z.sub", "z.r.*").withColumn("seg_no", seg).withColumn("note", note)
    return lined.withColumn("line_in_seg", F.row_number().over(W.partitionBy("page_id", "seg_no").orderBy("y0", "line_no"))).drop("__n")


def wide_widths(lines: DataFrame, width: float, share: float = 0.28, most: int = 10) -> DataFrame:
    """(page_id, k, width): the first ``most`` widths, in the order of lines, of those too wide for a column; whole numbers, halves to even."""
    w = F.col("x1") - F.col("x0")
    place = F.row_number().over(W.partitionBy("page_id").orderBy("line_no"))
    return lines.where(w > share * width).select("page_id", place.alias("k"), F.bround(w).cast("int").alias("width")).where(F.col("k") <= most)


def with_text(told: DataFrame, accepted: DataFrame) -> DataFrame:
    """(page_id, seg_no, n, text_seg_no): segments that have accepted lines, and their number among those."""
    n = told.join(accepted.select("page_id", "line_no"), ["page_id", "line_no"]).groupBy("page_id", "seg_no").agg(F.count("*").alias("n"))
    return n.withColumn("text_seg_no", F.row_number().over(W.partitionBy("page_id").orderBy("seg_no")))


def segments(told: DataFrame) -> DataFrame:
    """Envelope and line count of each segment."""
    return told.groupBy("page_id", "seg_no").agg(F.first("note").alias("note"), F.count("*").alias("n_lines"), F.min("x0").alias("x0"),
        F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))

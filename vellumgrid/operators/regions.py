"""Layout regions: labels, geometry, suppression of overlaps, fallback and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import area, bbox, iou, lookup, scaled
from ..plans.variants import OCR_LABELS, REGION_HEIGHT, REGION_WIDTH, SKIP_LABELS, Page, Variant

BOX = ("x0", "y0", "x1", "y1")


def normalise(label: Column, rules: Variant) -> Column:
    """The label's canonical name; a missing one is Text."""
    known = F.coalesce(label, F.lit("Text"))
    return lookup(rules.aliases, known, known) if rules.aliases else known


def with_labels(regions: DataFrame, rules: Variant) -> DataFrame:
    return regions.withColumn("label", normalise(F.col("label"), rules)).withColumn("position", F.coalesce("position", F.lit(0)))


def route(label: Column) -> Column:
    return F.when(label.isin(*OCR_LABELS), "ocr").when(label.isin(*SKIP_LABELS), "skip").otherwise("unknown")


def alternatives(entries: Column, rules: Variant) -> Column:
    """(label, confidence) entries under canonical names, the last of a name, most likely first."""
    named = F.transform(entries, lambda e, i: F.struct((-e["confidence"]).alias("less"), normalise(e["label"], rules).alias("label"),
        e["confidence"].alias("confidence"), i.alias("i")))
    last = F.filter(named, lambda e: ~F.exists(named, lambda o: (o["label"] == e["label"]) & (o["i"] > e["i"])))
    return F.transform(F.array_sort(last), lambda e: F.struct(e["label"].alias("label"), e["confidence"].alias("confidence")))


def with_geometry(regions: DataFrame, box: str = "bbox", polygon: str = "polygon") -> DataFrame:
    """Box columns from ``box`` or ``polygon``; regions without either go."""
    found = regions.withColumn("__box", bbox(F.col(box), F.col(polygon))).where("__box is not null")
    return found.select("*", *[F.col("__box")[c].alias(c) for c in BOX]).drop("__box")


def rescaled(regions: DataFrame, page: Page = Page(), extent: str = "image_bbox") -> DataFrame:
    """From the model's image to page pixels by its extent alone, then without regions too small to read."""
    w, h = F.try_element_at(extent, F.lit(3)) - F.try_element_at(extent, F.lit(1)), F.try_element_at(extent, F.lit(4)) - F.try_element_at(extent, F.lit(2))
    both = (w > 0) & (h > 0)
    sx, sy = scaled(F.when(both, w), page.width), scaled(F.when(both, h), page.height)
    moved = regions.withColumns({"__sx": sx, "__sy": sy}).withColumns({c: F.col(c) * F.col("__sx" if c[0] == "x" else "__sy") for c in BOX}).drop("__sx", "__sy")
    return large_enough(moved)


def large_enough(regions: DataFrame, width: float = REGION_WIDTH, height: float = REGION_HEIGHT) -> DataFrame:
    return regions.where((F.col("x1") - F.col("x0") >= width) & (F.col("y1") - F.col("y0") >= height))


def clamped(regions: DataFrame, page: Page = Page()) -> DataFrame:
    """Whole pixels inside the page; null coordinates stay null."""
    inside = lambda c, most: F.when(F.col(c).isNotNull(), F.least(F.lit(int(most)), F.greatest(F.lit(0), F.col(c).cast("int"))))
    return regions.withColumns({c: inside(c, page.width if c[0] == "x" else page.height) for c in BOX})


def suppressed(regions: DataFrame, threshold: float, key: str = "page_id", id: str = "region_id") -> DataFrame:
    """``regions`` without those that overlap a larger kept one on their page by more than ``threshold``.

    Greedy: largest first, the first in order among equals; one that was dropped drops no
    other. A page's regions meet in one row, and only boxes and ids do.
    """
    row = F.struct((-area(F.struct(*BOX))).alias("less"), F.col(id).alias("id"), *BOX)
    pages = regions.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("all"))
    none = F.slice(F.col("all"), 1, 0)
    kept = F.aggregate("all", none, lambda acc, r: F.when(F.exists(acc, lambda k: iou(k, r) > threshold), acc).otherwise(F.concat(acc, F.array(r))))
    return regions.join(pages.select(key, F.explode(kept).alias("k")).select(key, F.col("k.id").alias(id)), [key, id], "left_semi")


def overlaps(regions: DataFrame, key: str = "page_id", id: str = "region_id") -> DataFrame:
    """(key, a, b, iou) of regions that overlap on a page."""
    boxes = regions.select(key, F.col(id).alias("id"), F.struct(*BOX).alias("box"))
    pairs = boxes.select(key, F.col("id").alias("a"), F.col("box").alias("p")).join(boxes.select(key, F.col("id").alias("b"),
        F.col("box").alias("q")), key).where("a < b")
    return pairs.select(key, "a", "b", iou(F.col("p"), F.col("q")).alias("iou")).where("iou > 0")


def in_turn(routed: DataFrame) -> DataFrame:
    """Regions to be read, with their turn on the page: by position (999 where missing), then number."""
    turn = W.partitionBy("page_id").orderBy(F.coalesce("position", F.lit(999)), "region_id")
    return routed.where("route = 'ocr'").withColumn("turn", F.row_number().over(turn))


def with_fallback(pages: DataFrame, regions: DataFrame, page: Page = Page(), key: str = "page_id") -> DataFrame:
    """All regions, and for pages without any one that covers the page."""
    whole = pages.join(regions.select(key).distinct(), key, "left_anti").select(
        key, F.lit(0).alias("region_id"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(page.width).alias("x1"),
            F.lit(page.height).alias("y1"), F.lit("Text").alias("label"), F.lit(0).alias("position")
    )
    return regions.select(*whole.columns).unionByName(whole)

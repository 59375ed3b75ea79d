"""The registered queries of the layout operators, over relations derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.geometry import bbox, font_size, rgb
from .functions.text import noise_reason, strip
from .operators import budget, columns, order, pixels, recognise, regions, reports, review, textlayer
from .plans.variants import SEGMENT_COLOURS, A, B, C, D, Page, S, Variant
from .sources.tables import lines, listed, noise_lines, table
from .sources.tables import regions as raw_regions

PAGE = Page()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.with_labels(raw_regions(spark, sf_dir), D)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 8 by 6 inches, every third with a text layer of its own."""
    old = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise("")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit(576.0).alias("page_w"), F.lit(432.0).alias("page_h"),
        old.alias("existing_text"))


@query
def reading_order_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.ordered(order.assigned(lines(spark, sf_dir), raw_regions(spark, sf_dir))).select("page_id", "line_no", "region_id", "bucket_no", "order_no")


@query
def row_bucket_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.by_rows(lines(spark, sf_dir)).select("page_id", "line_no", "row_bucket", "order_no")


@query
def min_size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines(spark, sf_dir).withColumn("y1", F.col("y0") + F.col("line_no") % 12).withColumn("x1",
        F.when(F.col("line_no") % 5 == 0, F.col("x0") + 14).otherwise(F.col("x1")))
    return recognise.large_enough(cut, D).select("page_id", "line_no")


def _judged(spark: SparkSession, sf_dir: str, rules: Variant) -> DataFrame:
    reason = noise_reason(F.col("text"), F.col("confidence"), F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"), rules)
    return noise_lines(spark, sf_dir).withColumn("reason", reason)


for _rules in (S, A, C, D):
    QUERIES[f"noise_reasons_{_rules.name}"] = lambda spark, sf_dir, rules=_rules: _judged(spark, sf_dir, rules).select("page_id", "line_no", "reason")


@query
def noise_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reasons(_judged(spark, sf_dir, D))


@query
def accepted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.accepted(_judged(spark, sf_dir, S))


@query
def file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals(_judged(spark, sf_dir, S).withColumn("doc", F.col("page_id") % 50), "doc")


@query
def read_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth read failed: its text is empty, so the first noise rule takes the line."""
    lost = F.col("line_no") % 10 == 3
    read = noise_lines(spark, sf_dir).withColumns({"failed": lost, "text": F.when(~lost, F.col("text")), "confidence": F.when(~lost, F.col("confidence"))})
    held = read.withColumns(recognise.failed_reads())
    reason = noise_reason(F.col("text"), F.col("confidence"), F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"), D)
    return held.withColumn("reason", reason).groupBy("page_id").agg(F.count_if("failed").alias("failed"),
        F.count_if(F.col("reason") == 1).alias("empty"), F.count_if(F.col("reason") == 0).alias("accepted"))


@query
def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.captions(lines(spark, sf_dir))


@query
def label_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = raw_regions(spark, sf_dir).select("page_id", "region_id",
        *[regions.normalise(F.when(F.col("region_id") != 2, F.col("label")), v).alias(f"label_{v.name}") for v in (B, D)])
    return named


@query
def label_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("page_id", "region_id", "label", regions.route(F.col("label")).alias("route"))


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.labels(_named(spark, sf_dir))


@query
def unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unknown(label_route(spark, sf_dir))


@query
def reading_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = label_route(spark, sf_dir).withColumn("position", F.when(F.col("region_id") != 1, (F.col("region_id") * 3) % 4))
    return regions.in_turn(moved).select("page_id", "region_id", "turn")


@query
def topk_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = lambda label, n: F.struct(F.lit(label).alias("label"), (n / F.lit(10.0)).alias("confidence"))
    at = F.col("page_id"), F.col("region_id")
    held = raw_regions(spark, sf_dir).withColumn("top_k", F.array(entry("body", (at[0] + at[1]) % 7), entry("Text", (3 * at[0] + at[1]) % 7),
        entry("Caption", (at[0] + 2 * at[1]) % 5), entry("Mystery", at[1])))
    best = held.select("page_id", "region_id", F.posexplode(regions.alternatives(F.col("top_k"), D)).alias("k", "e"))
    return best.select("page_id", "region_id", "k", "e.label", "e.confidence")


@query
def bbox_from_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = F.array(point("x1", "y0"), point("x0", "y0"), point("x0", "y1"), point("x1", "y1"))
    kind = F.col("page_id") % 5
    held = raw_regions(spark, sf_dir).select("page_id", "region_id", F.when(kind > 2, F.struct(*regions.BOX)).alias("bbox"),
        F.when(kind == 0, corners).when(kind == 1, F.slice(corners, 1, 3)).alias("polygon"))
    return regions.with_geometry(held).select("page_id", "region_id", *regions.BOX)


@query
def rescale_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    kind = F.col("page_id") % 5
    extent = F.when(kind == 1, box(0, 0, 2400, 1800)).when(kind == 2, box(0, 0, 1200, 900)).when(kind == 3, box(100, 100, 1300, 1000)).when(kind == 4, box(0, 0, 0, 900))
    return regions.rescaled(raw_regions(spark, sf_dir).withColumn("image_bbox", extent), PAGE).select("page_id", "region_id", *regions.BOX)


@query
def clamp_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = raw_regions(spark, sf_dir).withColumns({"x0": F.col("x0") - 20.5, "y1": F.col("y1") + 0.75})
    return regions.clamped(moved, PAGE).select("page_id", "region_id", *regions.BOX)


@query
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.overlaps(raw_regions(spark, sf_dir)).withColumn("iou", F.round("iou", 9))


@query
def nms_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.suppressed(regions.large_enough(raw_regions(spark, sf_dir)), D.iou).select("page_id", "region_id")


@query
def fallback_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"))
    return regions.with_fallback(pages, _named(spark, sf_dir), PAGE).select("page_id", "region_id", "label", *regions.BOX)


@query
def gutter_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.histogram(lines(spark, sf_dir))


@query
def histogram_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.peak(columns.histogram(lines(spark, sf_dir)))


@query
def histogram_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines(spark, sf_dir)
    return reports.marked(columns.histogram(found), columns.gutters(found))


def _listed(name: str, alias: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return columns.gutters(lines(spark, sf_dir)).select("page_id", F.posexplode(name).alias("i", alias))

    return run


QUERIES |= {"gutter_gaps": _listed("raw", "gap"), "gutters_final": _listed("gutters", "gutter"), "gutters_removed": _listed("removed", "removed")}


@query
def gutters_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gutters at pseudo-random places close enough to meet, since histogram gaps never are."""
    near = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: ((F.col("page_id") * i * 37) % 240).cast("double"))
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"))
    return pages.select("page_id", F.posexplode(columns.merged(near)).alias("i", "gutter"))


@query
def gutters_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow-column rule on pseudo-random gutters."""
    places = F.sort_array(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: (100 + (F.col("page_id") * i * 137) % 2200).cast("double")))
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"))
    return pages.select("page_id", F.posexplode(columns.wide_columns(places)).alias("i", "gutter"))


@query
def column_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.column_labels(columns.gutters(lines(spark, sf_dir)), PAGE.width)


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines(spark, sf_dir)
    return columns.stories(columns.in_columns(found.select("page_id", "line_no", *regions.BOX), columns.gutters(found)))


@query
def column_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines(spark, sf_dir)
    return columns.in_columns(found, columns.gutters(found)).select("page_id", "line_no", "is_header", "col", "x0", "x1")


@query
def story_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(spark, sf_dir).select("page_id", "line_no", "seg_no", "line_in_seg", "note")


@query
def order_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines(spark, sf_dir)
    return reports.order_lines(columns.stories(columns.in_columns(found.select("page_id", "line_no", "text", *regions.BOX), columns.gutters(found)), also=("text",)))


@query
def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.segments(_told(spark, sf_dir))


@query
def wide_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.wide_widths(lines(spark, sf_dir).withColumn("x1", F.col("x1") + F.col("line_no") / 2.0), PAGE.width)


@query
def segments_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.with_text(_told(spark, sf_dir).select("page_id", "line_no", "seg_no"), _judged(spark, sf_dir, A).where("reason = 0"))


@query
def token_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise.confidences(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumn("confidence", F.round("confidence", 6))


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = noise_lines(spark, sf_dir).select("page_id", "line_no", (F.col("line_no") % 4).alias("region_id"),
        F.when(F.col("line_no") % 3 == 0, 2).otherwise(1).alias("pass"), "text")
    return held.join(_named(spark, sf_dir).select("page_id", "region_id", "label"), ["page_id", "region_id"])


@query
def two_pass_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise.winners(_reads(spark, sf_dir))


@query
def elements_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = noise_lines(spark, sf_dir).select("page_id", (F.col("line_no") % 4).alias("region_id"), F.col("line_no").alias("elem_no"), "text",
        *[F.when(F.col("line_no") % 7 != 0, F.col(c)).alias(c) for c in regions.BOX])
    return order.by_position(recognise.elements(inside, _named(spark, sf_dir), D)).select("page_id", "elem_no", "source_label", "font_size", "order_no", *regions.BOX)


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, D).where("reason = 0").withColumnRenamed("line_no", "elem_no")


@query
def text_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = textlayer.text_layer(_elements(spark, sf_dir), _pages(spark, sf_dir), D, PAGE)
    return out.select("page_id", "elem_no", *[F.round(c, 6).alias(c) for c in ("x_pt", "y_pt", "font_pt")], "render_mode", F.length("text").alias("n_chars"))


@query
def inserted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements whose number ends in 9 stand for those that couldn't be inserted."""
    return textlayer.inserted(_elements(spark, sf_dir).select("page_id", (F.col("elem_no") % 10 != 9).alias("ok")))


@query
def redaction_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlayer.redactions(_pages(spark, sf_dir), _elements(spark, sf_dir), s=S, d=D)


@query
def empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlayer.empty_pages(_pages(spark, sf_dir), _elements(spark, sf_dir))


@query
def char_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlayer.characters(_elements(spark, sf_dir).withColumn("doc", F.col("page_id") % 50))


@query
def docinfo_xmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "orders").select(F.concat(F.lit("scan "), F.col("o_orderkey").cast("string"), F.lit(".v1.pdf")).alias("name"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    info = textlayer.metadata(named, "", 'Recognised "text" & <more>', "vellumgrid", "vellumgrid")
    return textlayer.names(info).select("name", "title", "created", F.sha2("xmp", 256).alias("xmp_sha256"), "temp", "final", "review")


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    sized = table(spark, sf_dir, "orders").select(k.alias("name"), (1000 + k * 7919 % 100000).alias("orig_size"),
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("option"))
    plain = F.col("orig_size") + F.col("orig_size") * (F.col("name") * 31 % 40) / 100
    size = F.col("orig_size") + F.col("orig_size") * (F.col("name") * F.col("option") * 17 % 35) / 100
    return sized.select("name", "orig_size", plain.cast("long").alias("plain_size"), "option", size.cast("long").alias("size"),
        (F.col("name") * 13 % 3 * (F.col("option") + F.col("name")) % 5).alias("chars"))


@query
def size_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = _attempts(spark, sf_dir)
    one = lambda v: budget.chosen(tried, v).withColumn("variant", F.lit(v.name))
    return one(S).unionByName(one(D))


@query
def size_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), (F.col("o_orderkey") * 7919 % 1000).alias("orig_size"),
        (F.col("o_totalprice") * 10).cast("long").alias("final_bytes"))
    return budget.grown(sized).withColumn("growth", F.round("growth", 6))


@query
def artefact_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named and sized after orders."""
    found = table(spark, sf_dir, "orders").select(F.concat(F.lit("page_"), F.col("o_orderkey").cast("string"), F.lit("_lines.txt")).alias("name"),
        (F.col("o_totalprice") * 100).cast("long").alias("length"))
    return listed(found)


@query
def artefact_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.artefact_lines(artefact_list(spark, sf_dir))


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = budget.chosen(_attempts(spark, sf_dir), D).withColumn("success", F.col("name") % 9 != 0)
    return budget.summary(done)


@query
def bbox_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sizes(lines(spark, sf_dir))


@query
def draw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.drawn_regions(_named(spark, sf_dir))


@query
def draw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines(spark, sf_dir)
    told = columns.stories(columns.in_columns(found.select("page_id", "line_no", "text", *regions.BOX), columns.gutters(found)), also=("text",))
    return reports.drawn_lines(told)


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a nested layer: the lines of a document as words, and as spans (with text or characters) on two of three."""
    parts = F.split("text", "\n")
    box = lambda i: [F.lit(30.0).alias("x0"), (60.0 + 30 * i).alias("y0"), F.lit(600.0).alias("x1"), (80.5 + 30 * i).alias("y1")]
    kind = F.col("doc_id") % 3
    span = lambda x, i: F.struct(F.when(kind == 0, x).alias("text"), F.when(kind == 1, F.split(x, "")).alias("chars"), *box(i),
        F.lit(9.0).alias("size"), F.lit(-2.0).alias("descent"))
    blocks = F.array(F.struct(F.transform(parts, lambda x, i: F.struct(F.array(span(x, i)).alias("spans"))).alias("lines")))
    words = F.transform(parts, lambda x, i: F.struct(*box(i), x.alias("text")))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit(1).alias("page_num"), F.lit(1800.0).alias("pix_h"),
        F.lit(2400.0).alias("pix_w"), blocks.alias("blocks"), words.alias("words"))


@query
def review_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.spans(_reviewed(spark, sf_dir))


@query
def review_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of which the first ways fail or find nothing, by document."""
    parts, kind = F.split("text", "\n"), F.col("doc_id") % 5
    span = lambda x, i: F.struct(F.concat(F.lit(" "), F.when(kind != 3, x)).alias("text"), F.lit(40.0).alias("x0"), (70.0 + 20 * i).alias("y1"),
        F.lit(11.0).alias("size"), F.lit(-3.0).alias("descent"))
    piece = lambda x, i: F.struct((3 + i % 3).cast("int").alias("n"), F.lit(30.0).alias("x0"), (60.0 + 30 * i).alias("y0"), F.lit(600.0).alias("x1"),
        (70.5 + 31 * i).alias("y1"), x.alias("text"))
    spans, pieces = F.transform(parts, span), F.transform(parts, piece)
    held = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), (1 + F.col("doc_id") % 7 % 2).cast("int").alias("page_num"), F.lit(1800.0).alias("pix_h"),
        F.when(kind == 0, spans).alias("raw"), F.when(kind.isin(1, 3), spans).alias("dicts"), F.when(kind == 2, pieces).alias("plain"), pieces.alias("words"),
    )
    return review.cascade(held)


@query
def review_canvas(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit(500).alias("pix_w"), F.lit(400).alias("pix_h"))
    placed = review_spans(spark, sf_dir).select("page_id", "x", "y", (F.length("text") * 6.0).alias("w"), F.col("size").alias("h"))
    return review.canvas(pages, placed)


@query
def span_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that only polygons give, font sizes in both factors, and segment colours."""
    held = lines(spark, sf_dir)
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    box = bbox(F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>"), F.array(point("x0", "y1"), point("x1", "y1"), point("x1", "y0"), point("x0", "y0")))
    colour = F.element_at(F.array(*[F.lit(c) for c in SEGMENT_COLOURS]), (F.col("line_no") % 10 + 1).cast("int"))
    return held.select("page_id", "line_no", (box["x1"] - box["x0"]).alias("w"), font_size(box["y1"] - box["y0"], S.font).alias("font_s"),
        font_size(box["y1"] - box["y0"], D.font).alias("font_d"), rgb(colour)[0].alias("red"),
        F.length(strip(F.concat(F.lit("\t "), "text"))).alias("n"))


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 by 8 gray tiles from vectors of 64."""
    gray = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x + 1.0) * 128).cast("int"))))
    data = F.unhex(F.array_join(F.transform(gray, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile_id"), F.lit(8).alias("width"), F.lit(8).alias("height"), data.alias("pixels"))


def _kernel(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pixels.kernel(_tiles(spark, sf_dir), f).select("tile_id", F.hex("pixels").alias("pixels"))

    return run


@query
def tile_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of each tile, partly or wholly outside of some."""
    at = F.col("tile_id") % 11
    return pixels.crop(_tiles(spark, sf_dir), at - 2, at % 3, at + 3, at % 3 + 4).select("tile_id", "width", "height", F.hex("pixels").alias("pixels"))


QUERIES |= {"tile_autocontrast": _kernel(pixels.tiled_autocontrast), "tile_contrast_sharpen": _kernel(pixels.before_reading),
    "tile_unsharp": _kernel(pixels.before_layout)}

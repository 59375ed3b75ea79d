"""Boundaries that the derived relations never reach, on rows made by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumgrid.functions.geometry import bbox
from vellumgrid.functions.text import noise_reason, strip
from vellumgrid.operators import budget, columns, order, pixels, recognise, regions, review, textlayer
from vellumgrid.plans.variants import A, C, D, S
from vellumgrid.sources.tables import files, required

BOX = "x0 double, y0 double, x1 double, y1 double"
ROWS = [
    ("", 0.9, 20, 100, 1), (None, 0.9, 20, 100, 1), ("ab", 0.9, 7, 100, 2), ("ab", 0.9, 20, 14, 2), ("ab", 0.9, 8, 15, 0), ("ab", 0.9, 160, 15, 3),
        ("ab", 0.9, 8, 801, 3), ("ab", 0.9, 8, 800, 0),
    ("x", 0.49, 20, 100, 4), ("x", 0.5, 20, 100, 0), (" x ", 0.1, 20, 100, 4), ("ab", 0.24, 20, 100, 5), ("ab", 0.25, 20, 100, 0),
        ("aaa", 0.99, 20, 100, 6), ("aa", 0.99, 20, 100, 0),
    ("oOl|", 0.49, 20, 100, 7), ("12.5", 0.49, 20, 100, 7), ("—§", 0.49, 20, 100, 7), ("— §", 0.49, 20, 100, 0), ("12.5", 0.5, 20, 100, 8),
        ("bcdf", 0.69, 20, 100, 8), ("bcdf", 0.7, 20, 100, 0), ("bcd", 0.6, 20, 100, 0), ("é", 0.4, 20, 100, 4), ("bédf", 0.6, 20, 100, 8),
        ("  ", 0.2, 20, 100, 5), ("  ", 0.9, 20, 100, 0), ("ab", None, 20, 100, 5),
]


def test_noise_rules(spark):
    df = spark.createDataFrame(ROWS, "t string, c double, h int, w int, want int")
    got = df.select("t", "c", "h", "w", "want", noise_reason(F.col("t"), F.col("c"), F.col("h"), F.col("w"), D).alias("got")).where("want <> got").collect()
    assert got == []


def test_strip_is_unicode(spark):
    df = spark.createDataFrame([("\t a  \n",), ("　 ",), (None,)], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a", "", None]


def test_suppression_is_greedy(spark):
    rows = [(1, 0, 0.0, 0.0, 100.0, 10.0), (1, 1, 30.0, 0.0, 129.0, 10.0), (1, 2, 60.0, 0.0, 158.0, 10.0), (2, 0, 0.0, 0.0, 10.0, 10.0), (2, 1, 0.0, 0.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, f"page_id int, region_id int, {BOX}")
    got = {(r.page_id, r.region_id) for r in regions.suppressed(df, 0.45).collect()}
    assert got == {(1, 0), (1, 2), (2, 0)}
    assert regions.suppressed(df.limit(0), 0.45).count() == 0


def test_overlap_must_exceed_the_bound(spark):
    held = spark.createDataFrame([(1, 0, 0.0, 0.0, 100.0, 50.0), (1, 1, 500.0, 0.0, 600.0, 50.0)], f"page_id int, region_id int, {BOX}")
    lines = spark.createDataFrame([(1, 0, 95.0, 0.0, 195.0, 9.0), (1, 1, 94.0, 5.0, 194.0, 9.0), (1, 2, 900.0, 0.0, 910.0, 9.0),
        (7, 0, 40.0, 0.0, 50.0, 9.0), (7, 1, 10.0, 14.0, 20.0, 29.0), (7, 2, 0.0, 15.0, 20.0, 29.0)], f"page_id int, line_no int, {BOX}")
    got = {(r.page_id, r.line_no): (r.region_id, r.bucket_no, r.order_no) for r in order.ordered(order.assigned(lines, held)).collect()}
    assert got == {(1, 1): (0, 0, 1), (1, 0): (None, 2, 2), (1, 2): (None, 2, 3), (7, 1): (None, None, 1), (7, 0): (None, None, 2), (7, 2): (None, None, 3)}


@pytest.mark.parametrize(("gutters", "want"), [([10.0, 29.0, 48.0], [19.5, 48.0]), ([10.0, 30.0], [10.0, 30.0]), ([], []), ([29.0, 10.0, 39.0], [29.25])])
def test_merging_is_running(spark, gutters, want):
    df = spark.createDataFrame([(gutters,)], "g array<double>")
    assert df.select(columns.merged(F.col("g"))).first()[0] == want


@pytest.mark.parametrize(("gutters", "want"), [([300.0, 1200.0], [1200.0]), ([1200.0, 2200.0], [1200.0]), ([360.0], [360.0]), ([100.0], []), ([], []),
    ([800.0, 900.0, 1000.0], [800.0])])
def test_narrow_columns_lose_a_gutter(spark, gutters, want):
    df = spark.createDataFrame([(gutters,)], "g array<double>")
    assert df.select(columns.wide_columns(F.col("g"))).first()[0] == want


def test_story_breaks(spark):
    tops = [(200, 300), (330, 400), (429, 500), (530, 540), (570, 600), (850, 860), (1109, 1120)]
    rows = [(1, i, 0.0, float(a), 100.0, float(b)) for i, (a, b) in enumerate(tops)] + [(1, 99, 0.0, 10.0, 2000.0, 30.0)]
    lines = spark.createDataFrame(rows, f"page_id int, line_no int, {BOX}")
    gutters = spark.createDataFrame([(1, [])], "page_id int, gutters array<double>")
    got = sorted((r.line_no, r.seg_no, r.note) for r in columns.stories(columns.in_columns(lines, gutters)).collect())
    assert got == [(0, 2, "Col 1a"), (1, 2, "Col 1a"), (2, 2, "Col 1a"), (3, 3, "Col 1b"), (4, 3, "Col 1b"), (5, 4, "Col 1c"), (6, 4, "Col 1c"), (99, 1, "HEADER")]


def test_lines_are_cut_at_gutters(spark):
    rows = [(1, 0, 100.0, 500.0, 900.0, 520.0), (1, 1, 700.0, 500.0, 1000.0, 520.0), (1, 2, 0.0, 80.0, 10.0, 100.0), (1, 3, 0.0, 81.0, 10.0, 100.0),
        (1, 4, 0.0, 200.0, 1560.0, 230.0), (1, 5, 0.0, 200.0, 1561.0, 230.0)]
    lines = spark.createDataFrame(rows, f"page_id int, line_no int, {BOX}")
    gutters = spark.createDataFrame([(1, [800.0])], "page_id int, gutters array<double>")
    got = {r.line_no: (r.is_header, r.col, r.x0, r.x1) for r in columns.in_columns(lines, gutters).collect()}
    assert got == {0: (False, 1, 100.0, 798.0), 1: (False, 2, 802.0, 1000.0), 2: (True, 0, 0.0, 10.0), 3: (False, 1, 0.0, 10.0),
        4: (False, 1, 0.0, 798.0), 5: (True, 0, 0.0, 1561.0)}


def test_pass_two_needs_as_many_lines(spark):
    rows = [(1, 0, "Text", 1, "a"), (1, 0, "Text", 2, "b"), (1, 1, "Caption", 1, "a"), (1, 1, "Caption", 2, "b"), (1, 2, "Caption", 1, "a"),
        (1, 2, "Caption", 1, "b"), (1, 2, "Caption", 2, "c"), (1, 3, "Text", 1, " "), (1, 3, "Text", 2, "b"), (1, 4, "Text", 1, " ")]
    df = spark.createDataFrame(rows, "page_id int, region_id int, label string, pass int, text string")
    assert {r.region_id: r.winner for r in recognise.winners(df).collect()} == {0: 1, 1: 2, 2: 1, 3: 2, 4: 0}


def test_polygons_and_alternatives(spark):
    df = spark.sql("SELECT cast(null AS struct<x0:double,y0:double,x1:double,y1:double>) b, array(named_struct('x', 5D, 'y', 1D), named_struct('x', 0D, 'y', 9D), named_struct('x', 3D, 'y', 4D)) p")
    assert df.select(bbox(F.col("b"), F.col("p"))).first()[0] is None
    four = df.select(bbox(F.col("b"), F.concat("p", F.slice("p", 1, 1))).alias("x")).first().x
    assert tuple(four) == (0.0, 1.0, 5.0, 9.0)
    top = spark.sql("SELECT array(named_struct('label', 'body', 'confidence', 0.9D), named_struct('label', 'Text', 'confidence', 0.1D), named_struct('label', 'X', 'confidence', 0.5D)) e")
    assert [tuple(x) for x in top.select(regions.alternatives(F.col("e"), D)).first()[0]] == [("X", 0.5), ("Text", 0.1)]
    assert [tuple(x) for x in top.select(regions.alternatives(F.col("e"), C)).first()[0]] == [("body", 0.9), ("X", 0.5), ("Text", 0.1)]


def test_lost_text_aborts_some_rule_sets(spark):
    rows = [("f", 100, 200, 1, 110, 0), ("f", 100, 200, 2, 112, 7), ("g", 100, 114, 1, 90, 5), ("h", 100, 200, 1, 116, 5), ("h", 100, 200, 3, 100, 5)]
    df = spark.createDataFrame(rows, "name string, orig_size long, plain_size long, option int, size long, chars long")
    assert {r.name: (r.option, r.final_bytes) for r in budget.chosen(df, S).collect()} == {"f": (0, 200), "g": (0, 114), "h": (3, 100)}
    assert {r.name: (r.option, r.final_bytes) for r in budget.chosen(df, D).collect()} == {"f": (2, 112), "g": (0, 114), "h": (0, 200)}


def test_redaction_waits_for_text_in_some_rule_sets(spark):
    pages = spark.createDataFrame([(1, "old"), (2, "old"), (3, " "), (4, None)], "page_id int, existing_text string")
    held = spark.createDataFrame([(1,)], "page_id int")
    got = textlayer.redactions(pages, held, a=A, d=D)
    assert {r[0] for r in got.where("a").collect()} == {1, 2}
    assert {r[0] for r in got.where("d").collect()} == {1}


def test_review_uses_words_only_without_spans(spark):
    span = "struct<text:string,chars:array<string>,x0:double,y0:double,x1:double,y1:double,size:double,descent:double>"
    df = spark.createDataFrame([(1, 1, 100.0, [], [(10.0, 5.0, 20.0, 40.0, "w")]), (2, 2, 100.0, [], [])],
        f"page_id int, page_num int, pix_h double, blocks array<struct<lines:array<struct<spans:array<{span}>>>>>, words array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>")
    assert [tuple(r) for r in review.spans(df).collect()] == [(1, 0, "w", 0.0, 60.0, 35.0)]


def test_sharpening_and_contrast_by_brute_force():
    g = np.random.default_rng(3).integers(40, 200, (9, 11)).astype(np.uint8)
    got = pixels.sharpen(g)
    for y in range(1, 8):
        for x in range(1, 10):
            around = sum(int(g[y + a, x + b]) for a in (-1, 0, 1) for b in (-1, 0, 1)) - int(g[y, x])
            assert got[y, x] == min(255, max(0, (32 * int(g[y, x]) - 2 * around + 8) // 16))
    assert (got[0] == g[0]).all() and (got[:, 0] == g[:, 0]).all()
    flat = pixels.autocontrast(g, 0)
    assert flat.min() == 0 and flat.max() == 255
    assert (pixels.autocontrast(np.full((4, 4), 7, np.uint8), 1) == 7).all()
    assert abs(pixels.blurred(np.full((5, 5), 9.0)) - 9).max() < 1e-9
    big = np.tile(g, (40, 40))
    assert pixels.tiled_autocontrast(big).shape == big.shape


def test_adapter_loads_once_and_files_are_listed(spark, tmp_path):
    import pyarrow as pa

    def load():
        return lambda batch: pa.RecordBatch.from_arrays([batch.column("id"), pa.array(["r"] * batch.num_rows)], names=["id", "text"])

    assert recognise.adapted(spark.range(5), load, "id long, text string").where("text = 'r'").count() == 5
    (tmp_path / "b.pdf").write_bytes(b"12")
    (tmp_path / "a.x.pdf").write_bytes(b"1")
    (tmp_path / "c.txt").write_bytes(b"1")
    found = files(spark, str(tmp_path)).orderBy("path").select("name", "stem", "length").collect()
    assert [tuple(r) for r in found] == [("a.x.pdf", "a.x", 1), ("b.pdf", "b", 2)]
    with pytest.raises(FileNotFoundError):
        required(files(spark, str(tmp_path)).where("length > 9"), "PDF files")


def test_inbox_takes_each_file_once(spark, tmp_path):
    from vellumgrid.streaming.inbox import watch

    (tmp_path / "in").mkdir()
    seen = []
    for name in ("a.pdf", "b.pdf"):
        (tmp_path / "in" / name).write_bytes(b"x")
        watch(spark, str(tmp_path / "in"), str(tmp_path / "at"), lambda df, n: seen.extend(r.path[-5:] for r in df.collect()), once=True).awaitTermination()
    assert seen == ["a.pdf", "b.pdf"]


def test_the_cascade_goes_on_only_after_failures(spark):
    span, piece = "array<struct<text:string,x0:double,y1:double,size:double,descent:double>>", "array<struct<n:int,x0:double,y0:double,x1:double,y1:double,text:string>>"
    a, b = [("raw", 20.0, 30.0, 9.0, -2.0)], [("dict", 20.0, 30.0, 9.0, -2.0)]
    c, d = [(5, 20.0, 0.0, 60.0, 40.0, " plain "), (4, 0.0, 0.0, 1.0, 1.0, "short")], [(5, 20.0, 0.0, 60.0, 7.0, "word"), (None, 0.0, 0.0, 1.0, 1.0, "odd")]
    rows = [(1, a, b, c, d), (2, None, b, c, d), (3, None, None, c, d), (4, None, None, None, d), (5, [], b, c, d),
        (6, [(" ", 0.0, 0.0, 1.0, 0.0)], None, None, d), (7, None, None, None, None), (8, [], None, None, [])]
    pages = spark.createDataFrame([(n, 1, 100.0, *x) for n, *x in rows] + [(9, 2, 100.0, a, b, c, d)],
        f"page_id int, page_num int, pix_h double, raw {span}, dicts {span}, plain {piece}, words {piece}")
    got = {r.page_id: (r.text, r.x, r.y, r.size) for r in review.cascade(pages).collect()}
    assert got == {1: ("raw", 10.0, 68.0, 9.0), 2: ("dict", 10.0, 68.0, 9.0), 3: ("plain", 10.0, 60.0, 40.0), 4: ("word", 10.0, 93.0, 12.0),
        5: ("word", 10.0, 93.0, 12.0), 6: ("word", 10.0, 93.0, 12.0)}


def test_wide_widths_are_the_first_ten(spark):
    lines = spark.createDataFrame([(1, i, 0.0, 0.0, 672.0 + i / 2, 9.0) for i in range(14, -1, -1)] + [(2, 0, 5.0, 0.0, 5.0, 9.0)], f"page_id int, line_no int, {BOX}")
    got = [(r.page_id, r.k, r.width) for r in columns.wide_widths(lines, 2400.0).orderBy("k").collect()]
    assert got == [(1, k, w) for k, w in enumerate([672, 673, 674, 674, 674, 675, 676, 676, 676, 677], 1)]


def test_segments_without_accepted_lines_go(spark):
    told = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 3), (2, 0, 1)], "page_id int, line_no int, seg_no int")
    accepted = spark.createDataFrame([(1, 0), (1, 2), (1, 3), (3, 0)], "page_id int, line_no int")
    assert {tuple(r) for r in columns.with_text(told, accepted).collect()} == {(1, 1, 1, 1), (1, 3, 2, 2)}


def test_turns_growth_and_insertions(spark):
    held = spark.createDataFrame([(1, 0, None, "ocr"), (1, 1, 2, "ocr"), (1, 2, 1, "skip"), (1, 3, 2, "ocr")], "page_id int, region_id int, position int, route string")
    assert {(r.region_id, r.turn) for r in regions.in_turn(held).collect()} == {(1, 1), (3, 2), (0, 3)}
    files = spark.createDataFrame([("a", 0, 5000), ("b", 200, 150), ("c", None, 1)], "name string, orig_size long, final_bytes long")
    assert {(r.name, r.kb, r.growth) for r in budget.grown(files).collect()} == {("a", 4, None), ("b", 0, -25.0), ("c", 0, None)}
    layer = spark.createDataFrame([(1, True), (1, False), (1, None), (2, False)], "page_id int, ok boolean")
    assert {tuple(r) for r in textlayer.inserted(layer).collect()} == {(1, 3, 1), (2, 1, 0)}


def test_metadata_is_well_formed(spark):
    from xml.etree import ElementTree

    df = spark.createDataFrame([('a <b> & "c".pdf',)], "name string").withColumn("at", F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))
    row = textlayer.metadata(df, "É", "s", "c", "p").first()
    body = row.xmp.split("?>", 1)[1].rsplit("<?", 1)[0]
    about = ElementTree.fromstring(body)[0][0]
    assert about.attrib["{http://www.aiim.org/pdfa/ns/id/}part"] == "1" and about.attrib["{http://ns.adobe.com/xap/1.0/}CreateDate"] == "2024-05-06T07:08:09"
    assert [x.text for x in about.iter("{http://www.w3.org/1999/02/22-rdf-syntax-ns#}li")] == ['a <b> & "c".pdf', "É", "s"]
    assert row.created == "D:20240506070809"


def test_crops_end_at_the_edges(spark):
    tile = spark.createDataFrame([(1, 3, 2, bytearray(range(6))), (2, 3, 2, None)], "tile_id int, width int, height int, pixels binary")
    at = lambda *x: {r.tile_id: (r.width, r.height, None if r.pixels is None else list(r.pixels)) for r in pixels.crop(tile, *map(F.lit, x)).collect()}
    assert at(1, 0, 9, 9)[1] == (2, 2, [1, 2, 4, 5]) and at(-5, 1, 1, 2)[1] == (1, 1, [3]) and at(2, 0, 1, 2)[1] == (0, 2, [])
    assert at(0, 0, 3, 2)[2] == (3, 2, None)

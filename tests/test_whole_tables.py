"""Layout queries over whole tables, counted row by row."""

from collections import Counter

from vellumgrid.operators import review
from vellumgrid.queries import QUERIES
from vellumgrid.sources.tables import noise_lines, regions

from .conftest import SMALL


def test_two_passes_read_every_line(spark):
    known = {(r.page_id, r.region_id) for r in regions(spark, SMALL).collect()}
    want = {1: Counter(), 2: Counter()}
    late = 0
    for r in noise_lines(spark, SMALL).collect():
        at = r.page_id, r.line_no % 4
        if at in known and r.text.strip():
            want[2 if r.line_no % 3 == 0 else 1][at] += 1
            late += r.line_no >= 12
    got = QUERIES["two_pass_winner"](spark, SMALL).collect()
    assert late and {(r.page_id, r.region_id) for r in got} >= set(want[1]) | set(want[2])
    assert all((r.n1, r.n2) == (want[1][r.page_id, r.region_id], want[2][r.page_id, r.region_id]) for r in got)


def test_the_canvas_is_around_all_spans(spark):
    spans = {}
    for r in QUERIES["review_spans"](spark, SMALL).collect():
        spans.setdefault(r.page_id, []).append(r)
    assert any(p % 13 == 0 for p in spans)
    for r in QUERIES["review_canvas"](spark, SMALL).collect():
        own = spans.get(r.page_id)
        w = own and max(int(max(s.x + 6 * len(s.text) for s in own) - min(s.x for s in own) + 80), 500) + 20
        h = own and max(int(max(s.y + s.size for s in own) - min(s.y for s in own) + 80), 400) + 20
        assert (r.ocr_w, r.ocr_h) == (w or 500, h or 400)


def test_a_page_without_text_has_a_canvas_of_its_own_size(spark):
    pages = spark.createDataFrame([(1, 500, 400), (2, 500, 400)], "page_id long, pix_w int, pix_h int")
    placed = spark.createDataFrame([(1, 0.0, 0.0, 600.0, 10.0)], "page_id long, x double, y double, w double, h double")
    got = {r.page_id: (r.ocr_w, r.ocr_h, r.all_w, r.all_h) for r in review.canvas(pages, placed).collect()}
    assert got == {1: (700, 420, 1200, 420), 2: (500, 400, 1000, 400)}

"""Contracts of what is outside, with stand-ins that always give the same."""

import json
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellumgrid.functions.text import noise_reason
from vellumgrid.operators import adapters
from vellumgrid.operators.recognise import failed_reads
from vellumgrid.plans.variants import D


def fake_open():
    """A document is a list of pages in JSON."""

    def run(batch):
        rows = []
        for path, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
            for i, page in enumerate(json.loads(content)):
                rows.append({"path": path, "page_num": i + 1, "page_w": float(page["w"]), "page_h": float(page["h"]), "existing_text": page.get("text", "")})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("page_num", pa.int32()), ("page_w", pa.float64()),
            ("page_h", pa.float64()), ("existing_text", pa.string())]))

    return run


def fake_render():
    def run(batch):
        rows = [{"width": int(d * 8 / 72), "height": int(d * 6 / 72), "pixels": bytes([n % 256]) * 4} for n,
            d in zip(*(batch.column(c).to_pylist() for c in ("page_num", "dpi")))]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary())]))

    return run


def fake_layout():
    def run(batch):
        box = lambda w, h: {"x0": 0.0, "y0": 0.0, "x1": float(w), "y1": h / 2, "label": "Text", "position": 0, "top_k": [("Title", 0.25)]}
        rows = [{"regions": [box(w, h)], "image_bbox": [0.0, 0.0, float(w), float(h)]} for w, h in zip(*(batch.column(c).to_pylist() for c in ("width", "height")))]
        real = pa.struct([("x0", pa.float64()), ("y0", pa.float64()), ("x1", pa.float64()), ("y1", pa.float64()), ("label", pa.string()),
            ("position", pa.int32()), ("top_k", pa.map_(pa.string(), pa.float64()))])
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("regions", pa.list_(real)), ("image_bbox", pa.list_(pa.float64()))]))

    return run


def fake_detect():
    def run(batch):
        rows = [{"lines": [{"x0": 0.0, "y0": 10.0 * k, "x1": float(w), "y1": 10.0 * k + 8, "confidence": 1.0} for k in range(h // 200)]} for w,
            h in zip(*(batch.column(c).to_pylist() for c in ("width", "height")))]
        real = pa.struct([(c, pa.float64()) for c in ("x0", "y0", "x1", "y1", "confidence")])
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("lines", pa.list_(real))]))

    return run


def fake_recognise():
    def run(batch):
        if any(x == b"bad" for x in batch.column("pixels").to_pylist()):
            raise RuntimeError("unreadable")
        rows = [{"text": f"line {zlib.crc32(x or b'') % 100}", "confidence": 0.9} for x in batch.column("pixels").to_pylist()]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("text", pa.string()), ("confidence", pa.float64())]))

    return run


def fake_read():
    new = lambda pixels, detector=None: len(pixels)
    old = lambda pixels: len(pixels)
    call = adapters.either_pass(lambda *a, **k: old(*a, **k), lambda *a: new(*a))

    def run(batch):
        line = lambda k, p: {"x0": None, "y0": None, "x1": None, "y1": None, "text": f"pass {p} line {k}", "confidence": 0.5}
        rows = [{"reads": [line(k, p) for k in range(call(x, detector="d"))]} for x, p in zip(*(batch.column(c).to_pylist() for c in ("pixels", "pass")))]
        real = pa.struct([*[(c, pa.float64()) for c in ("x0", "y0", "x1", "y1")], ("text", pa.string()), ("confidence", pa.float64())])
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("reads", pa.list_(real))]))

    return run


def fake_save():
    def run(batch):
        rows = [{"content": c + (x or "").encode(), "bytes": len(c) + len((x or "").encode()), "chars": len(x or "")} for c,
            x in zip(*(batch.column(k).to_pylist() for k in ("content", "layer")))]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("content", pa.binary()), ("bytes", pa.int64()), ("chars", pa.int64())]))

    return run


def fake_intent():
    def run(batch):
        return pa.RecordBatch.from_arrays([pa.array([c + b"|" + p for c, p in zip(*(batch.column(k).to_pylist() for k in ("content", "profile")))],
            pa.binary())], names=["content"])

    return run


PAGES = json.dumps([{"w": 576, "h": 432}, {"w": 100, "h": 50, "text": "old"}]).encode()


def test_files_become_pages_and_a_broken_one_an_error(spark):
    files = spark.createDataFrame([("a.pdf", bytearray(PAGES)), ("b.pdf", bytearray(b"not json")), ("c.pdf", bytearray(b"[]")),
        (None, bytearray(PAGES))], "path string, content binary").coalesce(1)
    done = adapters.through(files, adapters.OPEN, fake_open)
    assert sorted((r.path or "", r.page_num, r.page_w, r.existing_text) for r in adapters.succeeded(done).collect()) == [("", 1, 576.0, ""),
        ("", 2, 100.0, "old"), ("a.pdf", 1, 576.0, ""), ("a.pdf", 2, 100.0, "old")]
    failed = adapters.failures(done, "file", "path").collect()
    assert [(r.level, r.key) for r in failed] == [("file", "b.pdf")] and failed[0].error.startswith("JSONDecodeError")
    assert adapters.through(files.limit(0), adapters.OPEN, fake_open).count() == 0


def test_pages_through_every_model(spark):
    pages = spark.createDataFrame([("a.pdf", 1, bytearray(PAGES), 300), ("a.pdf", 2, bytearray(PAGES), 200)], "path string, page_num int, content binary, dpi int")
    raster = adapters.succeeded(adapters.through(pages, adapters.RENDER, fake_render)).withColumn("page_id", F.concat_ws("/", "path", F.col("page_num").cast("string")))
    assert {(r.page_num, r.width, r.height, bytes(r.pixels)) for r in raster.collect()} == {(1, 33, 25, b"\1" * 4), (2, 22, 16, b"\2" * 4)}
    large = raster.withColumn("height", F.lit(600))
    found = adapters.succeeded(adapters.through(large, adapters.LAYOUT, fake_layout)).collect()
    assert {(r.page_id, r.regions[0].label, r.regions[0].top_k["Title"], tuple(r.image_bbox)) for r in found} == {("a.pdf/1", "Text", 0.25,
        (0.0, 0.0, 33.0, 600.0)), ("a.pdf/2", "Text", 0.25, (0.0, 0.0, 22.0, 600.0))}
    lines = adapters.succeeded(adapters.through(large, adapters.DETECT, fake_detect)).select("page_id", F.posexplode("lines").alias("line_no", "line"))
    assert lines.count() == 6 and lines.where("line.confidence = 1.0").count() == 6
    reads = raster.withColumns({"region_id": F.lit(0), "pass": F.lit(2)})
    got = adapters.succeeded(adapters.through(reads, adapters.READ, fake_read)).select("page_id", F.explode("reads").alias("r")).select("page_id",
        "r.text", "r.x0").collect()
    assert len(got) == 8 and all(r.x0 is None and r.text.startswith("pass 2") for r in got)


def test_a_line_that_fails_is_an_empty_text(spark):
    lines = spark.createDataFrame([(1, 0, bytearray(b"ok")), (1, 1, bytearray(b"bad")), (1, 2, None), (1, 3, bytearray(b"bad"))],
        "page_id long, line_no int, pixels binary").coalesce(1)
    done = adapters.through(lines, adapters.RECOGNISE, fake_recognise)
    assert {r.key for r in adapters.failures(done, "line", "page_id", "line_no").collect()} == {"1/1", "1/3"}
    judged = done.withColumns(failed_reads()).withColumn("reason", noise_reason(F.col("text"), F.col("confidence"), F.lit(20), F.lit(100), D))
    assert {(r.line_no, r.confidence, r.reason) for r in judged.collect()} == {(0, 0.9, 0), (1, 0.0, 1), (2, 0.9, 0), (3, 0.0, 1)}


def test_files_are_written_and_marked(spark):
    files = spark.createDataFrame([("a", bytearray(b"%PDF"), "text", bytearray(b"icc")), ("b", bytearray(b"%PDF"), None, None)],
        "name string, content binary, layer string, profile binary").coalesce(1)
    saved = adapters.succeeded(adapters.through(files, adapters.SAVE, fake_save))
    assert {(r.name, bytes(r.content), r.bytes, r.chars) for r in saved.collect()} == {("a", b"%PDFtext", 8, 4), ("b", b"%PDF", 4, 0)}
    done = adapters.through(saved.join(files.select("name", "profile"), "name"), adapters.INTENT, fake_intent)
    assert {(r.name, r.content and bytes(r.content), r.error is None) for r in done.collect()} == {("a", b"%PDFtext|icc", True), ("b", None, False)}


def test_contracts_are_checked(spark):
    with pytest.raises(ValueError, match="needs the columns"):
        adapters.through(spark.range(1), adapters.SAVE, fake_save)
    short = lambda: lambda batch: batch.slice(1)
    rows = spark.createDataFrame([(1, 0, None), (1, 1, None)], "page_id long, line_no int, pixels binary")
    assert adapters.through(rows, adapters.RECOGNISE, short).where("error is null").count() == 0

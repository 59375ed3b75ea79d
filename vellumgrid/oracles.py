"""SQL that states what the registered queries return, for another engine to run.

Each statement is written from the rules, with windows, islands and recursion where the
queries use arrays and folds.
"""

from __future__ import annotations

from .functions.text import PATTERNS, REASONS, packet
from .operators.pixels import POINT, box_weights
from .plans.variants import ALIASES_BC, ALIASES_D, DEFAULT_COLOUR, LABEL_COLOURS, OCR_LABELS, SEGMENT_COLOURS, SINGLE_BLOCK_LABELS, SKIP_LABELS, A, C, D, S, Variant
from .sources.tables import LINES_SQL, NOISE_LINES_SQL, REGIONS_SQL

_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_set = lambda values: "(" + ", ".join(map(_quoted, values)) + ")"
_case = lambda column, values, otherwise: f"CASE {column} " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in values.items()) + f" ELSE {otherwise} END"
L, N, R = f"l AS ({LINES_SQL})", f"n AS ({NOISE_LINES_SQL})", f"r AS ({REGIONS_SQL})"
BLANKS = r"'^[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$'"
_strip = lambda x: f"regexp_replace({x}, {BLANKS}, '', 'g')"
D_REGIONS = f"{R}, d AS (SELECT * REPLACE ({_case('label', ALIASES_D, 'label')} AS label) FROM r)"


def _reasons(v: Variant, lines: str = N) -> str:
    return f"""{lines}, c AS (SELECT *, y1 - y0 AS h, x1 - x0 AS w, {_strip("text")} AS t FROM n),
j AS (SELECT page_id, line_no, text, x0, y0, x1, y1, CASE WHEN text IS NULL OR text = '' THEN 1 WHEN h < {v.noise_height} OR w < {v.noise_width} THEN 2 WHEN w / h < 0.1 OR w / h > 100 THEN 3
  WHEN length(t) = 1 AND confidence < {v.single_char} THEN 4 WHEN length(t) = 1 THEN 0 WHEN confidence < {v.confidence} THEN 5
  WHEN length(t) > 2 AND len(list_distinct(string_split(t, ''))) = 1 THEN 6
  WHEN confidence < {v.single_char} AND ({" OR ".join(f"regexp_matches(t, {_quoted(p)})" for p in PATTERNS)}) THEN 7
  WHEN length(t) > 3 AND NOT regexp_matches(t, '[aeiouAEIOU]') AND confidence < 0.7 THEN 8 ELSE 0 END AS reason FROM c)"""


ROUTE = f"CASE WHEN label IN {_set(OCR_LABELS)} THEN 'ocr' WHEN label IN {_set(SKIP_LABELS)} THEN 'skip' ELSE 'unknown' END"
HIST = f"""{L}, f AS (SELECT page_id, CAST(trunc((x0 + x1) / 2 / 4) AS INT) AS bucket, x1 - x0 <= 672 AS few, bool_or(x1 - x0 <= 672) OVER (PARTITION BY page_id) AS any_few
  FROM l),
h AS (SELECT page_id, bucket, count(*) AS cnt FROM f WHERE (few OR NOT any_few) AND bucket BETWEEN 0 AND 601 GROUP BY ALL)"""
GAPS = f"""{HIST}, dense AS (SELECT p.page_id, b.bucket, coalesce(h.cnt, 0) AS cnt FROM (SELECT DISTINCT page_id FROM h) p CROSS
  JOIN (SELECT unnest(range(0, 602)) AS bucket) b LEFT JOIN h ON h.page_id = p.page_id AND h.bucket = b.bucket),
runs AS (SELECT page_id, min(bucket) AS a, max(bucket) AS z FROM (SELECT *, bucket - row_number() OVER (PARTITION BY page_id ORDER BY bucket) AS island
  FROM dense WHERE cnt <= 1) GROUP BY page_id, island),
gaps AS (SELECT page_id, (a + z) / 2.0 * 4 AS gap FROM runs WHERE (z - a + 1) * 4 >= 20)"""
_narrowest = lambda g: f"list_position(list_transform(range(1, len({g}) + 2), lambda i: ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i + 1] - ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i]), list_min(list_transform(range(1, len({g}) + 2), lambda i: ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i + 1] - ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i])))"
_least = lambda g: f"list_min(list_transform(range(1, len({g}) + 2), lambda i: ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i + 1] - ([0.0::DOUBLE] || {g} || [2400.0::DOUBLE])[i]))"
WIDEN = f"""w AS (SELECT page_id, g, 0 AS turn FROM start UNION ALL SELECT page_id, list_filter(g, lambda x, i: i <> least({_narrowest("g")}, len(g))), turn + 1
  FROM w WHERE len(g) > 0 AND {_least("g")} < 360),
final AS (SELECT page_id, arg_max(g, turn) AS g FROM w GROUP BY page_id)"""
#: (gaps are further apart than the distance that merges them, so merging leaves them as they are)
FINAL = f"""{GAPS}, start AS (SELECT p.page_id, coalesce(list_sort(list(gap) FILTER (gap > 192 AND gap < 2208)), []) AS g FROM (SELECT DISTINCT page_id FROM h) p
  LEFT JOIN gaps USING (page_id) GROUP BY p.page_id), {WIDEN}"""
PLACED = f"""{FINAL}, k AS (SELECT l.*, g, (y0 + y1) / 2 <= 90 OR ((x1 - x0) / 2400 > 0.65 AND (y0 + y1) / 2 <= 216) AS is_header, len(list_filter(g, lambda x: x < l.x0 + (l.x1 - l.x0) / 2)) AS k
  FROM l JOIN final USING (page_id)),
s AS (SELECT page_id, line_no, text, y0, y1, is_header, CASE WHEN is_header THEN 0 ELSE k + 1 END AS col, CASE WHEN NOT is_header AND k > 0 AND x0 < g[k] THEN g[k] + 2 ELSE x0 END AS x0, CASE WHEN NOT is_header AND k < len(g) AND x1 > g[k + 1] THEN g[k + 1] - 2 ELSE x1 END AS x1
  FROM k),
placed AS (SELECT * FROM s WHERE is_header OR x1 > x0)"""
TOLD = f"""{PLACED}, num AS (SELECT *, row_number() OVER (PARTITION BY page_id, col ORDER BY y0, line_no) AS rn FROM placed),
walk AS (SELECT page_id, col, rn, 0 AS sub, y0 AS top, y1 AS bottom FROM num WHERE rn = 1
 UNION ALL SELECT n.page_id, n.col, n.rn, CASE WHEN n.col > 0 AND (n.y0 - bottom >= 250 OR (n.y0 - bottom >= 30 AND bottom - top > 200)) THEN sub + 1 ELSE sub END,
  CASE WHEN n.col > 0 AND (n.y0 - bottom >= 250 OR (n.y0 - bottom >= 30 AND bottom - top > 200)) THEN n.y0 ELSE top END, n.y1 FROM walk
  JOIN num n ON n.page_id = walk.page_id AND n.col = walk.col AND n.rn = walk.rn + 1),
told AS (SELECT page_id, line_no, x0, y0, x1, y1, text, dense_rank() OVER (PARTITION BY page_id ORDER BY col, sub) AS seg_no, row_number() OVER (PARTITION BY page_id, col, sub ORDER BY rn) AS line_in_seg,
  CASE WHEN col = 0 THEN 'HEADER' ELSE 'Col ' || col || CASE WHEN max(sub) OVER (PARTITION BY page_id, col) > 0 THEN chr(97 + sub) ELSE '' END END AS note
  FROM walk JOIN num USING (page_id, col, rn))"""
IOU = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
ATTEMPTS = """t AS (SELECT o_orderkey AS name, 1000 + o_orderkey * 7919 % 100000 AS orig, unnest(range(1, 4)) AS option FROM orders),
u AS (SELECT name, orig, CAST(trunc(orig * 1.15::DOUBLE) AS BIGINT) AS budget, CAST(trunc(orig + orig * (name * 31 % 40) / 100) AS BIGINT) AS plain, option, CAST(trunc(orig + orig * (name * option * 17 % 35) / 100) AS BIGINT) AS size, name * 13 % 3 * (option + name) % 5 AS chars
  FROM t)"""


def _budget(v: Variant) -> str:
    stop = "size <= budget" if v.abort_on_lost_text else "size <= budget AND chars > 0"
    return f"""SELECT name, any_value(budget) AS budget, CASE WHEN any_value(plain) > any_value(budget) AND coalesce(arg_min(chars, option) FILTER ({stop} AND option <= {v.options}), 0) > 0 THEN min(option) FILTER ({stop} AND option <= {v.options}) ELSE 0 END AS option,
CASE WHEN any_value(plain) > any_value(budget) AND coalesce(arg_min(chars, option) FILTER ({stop} AND option <= {v.options}), 0) > 0 THEN arg_min(size, option) FILTER ({stop} AND option <= {v.options}) ELSE any_value(plain) END AS final_bytes, '{v.name}' AS variant
  FROM u GROUP BY name"""


_read = "SELECT page_id, region_id, line_no, CASE WHEN line_no % 3 = 0 THEN 2 ELSE 1 END AS pass, text FROM (SELECT *, line_no % 4 AS region_id FROM n)"
_old = "CASE WHEN doc_id % 3 = 0 THEN text ELSE '' END"
SPANS = f"""p AS (SELECT doc_id AS page_id, doc_id % 3 AS kind, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
q AS (SELECT page_id, i, {_strip("x")} AS text, CAST(20 AS DOUBLE) AS x, CAST(CASE WHEN kind < 2 THEN 1800 - (80.5 + 30 * i) - 2 ELSE 1800 - (80.5 + 30 * i) END AS DOUBLE) AS y, CAST(CASE WHEN kind < 2 THEN 9 ELSE 20 END AS DOUBLE) AS size
  FROM p),
spans AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS span_no, text, x, y, size FROM q WHERE length(text) > 0)"""
_plain = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _xmp() -> str:
    """A metadata packet as a sum of strings and columns."""
    at = ("strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')",)
    given = {"title": ("'scan ' || o_orderkey || '.v1.pdf'",), "author": "", "subject": _plain('Recognised "text" & <more>'), "creator": "vellumgrid", "producer": "vellumgrid", "created": at, "modified": at}
    return packet(given, lambda parts: " || ".join(x[0] if isinstance(x, tuple) else _quoted(x) for x in parts))


#: Gray tiles of 8 by 8 as lists of 64 numbers, row by row.
TILES = "g AS (SELECT vec_id AS tile_id, list_transform(embedding, lambda x: CAST(greatest(0, least(255, floor((CAST(x AS DOUBLE) + 1) * 128))) AS BIGINT)) AS p FROM embeddings)"
_hexed = lambda of: f"SELECT tile_id, array_to_string(list_transform(p, lambda v: printf('%02X', v)), '') AS pixels FROM {of}"


def _stretched(cut: int) -> str:
    """Tiles stretched to 0..255 after ``cut`` pixels are off each end: all, or without the cut ones if nothing is left between."""
    return f"""b AS (SELECT tile_id, p, list_sort(p)[{1 + cut}] AS lo, list_sort(p)[{64 - cut}] AS hi FROM g),
c AS (SELECT tile_id, CASE WHEN hi <= lo THEN p ELSE list_transform(p, lambda v: CAST(greatest(0, least(255, trunc(v * (255.0::DOUBLE / (hi - lo)) - lo * (255.0::DOUBLE / (hi - lo))))) AS BIGINT)) END AS p
  FROM b)"""


def _blurred() -> str:
    """Six box averages of c, three along rows and three along columns; the last is s6."""
    reach, inner, edge = box_weights(1.5)
    steps, of = [], "c"
    for k in range(1, 7):
        at = lambda by, k=k: f"p[{'(i // 8) * 8 + greatest(0, least(7, i % 8 + ({0})))' if k <= 3 else 'greatest(0, least(7, i // 8 + ({0}))) * 8 + i % 8'} + 1]".format(by)
        near = " + ".join(at(by) for by in range(-reach, reach + 1))
        steps.append(f"s{k} AS (SELECT tile_id, list_transform(range(0, 64), lambda i: (({near}) * {inner} + ({at(-reach - 1)} + {at(reach + 1)}) * {edge} + {1 << (POINT - 1)}) // {1 << POINT}) AS p FROM {of})")
        of = f"s{k}"
    return ",\n".join(steps)


_near = " + ".join(f"p[i + {dy * 8 + dx} + 1]" for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx)

ORACLE_SQL: dict[str, str] = {
    "tile_autocontrast": f"WITH {TILES}, {_stretched(0)} {_hexed('c')}",
    "tile_contrast_sharpen": f"""WITH {TILES}, {_stretched(1)}, d AS (SELECT tile_id, list_transform(range(0, 64), lambda i: CASE WHEN i // 8 IN (0, 7) OR i % 8 IN (0, 7) THEN p[i + 1] ELSE greatest(0, least(255, CAST(floor((32 * p[i + 1] - 2 * ({_near}) + 8) / 16.0::DOUBLE) AS BIGINT))) END) AS p
  FROM c) {_hexed("d")}""",
    "tile_unsharp": f"""WITH {TILES}, {_stretched(0)}, {_blurred()},
  d AS (SELECT tile_id, list_transform(range(1, 65), lambda i: CAST(trunc(greatest(0::FLOAT, least(255::FLOAT, CAST(c.p[i] AS FLOAT) - 0.35::FLOAT * CAST(s6.p[i] - c.p[i] AS FLOAT)))) AS BIGINT)) AS p
  FROM c JOIN s6 USING (tile_id)) {_hexed("d")}""",
    "tile_crop": f"""WITH {TILES}, k AS (SELECT tile_id, p, least(8, greatest(0, tile_id % 11 - 2)) AS x0, tile_id % 11 % 3 AS y0, least(8, tile_id % 11 + 3) AS x1, tile_id % 11 % 3 + 4 AS y1
  FROM g)
SELECT tile_id, CAST(greatest(0, x1 - x0) AS INT) AS width, CAST(y1 - y0 AS INT) AS height, coalesce(array_to_string(list_transform(list_filter(range(0, 64), lambda i: i // 8 >= y0 AND i // 8 < y1 AND i % 8 >= x0 AND i % 8 < x1), lambda i: printf('%02X', p[i + 1])), ''), '') AS pixels
  FROM k""",
    "artefact_report": "SELECT printf('  %-55s %6d KB', 'page_' || o_orderkey || '_lines.txt', CAST(trunc(o_totalprice * 100) AS BIGINT) // 1024) AS line FROM orders",
    "order_report": f"""WITH RECURSIVE {TOLD}, t AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seg_no, line_in_seg) AS k FROM told)
SELECT page_id, printf('%4d  seg %2d  line %3d  ', k, seg_no, line_in_seg) || rpad(text[1:40], 40, ' ') AS line FROM t""",
    "file_totals": f"""WITH {_reasons(S)} SELECT page_id % 50 AS doc, count(DISTINCT page_id) AS pages, count(*) FILTER (reason = 0) AS accepted, count(*) FILTER (reason > 0) AS filtered
  FROM j GROUP BY 1""",
    "read_errors": f"""WITH {_reasons(D, N + ", n2 AS (SELECT * REPLACE (CASE WHEN line_no % 10 = 3 THEN '' ELSE text END AS text, CASE WHEN line_no % 10 = 3 THEN 0 ELSE confidence END AS confidence) FROM n)").replace("AS t FROM n)", "AS t FROM n2)")}
SELECT page_id, count(*) FILTER (line_no % 10 = 3) AS failed, count(*) FILTER (reason = 1) AS empty, count(*) FILTER (reason = 0) AS accepted FROM j
  GROUP BY page_id""",
    "captions": f"WITH {L} SELECT page_id, line_no, text[1:40] AS first_40, text[1:55] AS first_55, text[1:60] AS first_60 FROM l",
    "reading_turns": f"""WITH {D_REGIONS} SELECT page_id, region_id, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN region_id = 1 THEN 999 ELSE region_id * 3 % 4 END, region_id) AS turn
  FROM d WHERE {ROUTE} = 'ocr'""",
    "wide_widths": f"""WITH {L}, w AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY line_no) AS k, CAST(round_even(x1 + line_no / 2.0::DOUBLE - x0, 0) AS INT) AS width
  FROM l WHERE x1 + line_no / 2.0::DOUBLE - x0 > 672) SELECT page_id, k, width FROM w WHERE k <= 10""",
    "segments_with_text": f"""WITH RECURSIVE {TOLD}, {_reasons(A)}, q AS (SELECT page_id, seg_no, count(*) AS n FROM told JOIN (SELECT page_id, line_no FROM j
  WHERE reason = 0) a USING (page_id, line_no) GROUP BY ALL)
SELECT page_id, seg_no, n, row_number() OVER (PARTITION BY page_id ORDER BY seg_no) AS text_seg_no FROM q""",
    "inserted_counts": f"WITH {_reasons(D)} SELECT page_id, count(*) AS elements, count(*) FILTER (line_no % 10 <> 9) AS inserted FROM j WHERE reason = 0 GROUP BY page_id",
    "size_growth": """WITH t AS (SELECT o_orderkey AS name, o_orderkey * 7919 % 1000 AS orig_size, CAST(trunc(o_totalprice * 10) AS BIGINT) AS final_bytes FROM orders)
SELECT name, orig_size, final_bytes, final_bytes // 1024 AS kb, round(CASE WHEN orig_size <> 0 THEN (final_bytes - orig_size) * 100.0::DOUBLE / orig_size END, 6) AS growth
  FROM t""",
    "artefact_list": "SELECT 'page_' || o_orderkey || '_lines.txt' AS name, CAST(trunc(o_totalprice * 100) AS BIGINT) // 1024 AS kb FROM orders",
    "review_cascade": f"""WITH p AS (SELECT doc_id AS page_id, doc_id % 5 AS kind, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE doc_id % 7 % 2 = 0),
q AS (SELECT page_id, i, {_strip("x")} AS text, CASE WHEN kind IN (0, 1) THEN 30 ELSE 20 END AS x, CASE WHEN kind IN (0, 1) THEN 1800 - (70 + 20 * i) - 3 ELSE 1800 - (70.5 + 31 * i) END AS y, CASE WHEN kind IN (0, 1) THEN 11 ELSE greatest(12, trunc(10.5 + i)) END AS size
  FROM p WHERE kind IN (0, 1) OR i % 3 = 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS span_no, text, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(size AS DOUBLE) AS size
  FROM q WHERE length(text) > 0""",
    "reading_order_s": f"""WITH {L}, {R}, j AS (SELECT l.page_id, l.line_no, r.region_id, r.x0 AS rx, greatest(0, least(l.x1, r.x1) - greatest(l.x0, r.x0)) / greatest(l.x1 - l.x0, 1) AS ov
  FROM l JOIN r USING (page_id)),
b AS (SELECT *, row_number() OVER (PARTITION BY page_id, line_no ORDER BY ov DESC, rx, region_id) AS k FROM j WHERE ov > 0.05),
rk AS (SELECT page_id, region_id, row_number() OVER (PARTITION BY page_id ORDER BY x0, region_id) - 1 AS bk FROM r), c AS (SELECT page_id, count(*) AS n FROM r
  GROUP BY page_id),
a AS (SELECT l.page_id, l.line_no, x0, y0, b.region_id, CASE WHEN n IS NOT NULL THEN coalesce(bk, n) END AS bucket_no FROM l
  LEFT JOIN b ON b.k = 1 AND b.page_id = l.page_id AND b.line_no = l.line_no LEFT JOIN rk ON rk.page_id = l.page_id AND rk.region_id = b.region_id
  LEFT JOIN c ON c.page_id = l.page_id)
SELECT page_id, line_no, region_id, bucket_no, row_number() OVER (PARTITION BY page_id ORDER BY bucket_no, CASE WHEN bucket_no IS NULL THEN floor(y0 / 15) END, CASE WHEN bucket_no IS NULL THEN x0 END, y0, line_no) AS order_no
  FROM a""",
    "row_bucket_order": f"""WITH {L} SELECT page_id, line_no, CAST(floor(y0 / 15) * 15 AS INT) AS row_bucket, row_number() OVER (PARTITION BY page_id ORDER BY floor(y0 / 15), x0, line_no) AS order_no
  FROM l""",
    "min_size_filter": f"WITH {L} SELECT page_id, line_no FROM l WHERE line_no % 12 >= 8 AND line_no % 5 <> 0",
    **{f"noise_reasons_{v.name}": f"WITH {_reasons(v)} SELECT page_id, line_no, reason FROM j" for v in (S, A, C, D)},
    "noise_summary": f"WITH {_reasons(D)} SELECT page_id, {'[' + ', '.join(map(_quoted, REASONS)) + ']'}[reason + 1] AS reason, count(*) AS n FROM j GROUP BY ALL",
    "accepted_counts": f"WITH {_reasons(S)} SELECT page_id, count(*) FILTER (reason = 0) AS accepted, count(*) FILTER (reason > 0) AS filtered FROM j GROUP BY page_id",
    "label_normalise": f"""WITH {R}, x AS (SELECT page_id, region_id, CASE WHEN region_id = 2 THEN 'Text' ELSE label END AS label
  FROM r) SELECT page_id, region_id, {_case('label', ALIASES_BC, 'label')} AS label_b, {_case('label', ALIASES_D, 'label')} AS label_d FROM x""",
    "label_route": f"WITH {D_REGIONS} SELECT page_id, region_id, label, {ROUTE} AS route FROM d",
    "label_counts": f"WITH {D_REGIONS} SELECT page_id, label, count(*) AS n FROM d GROUP BY ALL",
    "unknown_labels": f"WITH {D_REGIONS} SELECT page_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM d WHERE {ROUTE} = 'unknown' GROUP BY page_id",
    "topk_sorted": f"""WITH {R}, e AS (SELECT page_id, region_id, 1 AS i, 'Text' AS label, (page_id + region_id) % 7 / 10.0::DOUBLE AS confidence FROM r
  UNION ALL SELECT page_id, region_id, 2, 'Text', (3 * page_id + region_id) % 7 / 10.0::DOUBLE FROM r
UNION ALL SELECT page_id, region_id, 3, 'Caption', (page_id + 2 * region_id) % 5 / 10.0::DOUBLE FROM r
  UNION ALL SELECT page_id, region_id, 4, 'Mystery', region_id / 10.0::DOUBLE FROM r),
m AS (SELECT page_id, region_id, label, arg_max(confidence, i) AS confidence FROM e
  GROUP BY ALL) SELECT page_id, region_id, row_number() OVER (PARTITION BY page_id, region_id ORDER BY confidence DESC, label) - 1 AS k, label, confidence
  FROM m""",
    "bbox_from_polygon": f"WITH {R} SELECT page_id, region_id, x0, y0, x1, y1 FROM r WHERE page_id % 5 NOT IN (1, 2)",
    "rescale_regions": f"""WITH {R}, m AS (SELECT page_id, region_id, CASE page_id % 5 WHEN 2 THEN 2.0 WHEN 3 THEN 2.0 ELSE 1.0 END AS s, x0, y0, x1, y1 FROM r)
SELECT page_id, region_id, CAST(x0 * s AS DOUBLE) AS x0, CAST(y0 * s AS DOUBLE) AS y0, CAST(x1 * s AS DOUBLE) AS x1, CAST(y1 * s AS DOUBLE) AS y1 FROM m
  WHERE (x1 - x0) * s >= 40 AND (y1 - y0) * s >= 15""",
    "clamp_regions": f"""WITH {R} SELECT page_id, region_id, CAST(greatest(0, least(2400, trunc(x0 - 20.5))) AS INT) AS x0, CAST(greatest(0, least(1800, trunc(y0))) AS INT) AS y0, CAST(greatest(0, least(2400, trunc(x1))) AS INT) AS x1, CAST(greatest(0, least(1800, trunc(y1 + 0.75))) AS INT) AS y1
  FROM r""",
    "iou_pairs": f"""WITH {R}, p AS (SELECT a.page_id, a.region_id AS a, b.region_id AS b, {IOU} AS i, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS s
  FROM r a JOIN r b ON a.page_id = b.page_id AND a.region_id < b.region_id) SELECT page_id, a, b, round(i / (s - i), 9) AS iou FROM p WHERE i > 0""",
    "nms_regions": f"""WITH RECURSIVE {R}, o AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY (x1 - x0) * (y1 - y0) DESC, region_id) AS k FROM r
  WHERE x1 - x0 >= 40 AND y1 - y0 >= 15),
w AS (SELECT page_id, 0 AS k, []::STRUCT(region_id INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE)[] AS kept FROM (SELECT DISTINCT page_id FROM o)
UNION ALL SELECT b.page_id, b.k, CASE WHEN len(list_filter(kept, lambda a: {IOU} > 0.45 * ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {IOU}))) > 0 THEN kept ELSE kept || [{{region_id: b.region_id, x0: b.x0, y0: b.y0, x1: b.x1, y1: b.y1}}] END
  FROM w JOIN o b ON b.page_id = w.page_id AND b.k = w.k + 1),
z AS (SELECT page_id, arg_max(kept, k) AS kept FROM w GROUP BY page_id) SELECT page_id, x.region_id AS region_id FROM (SELECT page_id, unnest(kept) AS x FROM z)""",
    "fallback_region": f"""WITH {D_REGIONS} SELECT page_id, region_id, label, x0, y0, x1, y1 FROM d UNION ALL SELECT doc_id, 0, 'Text', 0, 0, 2400, 1800 FROM documents
  WHERE doc_id NOT IN (SELECT page_id FROM d)""",
    "gutter_histogram": f"WITH {HIST} SELECT page_id, bucket, cnt FROM h",
    "histogram_peak": f"WITH {HIST} SELECT page_id, arg_min(bucket, -cnt * 1000 + bucket) AS bucket, max(cnt) AS cnt, count(*) AS occupied FROM h GROUP BY page_id",
    "histogram_marked": f"""WITH RECURSIVE {FINAL} SELECT page_id, bucket, cnt, CAST((bucket + 0.5) * 4 AS DOUBLE) AS centre, len(list_filter(g, lambda x: abs(x - (bucket + 0.5) * 4) < 12)) > 0 AS near_gutter
  FROM h JOIN final USING (page_id)""",
    "gutter_gaps": f"WITH {GAPS} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY gap) - 1 AS i, CAST(gap AS DOUBLE) AS gap FROM gaps",
    "gutters_final": f"WITH RECURSIVE {FINAL} SELECT page_id, generate_subscripts(g, 1) - 1 AS i, CAST(unnest(g) AS DOUBLE) AS gutter FROM final",
    "gutters_removed": f"""WITH {GAPS}, e AS (SELECT DISTINCT page_id, CAST(round_even(gap, 0) AS INT) AS removed FROM gaps
  WHERE gap <= 192 OR gap >= 2208) SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY removed) - 1 AS i, removed FROM e""",
    "gutters_merged": """WITH RECURSIVE s AS (SELECT doc_id AS page_id, list_sort(list_transform(range(1, 13), lambda i: CAST(doc_id * i * 37 % 240 AS DOUBLE))) AS g
  FROM documents),
w AS (SELECT page_id, g, 1 AS k, [g[1]] AS m FROM s
  UNION ALL SELECT page_id, g, k + 1, CASE WHEN g[k + 1] - m[-1] < 20 THEN m[:-2] || [(m[-1] + g[k + 1]) / 2] ELSE m || [g[k + 1]] END FROM w WHERE k < 12)
SELECT page_id, generate_subscripts(m, 1) - 1 AS i, unnest(m) AS gutter FROM w WHERE k = 12""",
    "gutters_widened": f"""WITH RECURSIVE start AS (SELECT doc_id AS page_id, list_sort(list_transform(range(1, 10), lambda i: CAST(100 + doc_id * i * 137 % 2200 AS DOUBLE))) AS g
  FROM documents), {WIDEN} SELECT page_id, generate_subscripts(g, 1) - 1 AS i, unnest(g) AS gutter FROM final""",
    "column_labels": f"""WITH RECURSIVE {FINAL}, e AS (SELECT page_id, unnest([0.0::DOUBLE] || g) AS lo, unnest(g || [2400.0::DOUBLE]) AS hi, unnest(range(1, len(g) + 2)) AS col
  FROM final) SELECT page_id, col, lo, hi, (lo + hi) / 2 - 20 AS at FROM e""",
    "column_assign": f"WITH RECURSIVE {PLACED} SELECT page_id, line_no, is_header, col, CAST(x0 AS DOUBLE) AS x0, CAST(x1 AS DOUBLE) AS x1 FROM placed",
    "story_segments": f"WITH RECURSIVE {TOLD} SELECT page_id, line_no, seg_no, line_in_seg, note FROM told",
    "segment_table": f"""WITH RECURSIVE {TOLD} SELECT page_id, seg_no, any_value(note) AS note, count(*) AS n_lines, CAST(min(x0) AS DOUBLE) AS x0, min(y0) AS y0, CAST(max(x1) AS DOUBLE) AS x1, max(y1) AS y1
  FROM told GROUP BY page_id, seg_no""",
    "token_confidence": "WITH e AS (SELECT label, list_max(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE)))) / list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE)))) AS p FROM embeddings) SELECT label, round(avg(p), 6) AS confidence FROM e GROUP BY label",
    "two_pass_winner": f"""WITH {N}, {D_REGIONS}, q AS ({_read}),
  c AS (SELECT page_id, region_id, any_value(label) AS label, count(*) FILTER (pass = 1 AND length({_strip("text")}) > 0) AS n1, count(*) FILTER (pass = 2 AND length({_strip("text")}) > 0) AS n2
  FROM q JOIN d USING (page_id, region_id) GROUP BY ALL)
SELECT page_id, region_id, label, n1, n2, CASE WHEN n1 > 0 AND label NOT IN {_set(SINGLE_BLOCK_LABELS)} THEN 1 WHEN n2 > 0 AND n2 >= n1 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS winner
  FROM c""",
    "elements_ordered": f"""WITH {N}, {D_REGIONS},
  e AS (SELECT page_id, line_no AS elem_no, d.label AS source_label, position, line_no % 7 = 0 AS none, n.x0 + d.x0 AS ax0, n.y0 + d.y0 AS ay0, n.x1 + d.x0 AS ax1, n.y1 + d.y0 AS ay1, d.x0 AS dx0, d.y0 AS dy0, d.x1 AS dx1, d.y1 AS dy1
  FROM n JOIN d USING (page_id) WHERE d.region_id = line_no % 4 AND length({_strip("n.text")}) > 0),
f AS (SELECT page_id, elem_no, source_label, position, CASE WHEN none THEN dx0 ELSE ax0 END AS x0, CASE WHEN none THEN dy0 ELSE ay0 END AS y0, CASE WHEN none THEN dx1 ELSE ax1 END AS x1, CASE WHEN none THEN dy1 ELSE ay1 END AS y1
  FROM e)
SELECT page_id, elem_no, source_label, greatest(6.0::DOUBLE, least(72.0::DOUBLE, (y1 - y0) * 0.85::DOUBLE)) AS font_size, row_number() OVER (PARTITION BY page_id ORDER BY position, y0, elem_no) AS order_no, x0, y0, x1, y1
  FROM f""",
    "text_layer": f"""WITH {_reasons(D)} SELECT page_id, line_no AS elem_no, round(x0 * 0.24::DOUBLE, 6) AS x_pt, round(y1 * 0.24::DOUBLE, 6) AS y_pt, round(greatest(4.0::DOUBLE, greatest(6.0::DOUBLE, least(72.0::DOUBLE, (y1 - y0) * 0.85::DOUBLE)) * 0.24::DOUBLE), 6) AS font_pt, 3 AS render_mode, length(text) AS n_chars
  FROM j WHERE reason = 0""",
    "redaction_flags": f"""WITH {_reasons(D)} SELECT doc_id AS page_id, length({_strip(_old)}) > 0 AS s, length({_strip(_old)}) > 0 AND doc_id IN (SELECT page_id FROM j
  WHERE reason = 0) AS d FROM documents""",
    "empty_pages": f"WITH {_reasons(D)} SELECT doc_id AS page_id FROM documents WHERE doc_id NOT IN (SELECT page_id FROM j WHERE reason = 0)",
    "char_totals": f"""WITH {_reasons(D)} SELECT page_id % 50 AS doc, CAST(sum(length({_strip('text')})) AS BIGINT) AS chars, sum(length({_strip('text')})) > 0 AS success
  FROM j WHERE reason = 0 GROUP BY 1""",
    "size_budget": f"WITH {ATTEMPTS} {_budget(S)} UNION ALL {_budget(D)}",
    "run_summary": f"""WITH {ATTEMPTS}, f AS ({_budget(D)}) SELECT CASE WHEN name % 9 <> 0 THEN 'OK' ELSE 'FAILED' END AS status, count(*) AS files, CAST(sum(CASE WHEN name % 9 <> 0 THEN final_bytes ELSE 0 END) AS BIGINT) AS bytes
  FROM f GROUP BY 1""",
    "bbox_stats": f"""WITH {L} SELECT page_id, min(x1 - x0) AS min_w, max(x1 - x0) AS max_w, avg(x1 - x0) AS avg_w, min(y1 - y0) AS min_h, max(y1 - y0) AS max_h, avg(y1 - y0) AS avg_h
  FROM l GROUP BY page_id""",
    "draw_regions": f"""WITH {D_REGIONS}, c AS (SELECT *, {_case('label', LABEL_COLOURS, _quoted(DEFAULT_COLOUR))} AS colour
  FROM d) SELECT page_id, position AS z, region_id, x0, y0, x1, y1, CAST('0x' || colour[2:3] AS INT) AS r, CAST('0x' || colour[4:5] AS INT) AS g, CAST('0x' || colour[6:7] AS INT) AS b, position || ' ' || label AS caption
  FROM c""",
    "draw_lines": f"""WITH RECURSIVE {TOLD} SELECT page_id, line_no, CAST(x0 AS DOUBLE) AS x0, y0, CAST(x1 AS DOUBLE) AS x1, y1, [{', '.join(map(_quoted, SEGMENT_COLOURS))}][(seg_no - 1) % 10 + 1] AS colour, text[1:40] AS caption
  FROM told""",
    "review_spans": f"WITH {SPANS} SELECT page_id, span_no, text, x, y, size FROM spans",
    "review_canvas": f"""WITH {SPANS}, e AS (SELECT page_id, max(x + length(text) * 6.0::DOUBLE) - min(x) AS w, max(y + size) - min(y) AS h FROM spans GROUP BY page_id),
c AS (SELECT doc_id AS page_id, CASE WHEN w IS NULL THEN 500 ELSE greatest(CAST(trunc(w + 80) AS INT), 500) + 20 END AS ocr_w, CASE WHEN h IS NULL THEN 400 ELSE greatest(CAST(trunc(h + 80) AS INT), 400) + 20 END AS ocr_h
  FROM documents LEFT JOIN e ON e.page_id = doc_id)
SELECT page_id, ocr_w, ocr_h, 500 + ocr_w AS all_w, greatest(400, ocr_h) AS all_h FROM c""",
    "span_envelopes": f"""WITH {L} SELECT page_id, line_no, x1 - x0 AS w, greatest(6.0::DOUBLE, least(72.0::DOUBLE, (y1 - y0) * 0.9::DOUBLE)) AS font_s, greatest(6.0::DOUBLE, least(72.0::DOUBLE, (y1 - y0) * 0.85::DOUBLE)) AS font_d, CAST('0x' || [{', '.join(map(_quoted, SEGMENT_COLOURS))}][line_no % 10 + 1][2:3] AS INT) AS red, length({_strip('text')}) AS n
  FROM l""",
    "docinfo_xmp": f"""SELECT 'scan ' || o_orderkey || '.v1.pdf' AS name, 'scan ' || o_orderkey || '.v1.pdf' AS title, strftime(o_orderdate, 'D:%Y%m%d%H%M%S') AS created, sha256({_xmp()}) AS xmp_sha256,
'scan ' || o_orderkey || '.v1_ocr_temp.pdf' AS temp, 'scan ' || o_orderkey || '.v1_final.pdf' AS final, 'scan ' || o_orderkey || '.v1_review.jpg' AS review
  FROM orders""",
}

"""Inputs: Parquet tables, folders of files, and layout relations derived from documents.

A document stands for a page and each of its lines for a detected text line; geometry is
integer arithmetic on ids and lengths, so any engine computes the same. The statements
are shared by Spark and the checking SQL but for how a text is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPLIT_SPARK = r"SELECT doc_id, pos, txt FROM documents LATERAL VIEW posexplode(split(text, '\\n')) t AS pos, txt"
SPLIT_SQL = "SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS INT) AS pos, unnest(s) AS txt FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)"

LINES = """
SELECT doc_id AS page_id, pos AS line_no, txt AS text,
 CAST((pos % nc) * cw + 30 AS DOUBLE) AS x0,
 CAST(60 + r * 30 + 260 * FLOOR(r / 10.0) + 30 * FLOOR(r / 4.0) AS DOUBLE) AS y0,
 CAST((pos % nc) * cw + 30 + cw - 60 - 4 * (LENGTH(txt) % 3) AS DOUBLE) AS x1,
 CAST(60 + r * 30 + 260 * FLOOR(r / 10.0) + 30 * FLOOR(r / 4.0) + 20 + LENGTH(txt) % 7 AS DOUBLE) AS y1,
 CAST((doc_id * 31 + pos * 17) % 100 AS DOUBLE) / 100 AS confidence
FROM (SELECT doc_id, pos, txt, nc, CAST(FLOOR(2400.0 / nc) AS INT) AS cw, CAST(FLOOR(CAST(pos AS DOUBLE) / nc) AS INT) AS r
      FROM (SELECT doc_id, pos, txt, CAST(2 + doc_id % 3 AS INT) AS nc FROM (@split) b) b2) b3
"""
NOISE_LINES = """
SELECT page_id, line_no, x0, y0, x1, y1, confidence,
 CASE (page_id * 7 + line_no) % 23 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN 'aaaa' WHEN 3 THEN 'oOl|' WHEN 4 THEN '12.5' WHEN 5 THEN '—§' WHEN 6 THEN 'bcdfg' WHEN 7 THEN 'I.' ELSE text END AS text
FROM (@lines) q
"""
REGIONS = """
SELECT page_id, CAST(g AS INT) AS region_id,
 CAST(CASE WHEN g < nc THEN g * cw + 10 WHEN g = nc THEN 30 ELSE 5 END AS DOUBLE) AS x0,
 CAST(CASE WHEN g = nc + 1 THEN 5 ELSE 40 END AS DOUBLE) AS y0,
 CAST(CASE WHEN g < nc THEN (g + 1) * cw - 10 WHEN g = nc THEN cw + 10 ELSE 35 END AS DOUBLE) AS x1,
 CAST(CASE WHEN g = nc + 1 THEN 15 ELSE 3300 END AS DOUBLE) AS y1,
 CASE (page_id + g) % 9 WHEN 0 THEN 'Text' WHEN 1 THEN 'SectionHeader' WHEN 2 THEN 'page_header' WHEN 3 THEN 'Picture' WHEN 4 THEN 'FigureCaption' WHEN 5 THEN 'Table' WHEN 6 THEN 'Mystery' WHEN 7 THEN 'body' ELSE 'List-item' END AS label,
 CAST(g AS INT) AS position
FROM (SELECT doc_id AS page_id, nc, CAST(FLOOR(2400.0 / nc) AS INT) AS cw, g FROM (SELECT doc_id, CAST(2 + doc_id % 3 AS INT) AS nc, @steps AS g FROM documents) d WHERE g <= nc + 1) z
WHERE page_id % 11 <> 0 AND (g < nc OR page_id % 4 = 0)
"""
STEPS_SPARK, STEPS_SQL = "explode(sequence(0, 6))", "unnest(range(0, 7))"
LINES_SQL = LINES.replace("@split", SPLIT_SQL)
NOISE_LINES_SQL = NOISE_LINES.replace("@lines", LINES_SQL)
REGIONS_SQL = REGIONS.replace("@steps", STEPS_SQL)


def _derived(spark: SparkSession, sf_dir: str, sql: str, columns: tuple[str, ...]) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*columns)
    return spark.sql(sql.replace("FROM documents", "FROM {documents}"), documents=docs)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, LINES.replace("@split", SPLIT_SPARK), ("doc_id", "text"))


def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, NOISE_LINES.replace("@lines", LINES.replace("@split", SPLIT_SPARK)), ("doc_id", "text"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, REGIONS.replace("@steps", STEPS_SPARK), ("doc_id",))


def files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """Files of a folder, not of those below it: path, name, stem, length and content."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "length", "content")


def listed(found: DataFrame) -> DataFrame:
    """(name, kb) of files in order of their names; kilobytes are rounded down."""
    return found.select("name", F.expr("length div 1024").alias("kb")).orderBy("name")


def required(found: DataFrame, what: str) -> DataFrame:
    """``found``, unless it is empty, which is an error."""
    if found.isEmpty():
        raise FileNotFoundError(f"no {what} to work on")
    return found

"""Reading order of lines: by the region that holds them, or by rows where a page has none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import overlap_x
from ..plans.variants import REGION_OVERLAP, ROW_BUCKET


def assigned(lines: DataFrame, regions: DataFrame, least: float = REGION_OVERLAP) -> DataFrame:
    """``lines`` with region_id and bucket_no: the region that covers most of a line's width.

    Ties go to the leftmost region. A line that no region covers by more than ``least``
    has no region and the page's last bucket; on a page without regions bucket_no is null.
    A page's regions meet its lines as one array, so both sides are shuffled once.
    """
    row = F.struct("x0", "region_id", "x1")
    per = regions.groupBy("page_id").agg(F.array_sort(F.collect_list(row)).alias("__regions"))
    over = lambda r: overlap_x(F.col("x0"), F.col("x1"), r["x0"], r["x1"])
    scored = F.transform("__regions", lambda r, i: F.struct(over(r).alias("share"), (-i).alias("less"), r["region_id"].alias("region_id")))
    best = F.array_max(F.filter(scored, lambda s: s["share"] > least))
    joined = lines.join(per, "page_id", "left").withColumn("__best", best)
    bucket = F.when(F.col("__best").isNotNull(), -F.col("__best.less")).otherwise(F.size("__regions"))
    return joined.withColumn("region_id", F.col("__best.region_id")).withColumn("bucket_no", F.when(F.col("__regions").isNotNull(), bucket)).drop("__regions", "__best")


def row_bucket(y: str = "y0", height: int = ROW_BUCKET):
    return (F.floor(F.col(y) / height) * height).cast("int")


def ordered(assigned_lines: DataFrame) -> DataFrame:
    """``order_no`` on each page: bucket by bucket downwards, or row by row where there are no regions."""
    rows = F.when(F.col("bucket_no").isNull(), row_bucket())
    order = W.partitionBy("page_id").orderBy("bucket_no", rows, F.when(F.col("bucket_no").isNull(), F.col("x0")), "y0", "line_no")
    return assigned_lines.withColumn("order_no", F.row_number().over(order))


def by_rows(lines: DataFrame) -> DataFrame:
    order = W.partitionBy("page_id").orderBy(row_bucket(), "x0", "line_no")
    return lines.withColumn("row_bucket", row_bucket()).withColumn("order_no", F.row_number().over(order))


def by_position(elements: DataFrame) -> DataFrame:
    """Elements by their region's position and then downwards."""
    return elements.withColumn("order_no", F.row_number().over(W.partitionBy("page_id").orderBy("reading_position", "y0", "elem_no")))

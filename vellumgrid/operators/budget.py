"""The size budget of a written file, and the summary of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.variants import BUDGET, Variant


def chosen(attempts: DataFrame, rules: Variant, budget: float = BUDGET) -> DataFrame:
    """(name, budget, option, final_bytes) from (name, orig_size, plain_size, option, size, chars).

    Option 0 is the file as it is: taken if it is within the budget, or if no option of
    1..n is both within it and has kept its text. Some rule sets give up at the first
    option that fits but lost its text; others go on to the next.
    """
    most = (F.col("orig_size") * budget).cast("long")
    fits = (F.col("size") <= F.col("budget")) & (F.col("option") <= rules.options)
    good = fits & (F.col("chars") > 0)
    stops = fits if rules.abort_on_lost_text else good
    first = F.min(F.when(stops, F.struct("option", good.alias("good"), "size")))
    files = attempts.withColumn("budget", most).groupBy("name").agg(F.first("budget").alias("budget"), F.first("plain_size").alias("plain"), first.alias("hit"))
    taken = (F.col("plain") > F.col("budget")) & F.coalesce(F.col("hit.good"), F.lit(False))
    return files.select("name", "budget", F.when(taken, F.col("hit.option")).otherwise(0).alias("option"),
        F.when(taken, F.col("hit.size")).otherwise(F.col("plain")).alias("final_bytes"))


def summary(files: DataFrame) -> DataFrame:
    """Files and bytes by status, from (name, success, final_bytes); failed files count no bytes."""
    status = F.when(F.col("success"), "OK").otherwise("FAILED")
    return files.groupBy(status.alias("status")).agg(F.count("*").alias("files"),
        F.sum(F.when(F.col("success"), F.col("final_bytes")).otherwise(0)).cast("long").alias("bytes"))


def grown(files: DataFrame) -> DataFrame:
    """(name, orig_size, final_bytes, kb, growth): sizes with kilobytes rounded down and the growth in percent."""
    return files.select("name", "orig_size", "final_bytes", F.expr("final_bytes div 1024").alias("kb"), growth().alias("growth"))


def growth(orig: str = "orig_size", final: str = "final_bytes"):
    """Growth in percent; null for an empty original."""
    return F.try_divide((F.col(final) - F.col(orig)) * 100.0, F.col(orig))

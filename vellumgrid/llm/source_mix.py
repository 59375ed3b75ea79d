"""Mixing sources to target weights by capped water-filling.

Every source wants the share of the total that its weight gives, but may not be taken
more than ``epochs`` times over. Sources above that are clamped to it and what they
can't use goes to the others by weight, until none is above. That fixed point has a
closed form: with sources by cap/weight, a level L exists with target = min(cap,
weight * L), and the clamped ones are a prefix, so one ordered sum over the sources
(not the documents) finds it.

A source whose target is r times its size has floor(r) whole repetitions of each
document, and the rest as one more, fractional repetition: documents come in the order
of a seeded hash and are taken until the rest is used up. Running sums over documents
are taken bucket by bucket of that hash, so a source of any size is spread over many
tasks and no task holds a source.

Edge cases: a null text or source counts as size 0 or as a source of its own, last in
order; sources of size 0 have target 0; an empty table gives an empty result; rows that
repeat a doc_id are separate documents, in the order of all they are; columns named like
those made here are replaced.

Limits: targets() puts one row for each source in order in one task, which suits sources
of a corpus, not hosts by the billion; and rows that repeat one id share a place of the
seeded order, so a single id that is a large part of the input makes one large bucket
(of ids and sizes, no texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Scratch, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2.0
SEED = 17
#: The first hexadecimal digits of the hash that make a bucket.
DIGITS = 3


def words(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, epochs: float = EPOCHS, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), by water-filling.

    One row for each source is put in order in one task; that is the only such step.
    """
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    n = (F.row_number().over(order) - 1) % len(weights)
    every = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n + 1).cast("int"))).withColumn("__cap",
        F.col("source_size") * F.lit(float(epochs)))
    ranked = ranked.withColumn("__total", F.sum("source_size").over(every) * F.lit(float(share))).withColumn("__all_w", F.sum("__w").over(every))
    level = W.orderBy(F.col("__cap") / F.col("__w"), F.col("source").isNull(), F.encode("source", "UTF-8")).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = ranked.withColumn("__used", F.sum("__cap").over(level)).withColumn("__used_w", F.sum("__w").over(level))
    # with the sources before this one clamped, is this one above its cap?
    own = (F.col("__total") - (F.col("__used") - F.col("__cap"))) / (F.col("__all_w") - (F.col("__used_w") - F.col("__w")))
    ranked = ranked.withColumn("__level", own).withColumn("__clamped", F.col("__level") * F.col("__w") > F.col("__cap"))
    free = F.min(F.when(~F.col("__clamped"), F.struct("__used_w", "__level"))).over(every)
    return ranked.select("source", "source_size", F.when(F.col("__clamped"),
        F.col("__cap")).otherwise(F.coalesce(free["__level"], F.lit(0.0)) * F.col("__w")).alias("target"))


def _place(id: str, seed: int) -> Column:
    """The place of a document in the seeded order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))).cast("binary"))


def repetitions(docs: DataFrame, share: float = SHARE, epochs: float = EPOCHS, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED,
    id: str = "doc_id", text: str = "text", source: str = "source", scratch: Scratch | None = None) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, whole documents only.

    A source's fractional repetition ends at one place of the seeded order. That place,
    one row for each source, is found from sizes alone; then every document decides for
    itself, so no text is shuffled unless there are too many sources to broadcast.
    Rows that are equal in id and size are taken or left together.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    name, key, size = F.col(f"`{source}`").cast("string"), _place(id, seed), words(text)
    sized = docs.select(name.alias("source"), size.alias("size"), key.alias("key")).groupBy("source", "key", "size").agg(F.count("*").alias("rows"))
    sized = scratch.keep(sized.withColumn("bucket", F.substring("key", 1, DIGITS)), "sizes")
    buckets = sized.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("rows")).alias("n"))
    plan = targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), share, epochs, weights)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    to = F.sum("n").over(W.partitionBy("source").orderBy("bucket"))
    cut = buckets.withColumn("before", to - F.col("n")).alias("b").join(plan.alias("p"),
        F.col("b.source").eqNullSafe(F.col("p.source"))).where("before < rest and rest <= before + n").select("b.source", "bucket", "before", "rest")
    inside = sized.alias("d").join(cut.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.bucket") == F.col("c.bucket"))).select("d.source", "d.bucket", "key", "size", "rows", "before", "rest")
    was = F.sum(F.col("size") * F.col("rows")).over(W.partitionBy("source").orderBy("key", "size")) - F.col("size") * F.col("rows")
    last = inside.withColumn("left", F.col("rest") - F.col("before") - was).where("left > 0 and 2 * left >= size * rows").groupBy("source").agg(F.max(F.struct("key", "size")).alias("last"))
    ends = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").join(last.alias("l"),
        F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    ends = scratch.keep(ends.select(F.col("p.source").alias("__s"), F.col("whole").alias("__whole"),
        F.when(F.col("p.rest") > 0, F.coalesce("bucket", F.lit("g"))).alias("__bucket"), F.col("last").alias("__last")), "ends")
    # a written table has a known size: Spark broadcasts it only if it is below its limit
    both = docs.withColumns({"__size": size, "__key": key}).join(ends, name.eqNullSafe(F.col("__s")))
    first = F.substring("__key", 1, DIGITS)
    part = (F.col("__bucket").isNotNull() & ((first < F.col("__bucket")) | ((first == F.col("__bucket")) & F.coalesce(F.struct(F.col("__key").alias("key"), F.col("__size").alias("size")) <= F.col("__last"), F.lit(False))))).cast("int")
    times = F.when(F.col("__size") > 0, F.col("__whole").cast("int") + part).otherwise(0)
    every = F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")))
    return both.withColumn("__n", every).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(docs: DataFrame, share: float = SHARE, epochs: float = EPOCHS, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, id: str = "doc_id",
    text: str = "text", source: str = "source", divide: bool = True, keep: tuple[str, ...] = (), scratch: Scratch | None = None) -> DataFrame:
    """Per document: id, size, source, source_size, target, taken (words, repeats counted), and the columns ``keep``.

    With ``divide`` the document at which a source's rest is used up gives just what is
    missing; without, it is taken whole if that is nearer.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    key = _place(id, seed)
    named = list(dict.fromkeys([id, *keep]))
    sized = docs.select(*[F.col(f"`{c}`") for c in named if c not in ("source",)], F.col(f"`{source}`").cast("string").alias("source"),
        words(text).alias("size"), key.alias("__key"))
    sized = scratch.keep(sized.withColumn("__bucket", F.substring("__key", 1, DIGITS)), "sizes")
    buckets = sized.groupBy("source", "__bucket").agg(F.sum("size").alias("n"))
    plan = targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), share, epochs, weights)
    plan = plan.withColumn("__whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("__rest", F.round(F.col("target") - F.col("__whole") * F.col("source_size")).cast("long"))
    same = F.col("b.source").eqNullSafe(F.col("p.source"))
    before = buckets.select("source", "__bucket", (F.sum("n").over(W.partitionBy("source").orderBy("__bucket")) - F.col("n")).alias("__before"))
    ready = before.alias("b").join(plan.alias("p"), same).select("b.source", "b.__bucket", "__before", "source_size", "target", "__whole", "__rest")
    # all rows of a bucket stand together, a few for each of 16**DIGITS buckets of a source
    within = W.partitionBy("source", "__bucket").orderBy("__key", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = sized.withColumn("__to", F.sum("size").over(within))
    both = placed.alias("d").join(ready.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.__bucket") == F.col("b.__bucket")))
    left = F.col("__rest") - F.col("__before") - (F.col("__to") - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    if not divide:
        part = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(0)
    return both.select(*[F.col(f"d.`{c}`") for c in named if c != "source"], "d.source", "size", "source_size", "target",
        (F.col("__whole") * F.col("size") + part).cast("long").alias("taken"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS n FROM d GROUP BY source),
w AS (SELECT *, CASE n WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * {EPOCHS}::DOUBLE AS cap FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) * {SHARE}::DOUBLE AS total, sum(w) OVER () AS all_w, sum(cap) OVER r AS used, sum(w) OVER r AS used_w FROM w WINDOW r AS (ORDER BY cap / w, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
v AS (SELECT *, (total - (used - cap)) / (all_w - (used_w - w)) AS lvl FROM l),
t AS (SELECT source, source_size, CASE WHEN lvl * w > cap THEN cap ELSE coalesce((SELECT arg_min(lvl, used_w) FROM v WHERE lvl * w <= cap), 0) * w END AS target FROM v),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
q AS (SELECT *, CAST(round(target - whole * source_size) AS BIGINT) AS rest FROM p),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), size ROWS UNBOUNDED PRECEDING) - size AS was FROM d)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - was)) AS BIGINT) AS taken
FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source
"""

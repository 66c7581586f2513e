"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix by weight, but never more than a maximum
number of epochs of its own size: sources over that cap are clamped to it and
their excess is shared among the others by weight, again and again, until none
is above. A target is then met by whole repetitions of all the source's
documents and one seeded part of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from phenoscope.llm.common import unit_interval, word_count, written

#: Rows per hash bucket that the seeded order is sorted in, on average.
BUCKET_ROWS = 4096


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to per-source rows ``(…, size, weight)``.

    The targets add up to ``share`` of all sizes if the caps allow it. Each
    round takes two sums over the sources that are still free and clamps those
    above their cap; only the two sums reach the driver. Sources of size 0 or
    without a positive weight get 0.
    """
    state = written(sources.withColumns({
        "_cap": F.when(F.col("weight") > 0, F.col("size") * F.lit(float(max_epochs))).otherwise(0.0),
        "target": F.lit(None).cast("double")}), "fill")
    total = share * float(state.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    while True:
        free = F.col("target").isNull()
        used, weight = state.agg(F.coalesce(F.sum("target"), F.lit(0.0)),
                                 F.coalesce(F.sum(F.when(free & (F.col("_cap") > 0), F.col("weight"))),
                                            F.lit(0)).cast("double")).first()
        level = max(0.0, total - used) / weight if weight else 0.0
        part = F.col("weight") * F.lit(level)
        over = free & (part >= F.col("_cap"))
        if state.filter(over).isEmpty():
            return state.withColumn("target", F.coalesce("target", part)).drop("_cap")
        state = written(state.withColumn("target", F.when(over, F.col("_cap")).otherwise(F.col("target"))), "fill")


def cycle_weights(sources: DataFrame, weights: tuple[float, ...], source_col: str) -> DataFrame:
    """Add ``weight``: ``weights`` dealt round over the sources by code point, null last.

    The sources are few rows (one each). Their order is found without a single
    window: sources are counted per first code point, and ranks inside a code
    point are added to the count before it.
    """
    first = F.coalesce(F.ascii(F.col(source_col)), F.lit(1 << 30))
    rows = sources.withColumn("_first", first)
    counts = rows.groupBy("_first").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_first", F.coalesce(F.sum("_n").over(
        Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_first").orderBy(F.col(source_col).asc_nulls_last()))
    place = F.pmod(F.col("_before") + inside - 1, F.lit(len(weights)))
    return rows.join(before, "_first").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))) \
        .drop("_first", "_before")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
                max_epochs: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """One row per input row: ``(id, size, source_size, target, repeats, taken)``.

    ``size`` is the document's number of words, ``source_size`` and ``target``
    are its source's, ``repeats`` how often the mix takes the whole document
    and ``taken`` is ``repeats * size``. With ``r = target / source_size`` every
    document is taken ``floor(r)`` times; those first in a seeded hash order of
    the source are taken once more, up to the document at which the running sum
    of sizes comes nearest the rest of the target.

    The seeded order is never sorted as a whole: sizes are summed per (source,
    hash bucket), running sums of those small sums find the one bucket of a
    source in which the rest is reached, and only that bucket's rows are ranked.
    The number of buckets follows the number of rows.

    Null, empty and blank texts have size 0, are taken 0 words and repeated
    like any other document. Null sources form one source, last in order. Rows
    that repeat an id share a hash and are ordered by size; ties change no sum.
    An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                       word_count(F.col(text_col)).alias("size"))
    rows = written(rows.withColumn("_u", unit_interval(F.col("_id"), seed)), "sizes")
    sources = rows.groupBy("_source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("_docs"))
    filled = water_fill(cycle_weights(sources, weights, "_source"), share, max_epochs)
    rate = F.coalesce(F.try_divide("target", "size"), F.lit(0.0))
    filled = written(filled.select(
        F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit("")).alias("_key"),
        F.col("size").alias("source_size"), "target", F.floor(rate).cast("long").alias("_whole"),
        ((rate - F.floor(rate)) * F.col("size")).alias("_rest"),
        F.ceil(F.col("_docs") / F.lit(BUCKET_ROWS)).alias("_buckets")), "targets")
    keyed = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit(""))) \
        .join(filled, "_key").withColumn("_bucket", F.floor(F.col("_u") * F.col("_buckets")))
    sums = keyed.groupBy("_key", "_bucket").agg(F.sum("size").alias("_sum"), F.first("_rest").alias("_rest"))
    so_far = F.sum("_sum").over(Window.partitionBy("_key").orderBy("_bucket"))
    edge = written(sums.withColumn("_to", so_far).filter(
        (F.col("_to") > F.col("_rest")) & (F.col("_to") - F.col("_sum") <= F.col("_rest")))
        .select("_key", F.col("_bucket").alias("_edge"), (F.col("_to") - F.col("_sum")).alias("_from")), "edges")
    placed = keyed.join(edge, "_key", "left")
    at_edge = F.col("_bucket") == F.col("_edge")
    run_to = F.col("_from") + F.sum("size").over(
        Window.partitionBy("_key").orderBy("_u", "size", "_id").rowsBetween(Window.unboundedPreceding, 0))
    near = (run_to - F.col("size") / 2.0) <= F.col("_rest")
    outside = placed.filter(F.coalesce(~at_edge, F.lit(True))).withColumn(
        "_more", F.coalesce(F.col("_bucket") < F.col("_edge"), F.col("_rest") > 0))
    inside = placed.filter(at_edge).withColumn("_more", near & (F.col("_rest") > 0))
    repeats = F.col("_whole") + F.col("_more").cast("long")
    return outside.unionByName(inside).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"),
        (repeats * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(doc_id::VARCHAR || ':17'), 1, 10) AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS size,
         [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 2.0::DOUBLE * size AS cap, row_number() OVER (ORDER BY size / w, w, source NULLS LAST) AS k FROM s),
c AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY k DESC) AS free FROM r),
l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(size) FROM s) - used) / free AS level FROM c),
f AS (SELECT min(k) AS k FROM l WHERE w * level < cap),
t AS (
  SELECT source, size, CASE WHEN k < coalesce((SELECT k FROM f), 1 << 60) THEN cap
         ELSE w * (SELECT level FROM l WHERE k = (SELECT k FROM f)) END AS target FROM l),
o AS (
  SELECT d.doc_id, d.size, t.size AS source_size, t.target,
         coalesce(t.target / nullif(t.size, 0), 0) AS rate,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN (rate - floor(rate)) * source_size > 0
                AND upto - size / 2.0 <= (rate - floor(rate)) * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o
"""

"""Exact dedup: documents that are equal apart from white space.

Documents are grouped by a 128-bit content hash and, inside the hash group, by
the bytes themselves, so that a hash collision never merges two texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoscope.llm.common import SPACE_PATTERN, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when identical after deleting space and tab to carriage
    return. Of equal texts the row with the most code points in the original
    text stays, then the one with the smallest id.

    The grouping by (hash, bytes) merges copies before the shuffle; its result
    without the bytes is written and joined back by hash. Only if two different
    texts do share that hash is the join back by SHA-256 as well.

    Null texts count as empty; empty and blank texts form one group. Rows that
    repeat an id are rows of their own and are all ``kept`` or all dropped. A
    null id sorts after all others. An empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")) \
        .withColumn("_norm", F.regexp_replace("_text", SPACE_PATTERN, ""))
    rows = rows.withColumn("_hash", F.unhex(F.md5("_norm")))
    order = F.struct((-F.length("_text")).alias("n"), F.col("_id").isNull().alias("z"), F.col("_id").alias("id"))
    classes = rows.groupBy("_hash", "_norm").agg(
        F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    summary = written(classes.select(
        "_hash", F.col("best.id").alias("keep_id"), "group_size", F.sha2("_norm", 256).alias("text_sha256")), "classes")
    clash = summary.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    keys = ["_hash"]
    members = rows.select("_id", "_hash")
    if not clash.isEmpty():
        keys = ["_hash", "text_sha256"]
        members = rows.select("_id", "_hash", F.sha2("_norm", 256).alias("text_sha256"))
    return members.join(summary, keys).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n
WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)
"""

"""Lookups built by exploding nested target and approval data.

D-10 liability_sources, D-11 liability_count, D-12 constraint_lof /
lof_tolerance, D-20 list_flag, D-22 attach_warnings.
Arrays are filtered before they are exploded, so element predicates run
inside the scan's projection and only matching elements become rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoscope.functions import constants as K
from phenoscope.operators.scoring import minmax_scale


def liability_sources(targets: DataFrame) -> DataFrame:
    """D-10: number of liability entries per data source (null source kept)."""
    entries = targets.select(F.explode_outer("safetyLiabilities").alias("l"))
    return entries.groupBy(F.col("l.datasource").alias("datasource")).agg(
        F.count(F.lit(1)).alias("count"))


def liability_count(targets: DataFrame, exclude: Sequence[str] = K.LIABILITY_EXCLUDED,
                    name: str = "safetyLiabl") -> DataFrame:
    """D-11: per target, the number of liability events outside ``exclude``.

    Entries with a null data source are dropped (a negated membership test is
    null for them); null events are not counted. Targets left without any
    entry do not appear.
    """
    kept = F.filter(F.col("safetyLiabilities"), lambda x: ~x["datasource"].isin(*exclude))
    rows = targets.select("id", F.explode(kept).alias("l"))
    return rows.groupBy("id").agg(F.count(F.col("l.event")).alias(name))


def constraint_lof(targets: DataFrame) -> DataFrame:
    """D-12: the loss-of-function constraint entries (rank, oe, score) per target."""
    lof = F.filter(F.col("constraint"), lambda x: x["constraintType"] == "lof")
    rows = targets.select("id", F.explode(lof).alias("c"))
    return rows.select("id", F.col("c.upperRank").alias("upperRank"), F.col("c.oe").alias("oe"),
                       F.col("c.score").alias("scoreConstraint"), F.col("c.constraintType").alias("constraintType"))


def lof_tolerance(targets: DataFrame) -> DataFrame:
    """D-12 + D-13: upper rank of the LoF constraint scaled to [-1, 1] over all targets."""
    lof = constraint_lof(targets)
    scaled = minmax_scale(lof, "upperRank", "cal_score")
    return scaled.select("id", "cal_score", "constraintType")


def list_flag(df: DataFrame, list_col: str, sep: str = ";", id_name: str = "id",
              flag_name: str = "approved", flag_value: str = "approved") -> DataFrame:
    """D-20: split a delimited id list, trim, one row per distinct id with a constant flag."""
    tokens = df.select(F.explode(F.split(F.col(list_col), sep)).alias("_token"))
    ids = tokens.select(F.trim(F.col("_token")).alias(id_name))
    return ids.distinct().withColumn(flag_name, F.lit(flag_value))


def attach_warnings(pairs: DataFrame, warnings: DataFrame) -> DataFrame:
    """D-22: drug warnings beside (target, drug) pairs; one row per distinct combination."""
    per_drug = warnings.select(F.explode_outer("chemblIds").alias("drugId"), "toxicityClass", "warningType")
    return pairs.join(per_drug, on="drugId", how="left").distinct()

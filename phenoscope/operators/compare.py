"""D-25: the wide comparison frame, one row per scored target.

All feature frames are keyed by ``id`` with one row per key, which is checked. The chain of
left joins shares the key, so after the first shuffle by ``id`` the
accumulated side keeps its partitioning; small feature frames are
broadcast by adaptive execution from their runtime size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by(df: DataFrame, key: str = "id") -> DataFrame:
    """``df`` with one row per key; a key held by more than one row fails the query.

    A left join on such a key would multiply rows. The check is an aggregate on
    the join's own key, so the join needs no further shuffle.
    """
    rest = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(*[F.first(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_rows"))
    bad = F.raise_error(F.concat(F.lit(f"more than one row for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    # a filter, so that the key stays the column by which the rows are partitioned
    return one.filter(F.when(F.col("_rows") > 1, bad.cast("boolean")).otherwise(F.lit(True))).select(key, *rest)


def comparison_frame(scores: DataFrame, features: Sequence[DataFrame],
                     zero_flags: Sequence[str] = ("allBBW", "allWD"), key: str = "id") -> DataFrame:
    out = scores
    for feature in features:
        out = out.join(unique_by(feature, key), on=key, how="left")
    for flag in zero_flags:
        if flag in out.columns:
            out = out.withColumn(flag, F.when(F.col(flag) == 1, F.lit(1)).otherwise(F.lit(0)))
    return out


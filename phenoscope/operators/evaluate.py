"""How well a score predicts a 0/1 outcome (D-34..D-37, D-43).

Nothing is collected: ROC points and AUC come from per-score counts, written
once, with running totals over one order of (group, score) (see ``ordered``); the
balanced sample keeps the negatives with the smallest seeded hash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoscope.operators.ordered import BUCKET_ROWS, attach_scalars, hash_first_n, ordered_totals


def balanced_sample(df: DataFrame, label_col: str, key_col: str, seed: int = 0,
                    n: int | DataFrame | None = None) -> DataFrame:
    """D-34: every positive (y=1) plus up to ``n`` negatives (y=0).

    Negatives are taken in the order of md5(key:seed), ties by key, so the
    sample is the same on every run and after any task retry. ``n`` is a number
    or a frame of one row and column, by default the number of positives.
    """
    pos = df.filter(F.col(label_col) == 1).withColumn("y", F.lit(1))
    neg = df.filter(F.col(label_col) == 0)
    if n is None or isinstance(n, DataFrame):
        count = pos.agg(F.count(F.lit(1)).alias("_n")) if n is None else n.toDF("_n")
        picked = hash_first_n(attach_scalars(neg, count), key_col, seed, F.col("_n")).drop("_n")
    else:
        picked = hash_first_n(neg, key_col, seed, n)
    return pos.unionByName(picked.withColumn("y", F.lit(0)))


def score_counts(df: DataFrame, y_col: str, score_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (null scores left out)."""
    y = F.col(y_col).cast("long")
    return (df.filter(F.col(score_col).isNotNull() & F.col(y_col).isNotNull())
            .groupBy(*group_cols, F.col(score_col).cast("double").alias("threshold"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def _cumulative(counts: DataFrame, group_cols: Sequence[str], bucket_rows: int) -> DataFrame:
    """Per distinct score: tp/fp = positives/negatives at or above it; P/N group totals."""
    cum = ordered_totals(counts, group_cols, [F.col("threshold").desc()], ["pos", "neg"], bucket_rows)
    return cum.withColumnsRenamed({"pos_run": "tp", "neg_run": "fp", "pos_all": "P", "neg_all": "N"})


def roc_curve(df: DataFrame, y_col: str, score_col: str, group_cols: Sequence[str] = (),
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """D-35: one ROC point per distinct score, taken as threshold (score >= t).

    The curve of every group starts at (0, 0), the point of the threshold
    infinity, which no score reaches. Without positives (negatives) the true
    (false) positive rate is null. ``df`` is read once.
    """
    counts = score_counts(df, y_col, score_col, group_cols)
    cum = _cumulative(counts, group_cols, bucket_rows)
    # the starting point stands beside the group's first score
    point = lambda t, tp, fp: F.struct(t.cast("double").alias("threshold"), tp.cast("long").alias("tp"), fp.cast("long").alias("fp"))
    here = point(F.col("threshold"), F.col("tp"), F.col("fp"))
    start = point(F.lit(float("inf")), F.lit(0), F.lit(0))
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    points = cum.select(*group_cols, "P", "N", F.explode(F.when(first, F.array(start, here)).otherwise(F.array(here))).alias("at"))
    return points.select(*group_cols, "at.threshold", "at.tp", "at.fp",
                         F.try_divide(F.col("at.tp"), F.col("P")).alias("tpr"),
                         F.try_divide(F.col("at.fp"), F.col("N")).alias("fpr"))


def roc_auc(df: DataFrame, y_col: str, score_col: str, group_cols: Sequence[str] = (),
            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """D-36: area under the ROC curve per group, ties counted one half.

    AUC = sum over distinct scores s of pos(s) * (negatives below s + neg(s)/2) / (P*N),
    in double, since the products outgrow a long from some 10^9 rows on. ``df`` is read once.
    """
    groups = list(group_cols)
    cum = _cumulative(score_counts(df, y_col, score_col, groups), groups, bucket_rows)
    pos, below = F.col("pos").cast("double"), (F.col("N") - F.col("fp")).cast("double")
    part = pos * below + F.lit(0.5) * pos * F.col("neg")
    # a group inside one bucket is summed there; the few that go on, two a bucket at most, in one task
    sums = cum.groupBy("_rt_bucket", *groups).agg(F.sum(part).alias("area"), F.first("P").alias("P"), F.first("N").alias("N"),
                                                  F.first("_rt_edge").alias("edge"))
    summed = sums.filter("edge").select(*groups, "area", "P", "N").coalesce(1).groupBy(*groups).agg(
        F.sum("area").alias("area"), F.first("P").alias("P"), F.first("N").alias("N"))
    if groups:
        summed = summed.unionByName(sums.filter("not edge").select(*groups, "area", "P", "N"))
    return summed.select(*groups, F.try_divide(F.col("area"), F.col("P").cast("double") * F.col("N").cast("double")).alias("auc"),
                         F.col("P").alias("n_pos"), F.col("N").alias("n_neg"))


def long_scores(df: DataFrame, key_col: str, y_col: str, predictors: Sequence[str]) -> DataFrame:
    """(key, y, predictor, score): one row per row and predictor."""
    pairs = F.array(*[F.struct(F.lit(p).alias("predictor"), F.col(p).cast("double").alias("score"))
                      for p in predictors])
    return df.select(key_col, y_col, F.explode(pairs).alias("_p")).select(
        key_col, y_col, F.col("_p.predictor").alias("predictor"), F.col("_p.score").alias("score"))


def auc_grid(df: DataFrame, labels: Sequence[str], predictors: Sequence[str], key_col: str,
             seed: int = 0, balanced: bool = True,
             negatives: Mapping[str, int | DataFrame] | None = None) -> DataFrame:
    """D-37: AUC of every predictor for every outcome label.

    Rows with a null predictor are left out. With ``balanced`` each label
    gets its own balanced sample (D-34) before the AUCs are taken;
    ``negatives`` gives a label's number of negatives, as a number or as a frame
    of one row and column (its number of positives where not given).
    """
    sizes = dict(negatives or {})
    working = df
    for p in predictors:
        working = working.filter(F.col(p).isNotNull())
    parts = []
    for label in labels:
        if balanced:
            sample = balanced_sample(working, label, key_col, seed, sizes.get(label))
        else:
            sample = working.withColumn("y", F.col(label))
        parts.append(long_scores(sample, key_col, "y", predictors).withColumn("label", F.lit(label)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    auc = roc_auc(stacked, "y", "score", ["label", "predictor"])
    return auc.withColumn("n", F.col("n_pos") + F.col("n_neg"))


def feature_counts(df: DataFrame, labels: Sequence[str], predictors: Sequence[str],
                   within: Column | None = None) -> DataFrame:
    """D-43: one row: positives per outcome flag, nulls per predictor, all rows.

    Positives are counted among the rows for which ``within`` holds (all by default).
    """
    inside = F.lit(True) if within is None else within
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(inside & (F.col(lab) == 1)).alias(f"pos_{lab}") for lab in labels]
    aggs += [F.count_if(F.col(p).isNull()).alias(f"null_{p}") for p in predictors]
    return df.agg(*aggs)

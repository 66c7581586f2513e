"""Scores per target: phenotype-class weights, harmonic family, min-max, bins.

D-13 minmax_scale, D-14 weights, D-15 score_lists, D-16/D-17 with_harmonic and harmonic_ranked,
D-18/D-19 scaled_harmonic, D-26 quantile_bins / quantile_bins_approx.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenoscope.functions import harmonic as H
from phenoscope.operators.ordered import attach_scalars, exact_cut_points, join_groups


def score_multiset(df: DataFrame, key_cols: Sequence[str], score_col: str,
                   out_col: str = "scores", count_col: str | None = None) -> DataFrame:
    """(key, array<struct<score, n>>) with one entry per distinct non-null score.

    Keys whose scores are all null keep an empty array (harmonic sum 0).
    Two aggregations: (key, score) counts with map-side combine, then a
    per-key array bounded by the number of distinct score values (for scores
    without such a bound use ``harmonic_ranked``). ``count_col`` names a column of
    row counts when the input is already counted.
    """
    keys = list(key_cols)
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    counts = df.groupBy(*keys, F.col(score_col).alias("_score")).agg(n.alias("_n"))
    entry = F.when(F.col("_score").isNotNull(),
                   F.struct(F.col("_score").cast("double").alias("score"), F.col("_n").alias("n")))
    return counts.groupBy(*keys).agg(F.sort_array(F.collect_list(entry), asc=False).alias(out_col))


def score_lists(phenotypes: DataFrame, weights: DataFrame) -> DataFrame:
    """D-15: weight of every phenotype class of a target, as a per-target multiset.

    ``phenotypes``: targetFromSourceId, modelPhenotypeClasses (array<struct<id>>).
    ``weights``: idLabel, curatedScore (the planner broadcasts it if its size allows).
    Classes without a weight and targets without classes give null scores,
    which are left out of the multiset (the target stays, with no scores).
    """
    exploded = phenotypes.select(
        "targetFromSourceId",
        F.explode_outer(F.col("modelPhenotypeClasses.id")).alias("classId"))
    w = weights.select("idLabel", "curatedScore")
    scored = exploded.join(w, exploded.classId == w.idLabel, "left")
    return score_multiset(scored, ["targetFromSourceId"], "curatedScore")


def harmonic_ranked(df: DataFrame, key_cols: Sequence[str], score_col: str) -> DataFrame:
    """D-16 for scores of any kind: (key, n_scores, harmonicSum, harmonicSumNorm).

    Scores are ranked by a window in each key, which spills, and summed as
    score / rank^2. Use this form for continuous scores, whose multiset would grow
    with the rows; ``score_multiset`` with ``with_harmonic`` for few distinct ones.
    Both give the same sums. Null scores are left out; a key without scores gets 0.
    """
    keys = list(key_cols)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(score_col).desc_nulls_last()))
    ranked = df.select(*keys, F.col(score_col).cast("double").alias("_score"), rank.cast("double").alias("_rank"))
    out = ranked.groupBy(*keys).agg(
        F.count("_score").alias("n_scores"),
        F.coalesce(F.sum(F.col("_score") / (F.col("_rank") * F.col("_rank"))), F.lit(0.0)).alias("harmonicSum"))
    return out.withColumn("harmonicSumNorm", H.harmonic_norm(F.col("harmonicSum")))


def with_harmonic(df: DataFrame, scores_col: str = "scores") -> DataFrame:
    """D-16/D-17: add ``harmonicSum`` and ``harmonicSumNorm`` from a score multiset."""
    hs = H.harmonic_sum(F.col(scores_col))
    return df.withColumn("harmonicSum", hs).withColumn(
        "harmonicSumNorm", H.harmonic_norm(F.col("harmonicSum")))


def scaled_harmonic(df: DataFrame, scores_col: str = "scores") -> DataFrame:
    """D-18/D-19: harmonic sum over the largest possible one, negated.

    ``maxHarmonicSum`` is H(n) for the target's own n; the divisor is its
    maximum over all targets, i.e. H(max n), taken from a one-row aggregate.
    """
    n = H.multiset_count(F.col(scores_col))
    staged = (df.withColumn("nScores", n)
              .withColumn("harmonicSum", H.harmonic_sum(F.col(scores_col)))
              .withColumn("maxHarmonicSum", H.max_harmonic(F.col("nScores"))))
    top = staged.agg(F.max("nScores").alias("_max_n")).select(
        H.max_harmonic(F.coalesce(F.col("_max_n"), F.lit(0))).alias("maximum"))
    return attach_scalars(staged, top).withColumn(
        "scaledHarmonicSum", -F.try_divide(F.col("harmonicSum"), F.col("maximum")))


def minmax_scale(df: DataFrame, value_col: str, out_col: str,
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """D-13: 2*(x-min)/(max-min) - 1 within each group (global if none).

    Equal min and max give null (no division error under ANSI mode).
    """
    groups = list(group_cols)
    stats = df.groupBy(*groups).agg(F.min(value_col).alias("_min"), F.max(value_col).alias("_max"))
    joined = join_groups(df, stats, groups, "left") if groups else attach_scalars(df, stats)
    x = F.col(value_col)
    scaled = F.lit(2) * F.try_divide(x - F.col("_min"), F.col("_max") - F.col("_min")) - F.lit(1)
    return joined.withColumn(out_col, scaled.cast("double")).drop("_min", "_max")


def _bin_label(x, cuts):
    # label = 1 + number of cut points <= x; null stays null
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(
        F.lit(1) + F.size(F.filter(cuts, lambda c: c <= x)))


def quantile_bins(df: DataFrame, value_col: str, out_col: str, num_bins: int = 10, scores: DataFrame | None = None) -> DataFrame:
    """D-26 (exact): bin number 1..num_bins from exact discrete quantile cut points.

    The cut points, ``num_bins`` - 1 numbers, are computed at once and are constants of the
    plan. ``scores`` is a frame with the same values that is cheaper to read than
    ``df``: the scores before they are joined to other columns.
    """
    cuts = exact_cut_points(df if scores is None else scores, value_col, num_bins)
    kind = df.schema[value_col].dataType
    points = F.array(*[F.lit(c).cast(kind) for c in cuts]) if cuts else F.array().cast(f"array<{kind.simpleString()}>")
    return df.withColumn(out_col, _bin_label(F.col(value_col), points))


def approx_cut_points(df: DataFrame, value_col: str,
                      probabilities: Sequence[float] = tuple(i / 10 for i in range(1, 10)),
                      relative_error: float = 0.01) -> DataFrame:
    """One row, column ``cuts``: values whose rank is within ``relative_error`` of each share of the rows."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    return df.agg(F.percentile_approx(value_col, list(probabilities), accuracy).alias("cuts"))


def quantile_bins_approx(df: DataFrame, value_col: str, out_col: str,
                         probabilities: Sequence[float] = tuple(i / 10 for i in range(1, 10)),
                         relative_error: float = 0.01) -> DataFrame:
    """D-26 (approximate): cut points from a mergeable quantile sketch."""
    cuts = approx_cut_points(df, value_col, probabilities, relative_error)
    return attach_scalars(df, cuts).withColumn(
        out_col, _bin_label(F.col(value_col), F.col("cuts"))).drop("cuts")

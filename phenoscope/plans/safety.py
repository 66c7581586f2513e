"""End-to-end plans: from input roles to the comparison frame and its evaluation.

``Inputs`` bundles the input frames; ``SafetyPlan`` composes the operators.
Jobs run where a frame is written that later steps read more than once (lookups,
count tables, cut points, shared frames), and when ``inputs_from_release`` reads the
small toxicity-class vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.functions import constants as K
from phenoscope.operators import compare, doe, evaluate, flags, nested, scoring, severity
from phenoscope.sources import readers
from phenoscope.sources import testbed as TB
from phenoscope.store import bucketed, written


@dataclass
class Inputs:
    """The input frames; ``evidence`` may be a function, called when it is first needed.

    The function is given a filter, and may apply it before it joins or stores anything.
    """

    evidence: DataFrame | Callable[[Callable[[DataFrame], DataFrame]], DataFrame]
    targets: DataFrame
    moa: DataFrame
    phenotypes: DataFrame
    warnings: DataFrame
    approvals: DataFrame
    weights: DataFrame
    toxicity_classes: tuple[str, ...]

    @classmethod
    def from_testbed(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        return cls(
            evidence=lambda keep: TB.stored_evidence(spark, sf_dir, keep),
            targets=TB.targets(spark, sf_dir),
            moa=TB.mechanism_of_action(spark, sf_dir),
            phenotypes=TB.mouse_phenotypes(spark, sf_dir),
            warnings=TB.drug_warnings(spark, sf_dir),
            approvals=TB.approvals(spark, sf_dir),
            weights=readers.curated_phenotype_weights(spark),
            toxicity_classes=TB.TOXICITY_CLASSES,
        )


def inputs_from_release(spark: SparkSession, root: str, release: str, approvals_csv: str,
                        weights_csv: str | None = None,
                        toxicity_classes: tuple[str, ...] | None = None, max_classes: int = 200) -> Inputs:
    """Inputs read from a data release laid out as ``<root>/<release>/output/etl/parquet/<dataset>``.

    ``weights_csv`` overrides the shipped curated phenotype weights. The
    toxicity classes name the warning flag columns; when not given they are the
    ``max_classes`` most frequent classes of the warnings table. Any other class
    sets the ``other`` columns, and the long form ``flags.warning_classes`` has all.
    """
    def path(dataset: str) -> str:
        return readers.release_path(root, release, dataset)

    warnings = readers.read_drug_warnings(spark, path("drugWarnings"))
    if toxicity_classes is None:
        sizes = warnings.groupBy(F.coalesce("toxicityClass", F.lit("unknown")).alias("c")).agg(F.count(F.lit(1)).alias("n"))
        toxicity_classes = tuple(sorted(r.c for r in sizes.orderBy(F.desc("n"), "c").limit(max_classes).collect()))
    weights = (readers.read_phenotype_weights_csv(spark, weights_csv) if weights_csv
               else readers.curated_phenotype_weights(spark))
    return Inputs(
        evidence=readers.read_evidence(spark, path("evidence")),
        targets=readers.read_targets(spark, path("targets")),
        moa=readers.read_mechanism_of_action(spark, path("mechanismOfAction")),
        phenotypes=readers.read_mouse_phenotypes(spark, path("mousePhenotypes")),
        warnings=warnings,
        approvals=readers.read_approvals_csv(spark, approvals_csv),
        weights=weights,
        toxicity_classes=toxicity_classes,
    )


class SafetyPlan:
    """Lazily built frames of the analysis; each property is one lazy plan.

    With ``share`` the evidence summary is written once (``shared_summary``) and
    every consumer reads that, and the feature frames are stored in buckets of
    the target id, so that the joins of the comparison need no exchange.

    ``sources`` names the evidence sources whose cells the caller reads, by default all of D-01
    (``doe.rows_behind``): ``FEATURE_SOURCES`` for the warnings and features, ``CLASS_SOURCES`` for the disease classes.
    """

    FEATURE_SOURCES = (flags.DRUG_SOURCE,)
    CLASS_SOURCES = severity.CLASS_SOURCES
    MODEL_SOURCES = severity.CLASS_SOURCES + (severity.MODEL_SOURCE,)

    SCORES = ("harmonicSumNorm", "dis1HarmSumNorm", "dis2HarmSumNorm")

    def __init__(self, inputs: Inputs, share: bool = False, sources: Sequence[str] = K.EVIDENCE_SOURCES):
        self.i = inputs
        self.share = share
        self.sources = tuple(sources)

    @cached_property
    def evidence(self) -> DataFrame:
        def keep(rows: DataFrame) -> DataFrame:
            return doe.rows_behind(rows, self.sources)
        return self.i.evidence(keep) if callable(self.i.evidence) else keep(self.i.evidence)

    def kept(self, df: DataFrame, key: str = "id") -> DataFrame:
        """A frame keyed by target: stored in buckets of the key with ``share``, else as it is."""
        return bucketed(df, key) if self.share else df

    @property
    def cells(self) -> DataFrame:
        return self.shared_summary if self.share else self.summary

    @cached_property
    def assessment(self) -> DataFrame:
        return doe.direction_of_effect(self.evidence, self.i.targets, self.i.moa, onco_sources=(doe.CENSUS,))

    @cached_property
    def summary(self) -> DataFrame:
        """The assessment counted per (source, target, disease, drug, cell).

        Consumers inside one plan do not share it: the optimizer pushes each one's
        filter into the aggregate. A plan with several consumers reads
        ``shared_summary``.
        """
        return doe.assessment_summary(self.assessment)

    @cached_property
    def shared_summary(self) -> DataFrame:
        """The rows of ``summary`` that drug pairs and disease classes read, written once.

        One pass over the evidence evaluates the label rules; the written rows
        are the few cells that any consumer keeps.
        """
        return written(self.summary.filter(F.col("homogenized").isin("LoF_protect", "LoF_risk")))

    @cached_property
    def phenotype_scores(self) -> DataFrame:
        """(id, scores, harmonicSum, harmonicSumNorm) from curated class weights."""
        lists = scoring.score_lists(self.i.phenotypes, self.i.weights)
        return self.kept(scoring.with_harmonic(lists).withColumnRenamed("targetFromSourceId", "id"))

    @cached_property
    def warning_flags(self) -> DataFrame:
        """D-21..D-24: LoF drugs -> their warnings -> per-class flags -> combined."""
        pairs = flags.drugs_by_effect(self.cells, count_col="n")
        target_warnings = nested.attach_warnings(pairs, self.i.warnings)
        bbw = flags.warning_flags(target_warnings, K.BLACK_BOX_WARNING, "_BBW", self.i.toxicity_classes)
        wd = flags.warning_flags(target_warnings, K.WITHDRAWN, "_WD", self.i.toxicity_classes)
        return flags.combine_flags(wd, bbw).withColumnRenamed("targetId", "id")

    @cached_property
    def features(self) -> DataFrame:
        """The scores and every feature of a target, side by side."""
        features = [
            nested.lof_tolerance(self.i.targets),
            nested.liability_count(self.i.targets, K.LIABILITY_EXCLUDED, "safetyLiabl"),
            nested.liability_count(self.i.targets, K.LIABILITY_EXCLUDED_STRICT, "noToxCast"),
            nested.list_flag(self.i.approvals, "targetIds"),
            self.warning_flags,
        ]
        frame = compare.comparison_frame(
            self.phenotype_scores.select("id", "harmonicSum", "harmonicSumNorm"), [self.kept(f) for f in features])
        return flags.presence_flags(frame, {"safetyLiabl": "safetyLiabilities", "noToxCast": "noToxCastLiab"})

    @cached_property
    def comparison(self) -> DataFrame:
        """D-25, with the deciles of the scores.

        The joins keep every score once, so the cut points are those of the scores
        alone: they come from the scores' counts and are constants here, and the
        evidence is read as often as without them.
        """
        # rounded, so that equal scores cannot fall on two sides of a cut point
        rounded = F.round("harmonicSumNorm", 9)
        bins = scoring.quantile_bins(self.features.withColumn("_x", rounded), "_x", "decilesHarmonicSumNorm",
                                     scores=self.phenotype_scores.select(rounded.alias("_x")))
        return bins.drop("_x")

    @cached_property
    def disease_types(self) -> DataFrame:
        return severity.disease_types(self.cells, count_col="n")

    @cached_property
    def severity_scores(self) -> DataFrame:
        """(id, dis1HarmSumNorm, dis2HarmSumNorm) for targets with either score."""
        t = severity.target_severity(self.disease_types)
        per_label = severity.phenotype_severity(self.i.phenotypes, t)
        dis1 = severity.severity_by_target(self.i.phenotypes, per_label).select("id", "dis1HarmSumNorm")
        dis2 = severity.evidence_severity(self.evidence, self.disease_types, self.i.phenotypes) \
            .select("id", "dis2HarmSumNorm")
        return self.kept(dis1.join(dis2, "id", "full_outer"))

    @cached_property
    def full_comparison(self) -> DataFrame:
        return self.comparison.join(self.severity_scores, "id", "left")

    def flag_columns(self) -> list[str]:
        """The columns that ``binarised`` turns into 0/1."""
        classes = self.i.toxicity_classes
        return ["safetyLiabl", "noToxCast", "approved", "any_warning",
                *flags.warning_columns(classes, "_BBW"), *flags.warning_columns(classes, "_WD")]

    def scored(self, frame: DataFrame) -> DataFrame:
        """The rows of ``binarised`` with both severity scores."""
        return frame.filter(F.col("dis1HarmSumNorm").isNotNull() & F.col("dis2HarmSumNorm").isNotNull())

    @cached_property
    def binarised(self) -> DataFrame:
        """The features and severities with 0/1 flags (without the deciles, which no outcome needs)."""
        return flags.binarise(self.features.join(self.severity_scores, "id", "left"), self.flag_columns())

    def predictor_auc(self, seed: int = 0, job_sizes: bool = False) -> DataFrame:
        """AUC of the three scores for liabilities, black-box warnings, withdrawals.

        With ``job_sizes`` the negatives for a warning are as many as its positives
        among the targets with a liability, as in the analysed job; otherwise as
        many as all its positives.

        The per-target frame is written first (one job), since each of the
        three outcomes samples it.
        """
        frame = written(self.binarised.select("id", "safetyLiabl", "allBBW", "allWD", *self.SCORES))
        liable = self.scored(frame).filter(F.col("safetyLiabl") == 1)
        sizes = {c: liable.agg(F.count_if(F.col(c) == 1)) for c in ("allBBW", "allWD")} if job_sizes else None
        return evaluate.auc_grid(frame, ["safetyLiabl", "allBBW", "allWD"], self.SCORES, "id", seed, negatives=sizes)

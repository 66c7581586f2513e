"""The registered queries: one per operator, each over the whole test tables.

Every callable takes (spark, sf_dir) and returns a lazy DataFrame whose
columns are flat and named like the DuckDB formulation in ``oracle_sql``.
Doubles are rounded to 6 places on both sides; arrays are returned as
sizes, sums or sorted joined text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.functions import constants as K
from phenoscope.functions import harmonic as H
from phenoscope.operators import doe, evaluate, flags, model, nested, scoring, severity
from phenoscope.plans.safety import Inputs, SafetyPlan
from phenoscope.sources import readers
from phenoscope.sources import testbed as TB
from phenoscope.store import shared_folder, written

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return register


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# scores per target
# ---------------------------------------------------------------------------
@query("curated_scores")
def q_curated_scores(spark: SparkSession, sf: str) -> DataFrame:
    """D-14: the weight table with the number of phenotype rows using each class."""
    weights = readers.curated_phenotype_weights(spark)
    uses = (TB.mouse_phenotypes(spark, sf)
            .select(F.explode(F.col("modelPhenotypeClasses.id")).alias("classId"))
            .groupBy("classId").agg(F.count(F.lit(1)).alias("n_uses")))
    return (weights.join(uses, weights.idLabel == uses.classId, "left")
            .select("idLabel", "phenoLabel", "curatedScore",
                    F.coalesce(F.col("n_uses"), F.lit(0)).alias("n_uses")))


def _phenotype_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_lists(TB.mouse_phenotypes(spark, sf), readers.curated_phenotype_weights(spark))


@query("score_lists")
def q_score_lists(spark: SparkSession, sf: str) -> DataFrame:
    """D-15: per target, the number, sum and distinct count of class weights."""
    lists = _phenotype_scores(spark, sf)
    return lists.select(
        "targetFromSourceId",
        H.multiset_count(F.col("scores")).alias("n_scores"),
        r6(H.multiset_sum(F.col("scores"))).alias("sum_scores"),
        F.size("scores").alias("n_distinct"))


@query("harmonic_sum")
def q_harmonic_sum(spark: SparkSession, sf: str) -> DataFrame:
    """D-16/D-17: harmonic sum of the class weights per target, and its norm."""
    scored = scoring.with_harmonic(_phenotype_scores(spark, sf))
    return scored.select(
        "targetFromSourceId",
        H.multiset_count(F.col("scores")).alias("n_scores"),
        r6(F.col("harmonicSum")).alias("harmonicSum"),
        r6(F.col("harmonicSumNorm")).alias("harmonicSumNorm"))


@query("harmonic_norm")
def q_harmonic_norm(spark: SparkSession, sf: str) -> DataFrame:
    """D-17: the harmonic sum over the fixed normaliser, per target."""
    scored = scoring.with_harmonic(_phenotype_scores(spark, sf))
    return scored.select("targetFromSourceId", r6(F.col("harmonicSumNorm")).alias("harmonicSumNorm"))


def _plan(spark: SparkSession, sf: str, share: bool = False, sources: Sequence[str] = K.EVIDENCE_SOURCES):
    return SafetyPlan(Inputs.from_testbed(spark, sf), share, sources)


def joined(c):
    return F.concat_ws(",", c)


@query("max_harmonic")
def q_max_harmonic(spark: SparkSession, sf: str) -> DataFrame:
    """D-18: largest possible harmonic sum for each target's number of scores."""
    lists = _phenotype_scores(spark, sf)
    n = H.multiset_count(F.col("scores"))
    return lists.select("targetFromSourceId", n.alias("n_scores"),
                        r6(H.max_harmonic(n)).alias("maxHarmonicSum"))


@query("scaled_harmonic")
def q_scaled_harmonic(spark: SparkSession, sf: str) -> DataFrame:
    """D-19: harmonic sum over the global maximum, negated."""
    out = scoring.scaled_harmonic(_phenotype_scores(spark, sf))
    return out.select("targetFromSourceId", r6(F.col("harmonicSum")).alias("harmonicSum"),
                      r6(F.col("maximum")).alias("maximum"),
                      r6(F.col("scaledHarmonicSum")).alias("scaledHarmonicSum"))


# ---------------------------------------------------------------------------
# target features
# ---------------------------------------------------------------------------
@query("liability_sources")
def q_liability_sources(spark: SparkSession, sf: str) -> DataFrame:
    return nested.liability_sources(TB.targets(spark, sf))


@query("liability_count")
def q_liability_count(spark: SparkSession, sf: str) -> DataFrame:
    return nested.liability_count(TB.targets(spark, sf))


@query("liability_count_strict")
def q_liability_count_strict(spark: SparkSession, sf: str) -> DataFrame:
    return nested.liability_count(TB.targets(spark, sf), K.LIABILITY_EXCLUDED_STRICT, "noToxCast")


@query("constraint_lof")
def q_constraint_lof(spark: SparkSession, sf: str) -> DataFrame:
    lof = nested.constraint_lof(TB.targets(spark, sf))
    return lof.select("id", "upperRank", r6(F.col("oe")).alias("oe"),
                      r6(F.col("scoreConstraint")).alias("scoreConstraint"))


@query("minmax_scale")
def q_minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    tol = nested.lof_tolerance(TB.targets(spark, sf))
    return tol.select("id", r6(F.col("cal_score")).alias("cal_score"), "constraintType")


@query("list_flag")
def q_list_flag(spark: SparkSession, sf: str) -> DataFrame:
    return nested.list_flag(TB.approvals(spark, sf), "targetIds")


# ---------------------------------------------------------------------------
# direction of effect
# ---------------------------------------------------------------------------
@query("filter_sources")
def q_filter_sources(spark: SparkSession, sf: str) -> DataFrame:
    kept = doe.filter_sources(TB.evidence(spark, sf))
    return kept.groupBy("datasourceId").agg(F.count(F.lit(1)).alias("n_rows"))


@query("action_types")
def q_action_types(spark: SparkSession, sf: str) -> DataFrame:
    at = doe.action_types(TB.mechanism_of_action(spark, sf))
    return at.select(F.col("targetId").alias("targetId2"), F.col("drugId").alias("drugId2"), joined(F.col("actionType")).alias("actionTypes"),
                     F.size("actionType").alias("n_actions"))


@query("onco_label")
def q_onco_label(spark: SparkSession, sf: str) -> DataFrame:
    lab = doe.onco_label(TB.targets(spark, sf))
    return lab.select("target_id", "approvedSymbol", joined(F.col("description")).alias("descriptions"),
                      "TSorOncogene")


@query("gof_lof_samples")
def q_gof_lof_samples(spark: SparkSession, sf: str) -> DataFrame:
    ev = doe.with_intogen_labels(doe.filter_sources(TB.stored_evidence(spark, sf, doe.filter_sources)))
    return (ev.filter(F.col("datasourceId") == "intogen")
            .groupBy("targetId", "diseaseId", "intogen_function", "intogenAnnot")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _assessment(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).assessment


@query("variant_effect")
def q_variant_effect(spark: SparkSession, sf: str) -> DataFrame:
    a = _assessment(spark, sf)
    return a.select("datasourceId", "targetId", "diseaseId", "drugId", "variantFunctionalConsequenceId",
                    "variantFunctionalConsequenceFromQtlId", "variantEffect")


@query("direction_on_trait")
def q_direction_on_trait(spark: SparkSession, sf: str) -> DataFrame:
    a = _assessment(spark, sf)
    return a.select("datasourceId", "targetId", "diseaseId", r6(F.col("beta")).alias("beta"),
                    r6(F.col("oddsRatio")).alias("oddsRatio"),
                    joined(F.col("clinicalSignificances")).alias("significances"), "directionOnTrait")


@query("homogenized")
def q_homogenized(spark: SparkSession, sf: str) -> DataFrame:
    a = _assessment(spark, sf)
    return a.groupBy("variantEffect", "directionOnTrait", "homogenized").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("direction_of_effect")
def q_direction_of_effect(spark: SparkSession, sf: str) -> DataFrame:
    a = _assessment(spark, sf)
    return a.groupBy("datasourceId", "variantEffect", "directionOnTrait", "homogenized").agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("coherency")
def q_coherency(spark: SparkSession, sf: str) -> DataFrame:
    wide = doe.agreement_counts(_plan(spark, sf).summary, ["targetId", "diseaseId"], count_col="n")
    return doe.coherency(wide)


# ---------------------------------------------------------------------------
# warnings and flags
# ---------------------------------------------------------------------------
@query("drugs_by_effect")
def q_drugs_by_effect(spark: SparkSession, sf: str) -> DataFrame:
    return flags.drugs_by_effect(_plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).summary, count_col="n")


@query("attach_warnings")
def q_attach_warnings(spark: SparkSession, sf: str) -> DataFrame:
    pairs = flags.drugs_by_effect(_plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).summary, count_col="n")
    return nested.attach_warnings(pairs, TB.drug_warnings(spark, sf))


@query("warning_flags")
def q_warning_flags(spark: SparkSession, sf: str) -> DataFrame:
    pairs = flags.drugs_by_effect(_plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).summary, count_col="n")
    tw = nested.attach_warnings(pairs, TB.drug_warnings(spark, sf))
    return flags.warning_flags(tw, K.BLACK_BOX_WARNING, "_BBW", TB.TOXICITY_CLASSES)


@query("warning_classes")
def q_warning_classes(spark: SparkSession, sf: str) -> DataFrame:
    """D-23 (long form): every class of every target's warnings."""
    pairs = flags.drugs_by_effect(_plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).summary, count_col="n")
    return flags.warning_classes(nested.attach_warnings(pairs, TB.drug_warnings(spark, sf)))


@query("combine_flags")
def q_combine_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).warning_flags


@query("comparison_frame")
def q_comparison_frame(spark: SparkSession, sf: str) -> DataFrame:
    frame = _plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).comparison
    cols = [r6(F.col(c)).alias(c) if c in ("harmonicSum", "harmonicSumNorm", "cal_score") else F.col(c)
            for c in frame.columns]
    return frame.select(*cols)


@query("presence_flags")
def q_presence_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES).features.select("id", "safetyLiabilities", "noToxCastLiab")


def _rounded_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).phenotype_scores.select("id", r6(F.col("harmonicSumNorm")).alias("harmonicSumNorm"))


@query("quantile_bins")
def q_quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    """D-26 exact deciles of the (rounded) normalised harmonic sum."""
    return scoring.quantile_bins(_rounded_scores(spark, sf), "harmonicSumNorm", "decilesHarmonicSumNorm")


@query("quantile_bins_approx")
def q_quantile_bins_approx(spark: SparkSession, sf: str) -> DataFrame:
    """D-26 with approximate cut points: whether each one's rank is within 0.01 of its share."""
    from phenoscope.operators.ordered import attach_scalars
    scores = _rounded_scores(spark, sf)
    cuts = scoring.approx_cut_points(scores, "harmonicSumNorm")
    ranked = attach_scalars(scores.filter(F.col("harmonicSumNorm").isNotNull()), cuts).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("harmonicSumNorm") < F.col("cuts")[j]).alias(f"lo{j}") for j in range(9)],
        *[F.count_if(F.col("harmonicSumNorm") <= F.col("cuts")[j]).alias(f"hi{j}") for j in range(9)])
    rows = [F.struct(F.lit(j + 1).alias("cut"), (
        (F.col(f"lo{j}") <= (0.1 * (j + 1) + 0.01) * F.col("n")) & (F.col(f"hi{j}") >= (0.1 * (j + 1) - 0.01) * F.col("n")))
        .alias("within")) for j in range(9)]
    return ranked.select(F.explode(F.array(*rows)).alias("r")).select("r.cut", "r.within")


@query("binarise")
def q_binarise(spark: SparkSession, sf: str) -> DataFrame:
    p = _plan(spark, sf, sources=SafetyPlan.FEATURE_SOURCES)
    return flags.binarise(p.features, p.flag_columns()).select("id", *p.flag_columns())


# ---------------------------------------------------------------------------
# severity
# ---------------------------------------------------------------------------
@query("disease_types")
def q_disease_types(spark: SparkSession, sf: str) -> DataFrame:
    t = _plan(spark, sf, sources=SafetyPlan.CLASS_SOURCES).disease_types
    return t.select("targetId", "diseaseId", "nr", joined(F.col("diseaseType")).alias("diseaseType"), "bivalent")


@query("target_severity")
def q_target_severity(spark: SparkSession, sf: str) -> DataFrame:
    t = severity.target_severity(_plan(spark, sf, sources=SafetyPlan.CLASS_SOURCES).disease_types)
    return t.select("targetId", joined(F.col("diseaseType")).alias("diseaseType"), "scoreFromDisease")


def _phenotype_severity(spark: SparkSession, sf: str):
    p = _plan(spark, sf, sources=SafetyPlan.CLASS_SOURCES)
    return p, severity.phenotype_severity(p.i.phenotypes, severity.target_severity(p.disease_types))


@query("phenotype_severity")
def q_phenotype_severity(spark: SparkSession, sf: str) -> DataFrame:
    _, ps = _phenotype_severity(spark, sf)
    return ps.select("modelPhenotypeLabel", joined(F.col("diseaseType")).alias("diseaseType"), "scoreFromDisease")


@query("severity_by_target")
def q_severity_by_target(spark: SparkSession, sf: str) -> DataFrame:
    p, ps = _phenotype_severity(spark, sf)
    out = severity.severity_by_target(p.i.phenotypes, ps)
    return out.select("id", H.multiset_count(F.col("scoreDiseases1")).alias("n_scores"),
                      r6(F.col("harmonicSum")).alias("harmonicSum"),
                      r6(F.col("dis1HarmSumNorm")).alias("dis1HarmSumNorm"))


@query("evidence_phenotype_scores")
def q_evidence_phenotype_scores(spark: SparkSession, sf: str) -> DataFrame:
    p = _plan(spark, sf, sources=SafetyPlan.MODEL_SOURCES)
    out = severity.evidence_phenotype_scores(p.evidence, p.disease_types)
    return out.select(F.col("phenotype.id").alias("phenotypeId"), F.col("phenotype.label").alias("phenotypeLabel"),
                      "NrScores", r6(F.col("average")).alias("average"))


@query("evidence_severity")
def q_evidence_severity(spark: SparkSession, sf: str) -> DataFrame:
    p = _plan(spark, sf, sources=SafetyPlan.MODEL_SOURCES)
    out = severity.evidence_severity(p.evidence, p.disease_types, p.i.phenotypes)
    return out.select("id", H.multiset_count(F.col("scoreDiseases2")).alias("n_scores"),
                      r6(F.col("harmonicSum")).alias("harmonicSum"),
                      r6(F.col("dis2HarmSumNorm")).alias("dis2HarmSumNorm"))


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------
@query("balanced_sample")
def q_balanced_sample(spark: SparkSession, sf: str) -> DataFrame:
    docs = TB.labelled_documents(spark, sf)
    return evaluate.balanced_sample(docs, "y", "id", seed=0).select("id", "y")


@query("roc_curve")
def q_roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    roc = evaluate.roc_curve(TB.labelled_documents(spark, sf), "y", "score")
    return roc.select("threshold", "tp", "fp", r6(F.col("tpr")).alias("tpr"), r6(F.col("fpr")).alias("fpr"))


@query("roc_auc")
def q_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    auc = evaluate.roc_auc(TB.labelled_documents(spark, sf), "y", "score")
    return auc.select(r6(F.col("auc")).alias("auc"), "n_pos", "n_neg")


@query("auc_grid")
def q_auc_grid(spark: SparkSession, sf: str) -> DataFrame:
    # every label's sample and every AUC step re-reads the input: cut it once
    docs = written(TB.labelled_documents(spark, sf))
    grid = evaluate.auc_grid(docs, ["y", "y2"], ["score", "score2"], "id", seed=0)
    return grid.select("label", "predictor", r6(F.col("auc")).alias("auc"), "n")


@query("feature_counts")
def q_feature_counts(spark: SparkSession, sf: str) -> DataFrame:
    """D-43: the counts of the job: warnings among liable targets with both severities, and missing severities."""
    p = _plan(spark, sf, share=True)
    liable = F.col("dis1HarmSumNorm").isNotNull() & F.col("dis2HarmSumNorm").isNotNull() & (F.col("safetyLiabl") == 1)
    return evaluate.feature_counts(p.binarised, ["allBBW", "allWD"], ["dis2HarmSumNorm", "cal_score"], liable)


@query("phenotype_matrix")
def q_phenotype_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return flags.phenotype_matrix(TB.mouse_phenotypes(spark, sf))


@query("phenotype_matrix_wide")
def q_phenotype_matrix_wide(spark: SparkSession, sf: str) -> DataFrame:
    """D-38 (wide): one 0/1 column per given phenotype label, one row per target."""
    return flags.phenotype_matrix_wide(TB.mouse_phenotypes(spark, sf), PHENOTYPE_LABELS)


@query("split_train_test")
def q_split_train_test(spark: SparkSession, sf: str) -> DataFrame:
    docs = TB.labelled_documents(spark, sf).select("id", "y")
    train, test = model.split_train_test(docs, "id", seed=2020)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _svm_inputs(spark: SparkSession, sf: str):
    """Per target: y = withdrawn-drug flag; features = its phenotype labels."""
    p = _plan(spark, sf, share=True, sources=SafetyPlan.FEATURE_SOURCES)
    scored = written(p.features.select("id", "harmonicSumNorm", "allWD"))
    labelled = evaluate.balanced_sample(scored.filter(F.col("harmonicSumNorm").isNotNull()), "allWD", "id", seed=0)
    return written(model.feature_frame(labelled.select("id", "y"), flags.phenotype_matrix(p.i.phenotypes)))


# the labels that the wide form of the test data is asked for
PHENOTYPE_LABELS = tuple(f"{kind} {k}" for kind in ("click", "error", "purchase", "signup", "view")
                         for k in range(12))


@query("assemble_features")
def q_assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    """D-39: id, y, label index and the names behind the ones of the feature vector."""
    from pyspark.ml import Pipeline
    frame = _svm_inputs(spark, sf)
    fitted = Pipeline(stages=model.feature_stages(frame)).fit(frame)
    present = model.present_labels(fitted.stages[-1].vocabulary)
    return fitted.transform(frame).select("id", "y", model.LABEL, joined(present).alias("features"))


@query("linear_svm")
def q_linear_svm(spark: SparkSession, sf: str) -> DataFrame:
    """D-41: the test rows, and whether each prediction is a class."""
    train, test = model.split_train_test(_svm_inputs(spark, sf), "id", seed=2020)
    fitted = model.linear_svm(train)
    return fitted.transform(test).select("id", "y", F.col("prediction").isin(0.0, 1.0).alias("is_class"))


@query("classifier_metrics")
def q_classifier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """D-42: whether every metric agrees with the one from confusion counts and ranks."""
    train, test = model.split_train_test(_svm_inputs(spark, sf), "id", seed=2020)
    scored = written(model.linear_svm(train).transform(test))
    found, counted = model.classifier_metrics(scored), model.counted_metrics(scored)
    return spark.createDataFrame([(m, abs(v - counted[m]) < 1e-9) for m, v in found.items()], "metric string, agrees boolean")


@query("harmonic_ranked")
def q_harmonic_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """D-16 for scores without a bound on their distinct values: document sizes per source."""
    docs = TB.table(spark, sf, "documents").select("source", F.col("n_chars").cast("double").alias("score"))
    out = scoring.harmonic_ranked(docs, ["source"], "score")
    return out.select("source", "n_scores", F.round("harmonicSum", 3).alias("harmonicSum"))


@query("text_numbers")
def q_text_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """O-42: text to double over every word of every whole text; what is no number becomes null and is left out."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # the casts of engines differ in words like "nan", "inf" and "1d"
    plain = lambda w: F.when(w.rlike(r"^[+-]?[0-9]{1,15}([.][0-9]{1,9})?$"), w).try_cast("double")
    numbers = F.filter(F.transform("words", plain), lambda x: x.isNotNull())
    docs = TB.table(spark, sf, "documents").select("doc_id", words.alias("words"))
    return docs.select("doc_id", F.size("words").alias("n_words"), numbers.alias("numbers")).select(
        "doc_id", "n_words", F.size("numbers").alias("n_numbers"), F.array_min("numbers").alias("least"), F.array_max("numbers").alias("most"))


@query("csv_columns")
def q_csv_columns(spark: SparkSession, sf: str) -> DataFrame:
    """O-02: whole tables written as CSV and read by header; texts hold separators, quotes and line ends."""
    docs, path = TB.table(spark, sf, "documents"), shared_folder(spark)
    readers.write_csv(docs.select("lang", "text", "doc_id", "source", "n_chars"), path)
    rows = readers.read_csv(spark, path, ["doc_id", "text", "n_chars"], malformed="_bad", multi_line=True)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").cast("long").alias("size"), F.md5("text").alias("digest"),
                       F.col("n_chars").try_cast("long").alias("n_chars"), F.col("_bad").isNull().alias("whole"))


@query("grouped_auc")
def q_grouped_auc(spark: SparkSession, sf: str) -> DataFrame:
    """D-36 by group, one of them null: AUC of the document size per language, English taken as null."""
    docs = TB.table(spark, sf, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"), "n_chars")
    rows = docs.join(TB.table(spark, sf, "labels"), "doc_id")
    auc = evaluate.roc_auc(rows, "quality", "n_chars", ["lang"])
    return auc.select("lang", r6(F.col("auc")).alias("auc"), "n_pos", "n_neg")


@query("tied_sample")
def q_tied_sample(spark: SparkSession, sf: str) -> DataFrame:
    """D-34 with repeated keys: the number of negatives kept is exact (lineitem by order key)."""
    li = TB.table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") == 1).cast("int").alias("y0"))
    return evaluate.balanced_sample(li, "y0", "l_orderkey", seed=1).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("predictor_auc_sized")
def q_predictor_auc_sized(spark: SparkSession, sf: str) -> DataFrame:
    """The whole analysis with the analysed job's own sample sizes."""
    grid = _plan(spark, sf, share=True).predictor_auc(seed=0, job_sizes=True)
    return grid.select("label", "predictor", r6(F.col("auc")).alias("auc"), "n")


@query("predictor_auc")
def q_predictor_auc(spark: SparkSession, sf: str) -> DataFrame:
    """The whole analysis: AUC of the three target scores for three safety outcomes."""
    grid = _plan(spark, sf, share=True).predictor_auc(seed=0)
    return grid.select("label", "predictor", r6(F.col("auc")).alias("auc"), "n")

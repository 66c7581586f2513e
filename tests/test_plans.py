"""Plan shape: filters and column pruning reach the parquet scan; the grouped
ROC/AUC plan never gathers everything into one partition."""

import re

from pyspark.sql import functions as F

from phenoscope.operators import doe, evaluate, nested
from phenoscope.sources import readers, schemas


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_line(plan: str) -> str:
    return "\n".join(line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line)


def test_source_filter_and_projection_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "evidence")
    rows = [("eva", "T1", "D1", None, None, None, ["pathogenic"], "SO_0001587", None, None, None),
            ("europepmc", "T2", "D2", None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, schemas.EVIDENCE).write.parquet(path)
    ev = readers.read_evidence(spark, path)
    df = doe.filter_sources(ev).select("targetId", "diseaseId")
    scan = _scan_line(_plan(df))
    assert "PushedFilters" in scan and "datasourceId" in scan.split("PushedFilters")[1]
    read_schema = scan.split("ReadSchema:")[1]
    assert "clinicalSignificances" not in read_schema and "mutatedSamples" not in read_schema
    assert [r.targetId for r in df.collect()] == ["T1"]


def test_nested_fields_pruned(spark, tmp_path):
    path = str(tmp_path / "targets")
    rows = [("T1", "S1", {"attributes": [{"description": "TSG"}]}, [("ToxCast", "e")],
             [("lof", 3, 0.1, 0.2)])]
    spark.createDataFrame(rows, schemas.TARGETS).write.parquet(path)
    targets = readers.read_targets(spark, path)
    onco_scan = _scan_line(_plan(doe.onco_label(targets))).split("ReadSchema:")[1]
    assert "safetyLiabilities" not in onco_scan and "constraint" not in onco_scan
    liab_scan = _scan_line(_plan(nested.liability_count(targets))).split("ReadSchema:")[1]
    assert "hallmarks" not in liab_scan and "constraint" not in liab_scan


def test_grouped_auc_has_no_single_partition_exchange(spark):
    df = spark.range(2000).select(
        F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"),
        (F.col("id") % 97).cast("double").alias("score"), (F.col("id") % 2).alias("grp"))
    plan = _plan(evaluate.roc_auc(df, "y", "score", ["grp"]))
    assert "SinglePartition" not in plan


def test_auc_grid_has_no_exchange_on_label_and_predictor_alone(spark):
    df = spark.range(500).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 97).cast("double").alias("a"),
                                 (F.col("id") % 31).cast("double").alias("b"))
    plan = _plan(evaluate.auc_grid(df, ["y"], ["a", "b"], "id", balanced=False))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    names = [{re.sub("#.*", "", k.strip()) for k in key.split(",")[:-1]} for key in keys]
    assert names and {"label", "predictor"} not in names


def test_only_rows_that_can_match_meet_the_lookups(spark, tmp_path):
    """Rows of other sources stream past both lookups even where these are too large to broadcast."""
    rows = [(s, f"T{i % 3}", f"D{i % 2}", "C1" if s == "chembl" else None, None, None, None, None, None,
             [("SO_0002053",)] if s == "intogen" else None, None) for i, s in enumerate(["eva", "intogen", "chembl", "impc"] * 3)]
    path = str(tmp_path / "evidence")
    frame = spark.createDataFrame(rows, "datasourceId string, targetId string, diseaseId string, drugId string, "
                                  "beta double, oddsRatio double, clinicalSignificances array<string>, variantFunctionalConsequenceId string, "
                                  "variantFunctionalConsequenceFromQtlId string, mutatedSamples array<struct<functionalConsequenceId: string>>, extra string")
    frame.write.partitionBy("datasourceId").parquet(path)
    evidence = spark.read.parquet(path)
    actions = spark.createDataFrame([("T2", "C1", ["INHIBITOR"])], "targetId string, drugId string, actionType array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        labelled = doe.with_intogen_labels(evidence)
        joined = doe.join_where(labelled, F.col("drugId").isNotNull(), actions, {"targetId": "targetId", "drugId": "drugId"})
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert joined.count() == len(rows) and plan.count("Join LeftOuter") == 3
    # the last branch, of rows that meet neither lookup, has no join
    assert "Join" not in plan.split("\n:  ")[-1].split("\n   :- ")[-1].split("\n   +- ")[-1]
    got = {(r.datasourceId, r.targetId, r.intogenAnnot, tuple(r.actionType or ())) for r in joined.collect()}
    assert ("chembl", "T2", 0, ("INHIBITOR",)) in got and all(n == 0 for s, _, n, _ in got if s != "intogen")
    assert {n for s, _, n, _ in got if s == "intogen"} == {1} and all(not a for s, _, _, a in got if s != "chembl")


def test_stored_features_join_without_an_exchange(spark, tmp_path):
    from phenoscope.operators import compare
    from phenoscope.store import bucketed
    frames = [spark.range(300).select(F.concat(F.lit("T"), F.col("id") % (90 + 10 * k)).alias("id"), F.col("id").alias(f"v{k}"))
              .dropDuplicates(["id"]) for k in range(3)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = [bucketed(f, "id") for f in frames]
        joined = compare.comparison_frame(kept[0], kept[1:])
        plan = _plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_deciles_add_no_scan_of_the_evidence(spark):
    from phenoscope.plans.safety import Inputs, SafetyPlan
    plan = SafetyPlan(Inputs.from_testbed(spark, "/root/testdata/sf0.001"))
    with_deciles = plan.comparison._jdf.queryExecution().toString().count("FileScan")
    assert with_deciles == plan.features._jdf.queryExecution().toString().count("FileScan") > 0


ONCO_EVIDENCE = ("datasourceId string, targetId string, diseaseId string, drugId string, beta double, oddsRatio double, "
                 "clinicalSignificances array<string>, variantFunctionalConsequenceId string, variantFunctionalConsequenceFromQtlId string, "
                 "mutatedSamples array<struct<functionalConsequenceId: string>>")


def test_only_rows_that_read_the_onco_label_meet_it(spark):
    """With several symbols to a target, too, the labels are those of the join of all rows."""
    rows = [(s, t, "D1", "C1" if s == "chembl" else None, None, None, None, None, None, None)
            for s in ("eva", "cancer_gene_census", "chembl") for t in ("T1", "T2", "T3", None)]
    evidence = spark.createDataFrame(rows, ONCO_EVIDENCE)
    moa = spark.createDataFrame([(["C1"], ["T1"], "INHIBITOR")], "chemblIds array<string>, targets array<string>, actionType string")
    kind = "id string, approvedSymbol string, hallmarks struct<attributes: array<struct<description: string>>>"
    hall = lambda *names: {"attributes": [{"description": n} for n in names]}
    columns = ["datasourceId", "targetId", "variantEffect", "directionOnTrait", "homogenized"]
    for more in ([], [("T2", "S3", hall("oncogene"))]):
        targets = spark.createDataFrame([("T1", "S1", hall("TSG")), ("T2", "S2", hall("TSG"))] + more, kind)
        whole = doe.direction_of_effect(evidence, targets, moa)
        least = doe.direction_of_effect(evidence, targets, moa, onco_sources=(doe.CENSUS,))
        assert sorted(map(str, least.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
        assert least.count() == len(rows) + 3 * len(more)
    onco = doe.onco_label(targets.limit(2)).select("target_id", "TSorOncogene")
    plan = doe.with_onco_label(evidence.filter("datasourceId != 'cancer_gene_census'"), onco, (doe.CENSUS,))
    assert {r.TSorOncogene for r in plan.collect()} == {None}


def test_evidence_plan_does_not_shuffle_the_evidence_for_the_onco_label(spark):
    from phenoscope.plans.safety import Inputs, SafetyPlan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = SafetyPlan(Inputs.from_testbed(spark, "/root/testdata/sf0.001")).assessment._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the last branch, of rows that meet no lookup, has no join
    assert plan.count("TSorOncogene") and "Join" not in plan.split("Filter")[-1]


def test_rows_among_wanted_keys_are_found_without_a_shuffle(spark):
    from phenoscope.store import among, written
    rows = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("a"), F.nullif(F.col("id") % 7, F.lit(3)).alias("b"), "id")
    wanted = written(rows.filter("id < 100").select("a", "b"))
    near = among(rows, wanted, ["a", "b"])
    exact = lambda df: {r.id for r in df.join(wanted.distinct(), ["a", "b"]).collect()}
    assert exact(near) == exact(rows) and 100 <= near.count() < 3000
    assert near.columns == rows.columns
    assert "hashpartitioning(a" not in _plan(near) and "SortMergeJoin" not in _plan(near)


def test_action_types_of_wanted_pairs_are_those_of_the_whole_table(spark):
    from phenoscope.store import written
    moa = spark.createDataFrame([([f"C{i % 9}"] if i % 10 else None, [f"T{i % 7}", f"T{i % 5}"], ("INHIBITOR", "OPENER", None)[i % 3]) for i in range(300)],
                                "chemblIds array<string>, targets array<string>, actionType string")
    pairs = [("T1", "C1"), ("T1", "C1"), ("T6", "C8"), ("T4", None), (None, "C2"), ("T99", "C1")]
    got = doe.action_types(moa, written(spark.createDataFrame(pairs, "targetId string, drugId string"))).collect()
    whole = [r for r in doe.action_types(moa).collect() if (r.targetId, r.drugId) in {("T1", "C1"), ("T6", "C8")}]
    assert sorted(map(str, got)) == sorted(map(str, whole)) and len(got) == 2


def test_feature_names_unpack_the_vector_once_a_row(spark):
    from pyspark.ml import Pipeline

    from phenoscope.operators import model
    frame = spark.createDataFrame([(1, 0, ["a", "c"]), (2, 1, []), (3, 1, ["b"])], "id long, y int, labels array<string>")
    fitted = Pipeline(stages=model.feature_stages(frame)).fit(frame)
    named = fitted.transform(frame).select("id", model.present_labels(fitted.stages[-1].vocabulary).alias("names"))
    assert {r.id: r.names for r in named.collect()} == {1: ["a", "c"], 2: [], 3: ["b"]}
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" in plan and "UDF" not in "".join(re.findall(r"lambdafunction\(.*?lambda", plan))


def test_few_rows_beside_the_wanted_keys_pass_the_bitmap(spark):
    from phenoscope.store import among, written
    wanted = written(spark.range(40_000).select(F.concat(F.lit("T"), F.col("id")).alias("a")))
    others = spark.range(40_000, 240_000).select(F.concat(F.lit("T"), F.col("id")).alias("a"))
    assert among(others, wanted, ["a"]).count() < 200_000 * 0.025
    assert among(wanted, wanted, ["a"]).count() == 40_000


def test_stored_evidence_holds_the_rows_of_the_sources_that_the_analysis_keeps(spark):
    from phenoscope.functions import constants as K
    from phenoscope.plans.safety import SafetyPlan, Inputs
    from phenoscope.sources import testbed as TB
    sf = "/root/testdata/sf0.001"
    stored, whole = SafetyPlan(Inputs.from_testbed(spark, sf)).evidence, TB.evidence(spark, sf)
    assert {r.datasourceId for r in stored.select("datasourceId").distinct().collect()} <= set(K.EVIDENCE_SOURCES)
    kept = doe.filter_sources(whole).select(*stored.columns)
    assert stored.count() == kept.count() < whole.count() and stored.exceptAll(kept).isEmpty()


def test_direction_is_found_before_rows_are_shuffled_to_a_lookup(spark, monkeypatch):
    evidence = spark.createDataFrame([("eva", "T1", "D1", None, 1.0, None, ["pathogenic"], None, None, None)], ONCO_EVIDENCE)
    moa = spark.createDataFrame([(["C1"], ["T1"], "INHIBITOR")], "chemblIds array<string>, targets array<string>, actionType string")
    targets = spark.createDataFrame([("T1", "S1", None)], "id string, approvedSymbol string, hallmarks struct<attributes: array<struct<description: string>>>")
    join, met = doe.join_where, []
    monkeypatch.setattr(doe, "join_where", lambda df, *more, **named: met.append(df.columns) or join(df, *more, **named))
    got = doe.direction_of_effect(evidence, targets, moa)
    assert len(met) == 2 and all("directionOnTrait" in columns for columns in met)
    assert [r.directionOnTrait for r in got.collect()] == ["risk"]


def test_plans_begin_with_the_rows_behind_the_sources_that_they_read(spark):
    from phenoscope.operators import flags, severity
    from phenoscope.plans.safety import Inputs, SafetyPlan
    plan = lambda **named: SafetyPlan(Inputs.from_testbed(spark, "/root/testdata/sf0.001"), **named)
    whole, drugs = plan(), plan(sources=SafetyPlan.FEATURE_SOURCES)
    assert {r.datasourceId for r in drugs.evidence.select("datasourceId").distinct().collect()} == {flags.DRUG_SOURCE}
    assert drugs.evidence.exceptAll(whole.evidence).isEmpty()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(drugs.warning_flags) == rows(whole.warning_flags) != []
    classes = plan(sources=SafetyPlan.CLASS_SOURCES)
    assert {r.datasourceId for r in classes.evidence.select("datasourceId").distinct().collect()} == set(SafetyPlan.CLASS_SOURCES) - {"genomics_england"}
    assert rows(severity.target_severity(classes.disease_types)) == rows(severity.target_severity(whole.disease_types)) != []


def test_rows_with_samples_stay_behind_intogen(spark):
    sample = [{"functionalConsequenceId": "SO_0002053"}]
    evidence = spark.createDataFrame(
        [(s, n, samples) for n, (s, samples) in enumerate([("intogen", None), ("impc", sample), ("impc", []), ("impc", None), ("europepmc", sample), (None, sample), ("chembl", None)])],
        "datasourceId string, n int, mutatedSamples array<struct<functionalConsequenceId: string>>")
    kept = lambda *sources: sorted(r.n for r in doe.rows_behind(evidence, sources).collect())
    assert kept("intogen") == [0, 1] and kept("chembl") == [6] and kept("impc", "chembl") == [1, 2, 3, 6]
    assert kept(*doe.K.EVIDENCE_SOURCES) == [0, 1, 2, 3, 6]


def test_evidence_code_is_short_enough_to_be_compiled(spark):
    from phenoscope.sources import testbed as TB
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = doe.filter_sources(TB.evidence(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000


def test_options_are_picked_by_key(spark):
    from pyspark.sql import types as T

    from phenoscope.sources import testbed as TB
    got = lambda options, kind: [r.x for r in spark.createDataFrame([(-1,), (0,), (4,), (None,)], "k long").select(
        TB.pick(F.col("k"), options, kind).alias("x")).collect()]
    assert got((None, "a", "b"), T.StringType()) == ["b", None, "a", None]
    assert got(([], None, ["c"]), T.ArrayType(T.StringType())) == [["c"], [], None, None]
    own = TB.RowValue(lambda: F.concat(F.lit("row "), F.col("k")), "")
    assert got(("a", own), T.StringType()) == ["row -1", "a", "a", None]

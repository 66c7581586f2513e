"""Cases off the test tables: ties, null groups, large counts, clashing names, file layouts, checks that fail."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from phenoscope.operators import compare, evaluate, flags, model, scoring, severity
from phenoscope.operators.ordered import hash_first_n
from phenoscope.sources import readers


def test_tied_keys_are_counted_one_by_one(spark):
    df = spark.createDataFrame([(7,)] * 3 + [(None,)], "id long")
    assert hash_first_n(df, "id", 0, 2).count() == 2
    assert hash_first_n(df, "id", 0, 4).count() == 4


def test_hash_first_n_filters_below_the_window(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "id long")
    plan = hash_first_n(df, "id", 0, 5)._jdf.queryExecution().optimizedPlan().toString()
    lines = [x.strip(" :+-") for x in plan.split("\n")]
    window = next(i for i, x in enumerate(lines) if x.startswith("Window"))
    assert any(x.startswith("Filter") and "< 5)" in x for x in lines[window + 1:])


def test_balanced_sample_size_is_a_parameter(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "id long, lab int")
    for n, want in ((3, 3), (spark.range(1).select(F.lit(11)), 11), (None, 20)):
        kept = evaluate.balanced_sample(df, "lab", "id", 0, n).groupBy("y").count()
        assert {r.y: r["count"] for r in kept.collect()} == {1: 20, 0: want}


def test_auc_grid_balanced_with_sizes(spark):
    rows = [(i, int(i % 4 == 0), float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, a double")
    grid = evaluate.auc_grid(df, ["y"], ["a"], "id", negatives={"y": 17}).first()
    assert (grid.n_pos, grid.n_neg) == (50, 17) and 0.0 <= grid.auc <= 1.0


def test_null_groups_are_groups(spark):
    rows = [(g, i % 2, float(i % 7)) for g in ("a", None) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    assert {r.g for r in evaluate.roc_auc(df, "y", "s", ["g"], bucket_rows=4).collect()} == {"a", None}
    assert {r.g for r in evaluate.roc_curve(df, "y", "s", ["g"], bucket_rows=4).collect()} == {"a", None}
    scaled = scoring.minmax_scale(df, "s", "x", ["g"]).groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    assert {(r.g, r.lo, r.hi) for r in scaled.collect()} == {("a", -1.0, 1.0), (None, -1.0, 1.0)}


def test_auc_of_more_rows_than_a_long_product_holds(spark, monkeypatch):
    counts = spark.createDataFrame([(1.0, 4_000_000_000, 0), (0.0, 0, 4_000_000_000)], "threshold double, pos long, neg long")
    monkeypatch.setattr(evaluate, "score_counts", lambda *args: counts)
    assert evaluate.roc_auc(counts, "y", "s", bucket_rows=4).first().auc == 1.0


def test_roc_curve_starts_at_the_origin(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, s double")
    points = sorted((r.threshold, r.tpr, r.fpr) for r in evaluate.roc_curve(df, "y", "s", bucket_rows=4).collect())
    assert points == [(0.1, 1.0, 1.0), (0.9, 1.0, 0.0), (float("inf"), 0.0, 0.0)]


def test_roc_curve_of_no_rows(spark):
    assert evaluate.roc_curve(spark.createDataFrame([], "y int, s double"), "y", "s", bucket_rows=4).collect() == []


WARNINGS = [("T1", "Withdrawn", "cardio tox"), ("T1", "Withdrawn", "new class"), ("T2", "Withdrawn", "cardio.tox"),
            ("T3", "Withdrawn", None), ("T4", "Withdrawn", "CARDIO_TOX"), ("T5", None, "other")]


def test_class_names_do_not_clash_and_no_class_is_lost(spark):
    df = spark.createDataFrame(WARNINGS, "targetId string, warningType string, toxicityClass string")
    wide = flags.warning_flags(df, "Withdrawn", "_WD", ["cardio tox", "cardio.tox", "CARDIO_TOX", "unknown", "other"])
    assert wide.columns == ["targetId", "cardio_tox_WD", "cardio_tox_2_WD", "CARDIO_TOX_3_WD", "unknown_WD", "other_WD", "other_2_WD", "allWD"]
    got = {r[0]: tuple(r)[1:] for r in wide.collect()}
    assert got == {"T1": (1, 0, 0, 0, 0, 1, 1), "T2": (0, 1, 0, 0, 0, 0, 1), "T3": (0, 0, 0, 1, 0, 0, 1), "T4": (0, 0, 1, 0, 0, 0, 1)}
    combined = flags.combine_flags(wide, flags.warning_flags(df, "Withdrawn", "_BBW", ["cardio tox", "cardio.tox"]))
    assert combined.count() == 4
    long = {tuple(r) for r in flags.warning_classes(df).collect()}
    assert ("T1", "Withdrawn", "new class") in long and ("T3", "Withdrawn", "unknown") in long and len(long) == 5


def test_empty_class_list(spark):
    df = spark.createDataFrame(WARNINGS, "targetId string, warningType string, toxicityClass string")
    assert {tuple(r) for r in flags.warning_flags(df, "Withdrawn", "_WD", []).collect()} == {(f"T{i}", 1, 1) for i in range(1, 5)}


def test_binarise_turns_text_into_flags(spark):
    df = spark.createDataFrame([("a", "approved", 3), ("b", None, None)], "id string, approved string, n int")
    assert [(r.approved, r.n) for r in flags.binarise(df, ["approved", "n"]).orderBy("id").collect()] == [(1, 1), (0, 0)]


def test_wide_join_fails_on_repeated_keys(spark):
    scores = spark.createDataFrame([("T1", 1.0)], "id string, s double")
    twice = spark.createDataFrame([("T1", 1), ("T1", 2)], "id string, f int")
    with pytest.raises(PySparkException, match="more than one row for id T1"):
        compare.comparison_frame(scores, [twice]).collect()


def test_csv_columns_are_found_by_header(spark, tmp_path):
    path = tmp_path / "approvals.csv"
    path.write_text(',brandDrugName,targetIds\n0,foo,"T1;T2"\n')
    assert [r.targetIds for r in readers.read_approvals_csv(spark, str(path)).collect()] == ["T1;T2"]
    path.write_text(",brandDrugName\n0,foo\n")
    with pytest.raises(ValueError, match="targetIds"):
        readers.read_approvals_csv(spark, str(path))


def test_weights_with_text_for_a_score_fail(spark, tmp_path):
    path = tmp_path / "weights.csv"
    path.write_text("label,score,id\na,0.5,MP:1\nb,,MP:2\n")
    rows = readers.read_phenotype_weights_csv(spark, str(path)).collect()
    assert {(r.idLabel, r.curatedScore) for r in rows} == {("MP:1", 0.5), ("MP:2", None)}
    path.write_text("label,score,id\na,half,MP:1\n")
    with pytest.raises(PySparkException, match="not a score: half"):
        readers.read_phenotype_weights_csv(spark, str(path)).collect()


def test_cluster_without_a_shared_folder_raises():
    from phenoscope.session import ensure_checkpoint_dir

    class Session:
        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_both_harmonic_forms_agree(spark):
    rows = [(f"T{i % 7}", None if i % 13 == 0 else (i * 37 % 101) / 7.0) for i in range(400)] + [("T9", None)]
    df = spark.createDataFrame(rows, "targetFromSourceId string, s double")
    ranked = {r[0]: r.harmonicSum for r in scoring.harmonic_ranked(df, ["targetFromSourceId"], "s").collect()}
    multiset = scoring.with_harmonic(scoring.score_multiset(df, ["targetFromSourceId"], "s"))
    for r in multiset.collect():
        assert ranked[r[0]] == pytest.approx(r.harmonicSum, rel=1e-12)


def test_phenotype_severity_and_severity_by_target(spark):
    phenotypes = spark.createDataFrame([("T1", "p"), ("T1", "p"), ("T2", "p"), ("T2", "q"), ("T3", "r"), (None, "p")],
                                       "targetFromSourceId string, modelPhenotypeLabel string")
    targets = spark.createDataFrame([("T1", ["common"]), ("T2", ["rare"]), ("T9", ["rare"])], "targetId string, diseaseType array<string>")
    per_label = severity.phenotype_severity(phenotypes, targets)
    assert {(r.modelPhenotypeLabel, r.scoreFromDisease) for r in per_label.collect()} == {("p", 0.6), ("q", 1.0), (None, 1.0)}
    got = {r.id: (r.harmonicSum, [(x.score, x.n) for x in r.scoreDiseases1])
           for r in severity.severity_by_target(phenotypes, per_label).collect()}
    assert got["T1"] == (pytest.approx(0.6 + 0.6 / 4), [(0.6, 2)])
    assert got["T2"] == (pytest.approx(1.0 + 0.6 / 4), [(1.0, 1), (0.6, 1)]) and set(got) == {"T1", "T2"}


def test_phenotype_rows_are_counted_before_the_join(spark):
    phenotypes = spark.createDataFrame([("T1", "p")], "targetFromSourceId string, modelPhenotypeLabel string")
    scores = spark.createDataFrame([("p", 1.0)], "modelPhenotypeLabel string, x double")
    plan = severity.scores_to_targets(phenotypes, scores, "x")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "Aggregate [targetFromSourceId" in plan[join:]


def test_classifier_on_separable_labels(spark):
    labelled = spark.createDataFrame([(f"T{i}", i % 2) for i in range(60)], "id string, y int")
    matrix = spark.createDataFrame([(f"T{i}", "odd" if i % 2 else "even") for i in range(58)] + [("T3", "rare")],
                                   "targetFromSourceId string, modelPhenotypeLabel string")
    frame = model.feature_frame(labelled, matrix)
    assert frame.filter("size(labels) = 0").count() == 2
    fitted = model.linear_svm(frame)
    assert set(fitted.stages[1].vocabulary) == {"odd", "even", "rare"}
    scored = fitted.transform(frame)
    found, counted = model.classifier_metrics(scored), model.counted_metrics(scored)
    assert found["accuracy"] > 0.95
    assert found == pytest.approx(counted)


def test_test_data_tell_rules_apart(spark):
    from phenoscope.plans import catalog
    sf = "/root/testdata/sf0.01"
    q = catalog.registry()
    assert q["phenotype_severity"](spark, sf).select("scoreFromDisease").distinct().count() >= 3
    assert q["evidence_phenotype_scores"](spark, sf).select("average").distinct().count() >= 3
    wide = q["phenotype_matrix_wide"](spark, sf)
    names = [c for c in wide.columns if c != "targetFromSourceId"]
    lows, highs = wide.agg(*[F.min(c) for c in names]).first(), wide.agg(*[F.max(c) for c in names]).first()
    assert set(lows) == {0} and set(highs) == {1}
    rows = [set(r.features.split(",")) for r in q["assemble_features"](spark, sf).collect()]
    assert all(0 < sum(label in r for r in rows) < len(rows) for label in set.union(*rows))


def test_label_rules_run_once_where_consumers_share(spark):
    from phenoscope.plans.safety import Inputs, SafetyPlan
    plan = SafetyPlan(Inputs.from_testbed(spark, "/root/testdata/sf0.001"), share=True).binarised
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString()
    assert "conflict/noEvaluable" not in final  # the rules' text: they ran before, for the written summary


def test_csv_tells_malformed_records(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,x\n2\n3,"y, ""z"""\n4,p,q\n')
    rows = {r.a: (r.b, r.bad) for r in readers.read_csv(spark, str(path), ["a", "b"], malformed="bad").collect()}
    assert rows == {"1": ("x", None), "2": (None, "2"), "3": ('y, "z"', None), "4": ("p", "4,p,q")}
    assert {(r.a, r.b) for r in readers.read_csv(spark, str(path), ["a", "b"]).collect()} == {(a, b) for a, (b, _) in rows.items()}


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "quoted", text\nwith  lines '), (2, "x"), (3, None), (4, " lead\ttab")]
    readers.write_csv(spark.createDataFrame(rows, "k int, t string"), str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out"), ["t", "k"], multi_line=True).collect()
    assert sorted((int(r.k), r.t) for r in back) == rows


def test_configured_folder_comes_before_the_contexts():
    from phenoscope.session import ensure_checkpoint_dir

    class Session:
        conf = {"spark.checkpoint.dir": "/shared"}

        class sparkContext:
            master, given = "spark://host:7077", "file:/own/1"
            getCheckpointDir = classmethod(lambda c: c.given)
            setCheckpointDir = classmethod(lambda c, path: setattr(c, "given", f"file:{path}/2"))

    assert ensure_checkpoint_dir(Session) == "/shared" and Session.sparkContext.given == "file:/shared/2"
    assert ensure_checkpoint_dir(Session) == "file:/shared/2"

"""Nested lookups, warning flags, binarise, severity traps."""

from pyspark.sql import functions as F

from phenoscope.operators import flags, nested, severity
from phenoscope.sources import schemas


def _targets(spark, rows):
    return spark.createDataFrame(rows, schemas.TARGETS)


def test_liability_count_null_semantics(spark):
    rows = [
        ("T1", "s", None, [("ToxCast", "e1"), ("PharmGKB", "e2"), (None, "e3"), ("X", None)], None),
        ("T2", "s", None, [], None),
        ("T3", "s", None, None, None),
        ("T4", "s", None, [("Brennan et al. (2024)", "e")], None),
    ]
    out = {r.id: r.safetyLiabl for r in nested.liability_count(_targets(spark, rows)).collect()}
    assert out == {"T1": 1}          # null source dropped, null event not counted
    src = {r.datasource: r["count"] for r in nested.liability_sources(_targets(spark, rows)).collect()}
    assert src[None] == 3            # the null-source entry, the empty and the null list


def test_constraint_lof_and_tolerance(spark):
    rows = [("T1", "s", None, None, [("syn", 9, 1.0, 0.1), ("lof", 10, 0.2, 0.3)]),
            ("T2", "s", None, None, [("lof", 20, 0.5, 0.6)]),
            ("T3", "s", None, None, None)]
    tol = {r.id: r.cal_score for r in nested.lof_tolerance(_targets(spark, rows)).collect()}
    assert tol == {"T1": -1.0, "T2": 1.0}


def test_list_flag(spark):
    df = spark.createDataFrame([(" A ; B;A ",), ("C",)], "targetIds string")
    got = sorted((r.id, r.approved) for r in nested.list_flag(df, "targetIds").collect())
    assert got == [("A", "approved"), ("B", "approved"), ("C", "approved")]


def test_warning_flags_and_combine(spark):
    tw = spark.createDataFrame([
        ("T1", "D1", 1, "hepatotoxicity", "Black Box Warning"),
        ("T1", "D2", 1, None, "Black Box Warning"),
        ("T2", "D3", 1, "cardiotoxicity", "Withdrawn"),
        ("T3", "D4", 1, None, None),
    ], "targetId string, drugId string, count long, toxicityClass string, warningType string")
    classes = ("unknown", "hepatotoxicity", "cardiotoxicity")
    bbw = flags.warning_flags(tw, "Black Box Warning", "_BBW", classes)
    wd = flags.warning_flags(tw, "Withdrawn", "_WD", classes)
    row = bbw.filter(F.col("targetId") == "T1").first()
    assert (row.unknown_BBW, row.hepatotoxicity_BBW, row.cardiotoxicity_BBW, row.allBBW) == (1, 1, 0, 1)
    both = {r.targetId: r for r in flags.combine_flags(wd, bbw).collect()}
    assert set(both) == {"T1", "T2"}
    assert both["T2"].allBBW == 0 and both["T2"].allWD == 1 and both["T2"].any_warning == 1


def test_binarise(spark):
    df = spark.createDataFrame([(3,), (1,), (0,), (None,)], "c long")
    assert [r.c for r in flags.binarise(df, ["c"]).collect()] == [1, 1, 0, 0]


def test_target_severity_flatten_is_not_distinct(spark):
    types = spark.createDataFrame([
        ("T1", "D1", 1, ["rare"], 1), ("T1", "D2", 1, ["common", "rare"], 2),   # -> 3 entries, no score
        ("T2", "D1", 1, ["common"], 1),
        ("T3", "D1", 1, ["rare"], 1), ("T3", "D2", 1, ["rare"], 1),
        ("T4", "D1", 1, ["common", "rare"], 2),
    ], "targetId string, diseaseId string, nr long, diseaseType array<string>, bivalent int")
    got = {r.targetId: r.scoreFromDisease for r in severity.target_severity(types).collect()}
    assert got == {"T1": None, "T2": 0.25, "T3": 1.0, "T4": 0.7}


def test_evidence_phenotype_scores_reduce_fan_out(spark):
    ev = spark.createDataFrame([
        ("impc", "T9", "D1", [("MP:1", "a")]),
        ("impc", "T9", "D2", [("MP:1", "a")]),
        ("impc", "T9", "D3", [("MP:2", "b")]),
        ("eva", "T9", "D1", [("MP:3", "c")]),
    ], "datasourceId string, targetId string, diseaseId string, "
       "diseaseModelAssociatedModelPhenotypes array<struct<id:string,label:string>>")
    types = spark.createDataFrame([
        ("T1", "D1", 1, ["rare"], 1), ("T2", "D1", 1, ["rare"], 1), ("T3", "D1", 1, ["common"], 1),
        ("T1", "D2", 1, ["common", "rare"], 2),
    ], "targetId string, diseaseId string, nr long, diseaseType array<string>, bivalent int")
    out = {r.phenotype.id: r for r in severity.evidence_phenotype_scores(ev, types).collect()}
    assert out["MP:1"].NrScores == 3                              # 0.2, 0.6, 1.0
    assert abs(out["MP:1"].average - 0.6) < 1e-12
    assert (out["MP:2"].NrScores, out["MP:2"].average) == (1, 0.0)     # disease without LoF-risk evidence scores 0
    assert "MP:3" not in out

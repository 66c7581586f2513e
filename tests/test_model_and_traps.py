
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from phenoscope.operators import compare, model
from phenoscope.sources import schemas


def test_label_index_keeps_one_as_class_one(spark):
    # positives lead: a frequency-ordered indexer would make y=1 class 0 (T12)
    df = spark.createDataFrame([(i, 1, float(i % 3), 1.0) for i in range(30)] +
                               [(100 + i, 0, 0.0, 0.0) for i in range(5)], "id long, y int, a double, b double")
    stages = model.feature_stages(df.withColumn(model.LABELS, F.array(F.lit("x"))))
    out = stages[0].fit(df).transform(df)
    assert {(r.y, r[model.LABEL]) for r in out.select("y", model.LABEL).distinct().collect()} == {(1, 1.0), (0, 0.0)}


def test_feature_frame_fills_missing_features(spark):
    labelled = spark.createDataFrame([("T1", 1), ("T2", 0)], "id string, y int")
    matrix = spark.createDataFrame([("T1", "view"), ("T1", "click")], "targetFromSourceId string, modelPhenotypeLabel string")
    rows = {r.id: r.labels for r in model.feature_frame(labelled, matrix).collect()}
    assert rows == {"T1": ["click", "view"], "T2": []}      # T13: no null reaches the vectors


def test_split_is_stable_and_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    train, test = model.split_train_test(df, "k", seed=2020)
    a = {r.k for r in train.collect()}
    b = {r.k for r in test.collect()}
    assert not (a & b) and len(a | b) == 1000 and 600 < len(a) < 800
    again = {r.k for r in model.split_train_test(df, "k", seed=2020)[0].collect()}
    assert again == a


def test_try_cast_of_raw_text(spark):
    # T16: effect sizes arriving as text: malformed values become null, not an error
    df = spark.createDataFrame([("0.5",), ("n/a",), (None,)], "beta string")
    assert [r.b for r in df.select(F.col("beta").try_cast("double").alias("b")).collect()] == [0.5, None, None]


def test_duplicate_keys_guard(spark):
    # T17: a target with two LoF constraint rows would be repeated by a wide join
    df = spark.createDataFrame([("T1", 1.0), ("T1", 2.0), ("T2", 3.0)], "id string, cal_score double")
    with pytest.raises(Exception, match="more than one row for id T1"):
        compare.unique_by(df).collect()


def test_inputs_from_release(spark, tmp_path):
    from phenoscope.plans.safety import SafetyPlan, inputs_from_release
    root = tmp_path / "rel"
    base = root / "24.09" / "output" / "etl" / "parquet"
    spark.createDataFrame([("chembl", "T1", "D1", "CHEMBL1", None, None, None, None, None, None, None)],
                          schemas.EVIDENCE).write.parquet(str(base / "evidence"))
    spark.createDataFrame([("T1", "S1", None, [("ToxCast", "e")], [("lof", 3, 0.1, 0.2)])],
                          schemas.TARGETS).write.parquet(str(base / "targets"))
    spark.createDataFrame([(["CHEMBL1"], ["T1"], "INHIBITOR", "m")],
                          schemas.MECHANISM_OF_ACTION).write.parquet(str(base / "mechanismOfAction"))
    spark.createDataFrame([("T1", "view", [("MP:0005370",)])],
                          schemas.MOUSE_PHENOTYPES).write.parquet(str(base / "mousePhenotypes"))
    spark.createDataFrame([(["CHEMBL1"], "hepatotoxicity", "Withdrawn")],
                          schemas.DRUG_WARNINGS).write.parquet(str(base / "drugWarnings"))
    approvals = tmp_path / "approvals.csv"
    approvals.write_text(",targetIds\n0,T1\n")
    inputs = inputs_from_release(spark, str(root), "24.09", str(approvals))
    assert inputs.toxicity_classes == ("hepatotoxicity",)
    row = SafetyPlan(inputs).comparison.first()
    assert row.id == "T1" and row.allWD == 1 and row.approved == "approved"
    assert row.harmonicSum == pytest.approx(1.0)


def test_every_label_is_a_feature(spark):
    """More labels than any default vocabulary holds (CountVectorizer's is 262,144 at most frequent); here by a rare one each."""
    from pyspark.ml import Pipeline
    frame = spark.range(300).select("id", (F.col("id") % 2).cast("int").alias("y"),
                                    F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("L"), (F.col("id") * 1000 + k).cast("string"))).alias(model.LABELS))
    assert model.vocabulary_size(frame) == 300_000
    fitted = Pipeline(stages=model.feature_stages(frame)).fit(frame)
    assert len(fitted.stages[-1].vocabulary) == 300_000
    sizes = fitted.transform(frame).select(vector_to_array(model.FEATURES).alias("v")).select(F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("n"))
    assert {r.n for r in sizes.limit(5).collect()} == {1000.0}

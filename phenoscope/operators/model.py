"""Linear classifier on the phenotype matrix (D-39..D-42), with MLlib.

Features are the phenotype labels of a target, turned into a 0/1 vector over a
vocabulary fitted to the data, so that no label list has to be given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoscope.operators.evaluate import roc_auc
from phenoscope.operators.ordered import hash_key

LABEL = "label"
FEATURES = "features"
LABELS = "labels"


def feature_frame(labelled: DataFrame, matrix: DataFrame, key: str = "id") -> DataFrame:
    """D-39 (data part): labelled rows with the array of their phenotype labels (empty if none).

    ``matrix`` is the long phenotype matrix (target, label), one row per distinct pair.
    """
    sets = matrix.groupBy(F.col("targetFromSourceId").alias(key)).agg(
        F.array_sort(F.collect_list("modelPhenotypeLabel")).alias(LABELS))
    joined = labelled.join(sets, on=key, how="left")
    return joined.withColumn(LABELS, F.coalesce(LABELS, F.array().cast("array<string>")))


def vocabulary_size(frame: DataFrame) -> int:
    """Number of distinct phenotype labels of a feature frame, 1 at least."""
    return max(1, frame.select(F.explode(LABELS).alias("l")).distinct().count())


def feature_stages(frame: DataFrame, y_col: str = "y"):
    """D-39 (ML part): label index (0 stays class 0) and the 0/1 vector over all labels of ``frame``.

    Every label is a feature, however many there are: the vocabulary is as long as
    the data's, and is held by the driver like the model's coefficients.
    """
    indexer = StringIndexer(inputCol=y_col, outputCol=LABEL, stringOrderType="alphabetAsc")
    vectors = CountVectorizer(inputCol=LABELS, outputCol=FEATURES, binary=True, vocabSize=vocabulary_size(frame))
    return [indexer, vectors]


def present_labels(vocabulary: Sequence[str], features: str = FEATURES) -> Column:
    """The names behind the ones of the feature vector, sorted.

    The vector is an argument beside the names, not read inside a lambda: there the optimizer
    would unpack it again for every name.
    """
    names = F.array(*map(F.lit, vocabulary)).cast("array<string>")
    return F.array_sort(F.array_compact(F.zip_with(names, vector_to_array(features), lambda name, x: F.when(x == 1, name))))


def split_train_test(df: DataFrame, key: str, seed: int = 2020, train_fraction: float = 0.7):
    """D-40: stable split by a seeded hash of the key (same split after any retry)."""
    u = F.conv(F.substring(hash_key(F.col(key), seed), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
    staged = df.withColumn("_u", u)
    return (staged.filter(F.col("_u") < train_fraction).drop("_u"),
            staged.filter(F.col("_u") >= train_fraction).drop("_u"))


def linear_svm(train: DataFrame, y_col: str = "y", max_iter: int = 10) -> PipelineModel:
    """D-41: index label, assemble features, fit a linear SVM."""
    svm = LinearSVC(featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter)
    return Pipeline(stages=feature_stages(train, y_col) + [svm]).fit(train)


def classifier_metrics(predictions: DataFrame) -> dict[str, float]:
    """D-42: ROC AUC, accuracy, F1, weighted precision and recall."""
    out = {"areaUnderROC": BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0).evaluate(predictions)}
    multi = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction")
    for metric in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        out[metric] = multi.evaluate(predictions, {multi.metricName: metric})
    return out


def counted_metrics(predictions: DataFrame) -> dict[str, float]:
    """The metrics of ``classifier_metrics`` from the four confusion counts and the rank formula of the AUC."""
    scored = predictions.select(LABEL, "prediction", vector_to_array("rawPrediction")[1].alias("score"))
    true, guess = F.col(LABEL) == 1, F.col("prediction") == 1
    tp, fp, fn, tn = scored.agg(*[F.count_if(c) for c in (true & guess, ~true & guess, true & ~guess, ~true & ~guess)]).first()
    n = tp + fp + fn + tn
    precision, recall = zip(*((hit / max(1, hit + wrong), hit / max(1, hit + missed)) for hit, wrong, missed in ((tn, fn, fp), (tp, fp, fn))))
    f1 = [2 * p * r / (p + r) if p + r else 0.0 for p, r in zip(precision, recall)]
    share = ((tn + fp) / n, (tp + fn) / n)
    mean = lambda values: sum(w * v for w, v in zip(share, values))
    return {"areaUnderROC": roc_auc(scored, LABEL, "score").first().auc, "accuracy": (tp + tn) / n, "f1": mean(f1),
            "weightedPrecision": mean(precision), "weightedRecall": mean(recall)}

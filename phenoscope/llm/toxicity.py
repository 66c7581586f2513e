"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: density of listed and of learned insult terms, how near
they stand to second-person words, shares of capitals, punctuation and digits,
and how many terms appear only once obfuscation is undone. The trees, the
learned terms and the calibration come from a bounded sample of labelled rows;
every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.llm.common import unit_interval, written

#: Insults and second-person words in four languages.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "pathetic", "worthless",
           "disgusting", "clown", "jerk", "fool", "dumb", "imbecile", "bastard", "pig", "filth", "garbage", "vermin",
           "dummkopf", "trottel", "abschaum", "dreck", "crétin", "imbécile", "ordure", "salaud", "estúpido", "basura",
           "imbécil", "escoria")
SECOND_PERSON = ("you", "your", "yours", "yourself", "youre", "u", "ur", "tu", "toi", "vous", "votre", "du", "dich",
                 "dir", "dein", "ihr", "usted", "ustedes", "ti")
FEATURES = ("listed", "learned", "learned_any", "near_you", "you", "capitals", "exclaims", "punctuation", "digits",
            "obfuscated", "log_words")
#: Bytes within which a second-person word counts as near a term.
NEAR = 48
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
#: Lower case; everything in ASCII that is no letter becomes a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same with look-alike digits and signs as letters; other signs inside words are dropped.
_LOOKS = dict(zip(b"013457@$!", b"oieastasi"))
_UNDONE = bytes(_LOOKS.get(b, b + 32 if 65 <= b <= 90 else b) for b in range(256))
_DROPPED = bytes(b for b in _MARKS if b not in _LOOKS)


def terms_of(text: Column, prefixes: tuple[int, ...]) -> Column:
    """Distinct terms of a text: whole words as ``word$`` and word beginnings of each length."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: w != ""))
    begin = [F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.substring(w, 1, n))
             for n in prefixes]
    return F.array_distinct(F.concat(F.transform(words, lambda w: F.concat(w, F.lit("$"))), *begin))


def learn_terms(labelled: DataFrame, most: int, least_docs: int = 5, odds: float = 3.0,
                prefixes: tuple[int, ...] = (4, 5, 6)) -> list[str]:
    """At most ``most`` terms of ``(text, label)`` rows whose smoothed log odds ratio for label 1 is over ``odds``."""
    n1, n0 = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1)) - F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = labelled.select("label", F.explode(terms_of(F.col("text"), prefixes)).alias("term")).groupBy("term").agg(
        F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0"))
    ratio = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    kept = counts.filter((F.col("n1") >= least_docs) & (ratio > odds)).orderBy(
        (ratio * F.col("n1")).desc(), "term").limit(most)
    return [r.term for r in kept.collect()]


def text_features(text: str | None, words: ahocorasick.Automaton) -> list[float]:
    """The values of ``FEATURES`` for one text; all zero for null and empty."""
    raw = (text or "").encode("utf-8")
    plain = raw.translate(_PLAIN)
    n = len(plain.split()) or 1
    hits = {"listed": 0, "learned": 0}
    terms, you, last = [], [], -1
    for at, (kind, size) in words.iter(f" {plain.decode('latin-1')} "):
        if kind == "you":
            you.append(at)
            continue
        start = at - size
        hits[kind] += 1
        if start > last:
            terms.append(start)
        last = max(last, start)
    near = 0
    if terms and you:
        places = np.array(you)
        at = np.searchsorted(places, terms)
        gaps = np.minimum(np.abs(places[np.minimum(at, len(you) - 1)] - terms), np.abs(places[np.maximum(at - 1, 0)] - terms))
        near = int((gaps <= NEAR).sum())
    hidden = 0
    undone = raw.translate(_UNDONE, _DROPPED)
    if undone != plain:
        undone = undone.translate(_PLAIN)
        found = sum(kind != "you" for _, (kind, _) in words.iter(f" {undone.decode('latin-1')} "))
        hidden = max(0, found - hits["listed"] - hits["learned"])
    size = len(raw) or 1
    share = lambda marks: (len(raw) - len(raw.translate(None, marks))) / size
    return [hits["listed"] / n, hits["learned"] / n, float(min(hits["learned"], 8)), near / n, len(you) / n, share(_UPPER),
            share(b"!"), share(_MARKS), share(_DIGITS), hidden / n, float(np.log1p(n))]


def term_finder(learned: list[str]) -> ahocorasick.Automaton:
    """Finds listed and learned terms and second-person words at word beginnings."""
    find = ahocorasick.Automaton()
    for kind, terms in (("learned", learned), ("listed", [f"{t}$" for t in INSULTS]), ("you", [f"{t}$" for t in SECOND_PERSON])):
        for term in terms:
            word = f" {term[:-1]} " if term.endswith("$") else f" {term}"
            word = word.encode("utf-8").decode("latin-1")
            find.add_word(word, (kind, len(word) - 1))
    find.make_automaton()
    return find


def with_features(rows: DataFrame, learned: list[str]) -> DataFrame:
    """The rows of ``(_id, _text)`` as ``(_id, *FEATURES)``; no shuffle, texts are read whole."""
    schema = T.StructType([rows.schema["_id"], *(T.StructField(f, T.DoubleType()) for f in FEATURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = term_finder(learned)
        for batch in batches:
            texts = batch.column(1)
            values = np.array([text_features(texts[i].as_py(), find) for i in range(batch.num_rows)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values.T.copy())], names=["_id", *FEATURES])

    return rows.select("_id", "_text").mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, max_train: int = 16_000, max_terms: int = 1000,
                   seed: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", row_col: str | None = None) -> DataFrame:
    """One row per input row: ``(id, score, predicted)``, with column ``row_col`` in the id's place if it is given.

    ``labels`` holds ``(id, label 0/1)``; only labelled rows for which
    ``usable`` (a condition on the id) holds are learned from, and of those at
    most about ``max_train``, drawn by a hash of the id. The sample is dealt by
    another hash: a half learns terms, three tenths grow trees, one fifth
    calibrates. The model is a bounded number of terms and trees whatever the input.

    ``score`` is the calibrated probability of label 1, ``predicted`` is 1 from
    0.5 on. Null and empty texts have all features zero and are scored like
    any other. Rows that repeat an id are scored by their own text; labels that repeat an id
    count once, a positive before a negative; null labels and ids are not learned
    from. Without both classes in a part of the sample the score is the share of
    label 1 (0.0 without labels). Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull()).groupBy("_id").agg(F.max("label").alias("label"))
    known = known.withColumnRenamed("_id", id_col).filter(usable).withColumnRenamed(id_col, "_id")
    known = written(known, "labels")
    rate = max_train / max(1, known.count())
    picked = written(known.filter(unit_interval(F.col("_id"), seed) < rate), "picked")
    sample = written(picked.join(rows, "_id").select(
        "_id", "_text", "label", unit_interval(F.col("_id"), seed + 1).alias("part")), "sample")
    learned = learn_terms(sample.filter("part < 0.5").select(F.col("_text").alias("text"), "label"), max_terms)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fit = written(with_features(sample, learned).join(sample.select("_id", "label", "part").distinct(), "_id"), "features")
    train, calibrate = (vectors.transform(fit.filter(c)).withColumn("label", F.col("label").cast("double"))
                        for c in ("part >= 0.5 and part < 0.8", "part >= 0.8"))
    classes = [{r.label for r in x.select("label").distinct().collect()} for x in (train, calibrate)]
    rows = rows if row_col is None else docs.select(F.col(row_col).alias("_id"), F.col(text_col).alias("_text"))
    features = vectors.transform(with_features(rows, learned))
    if any(len(c) < 2 for c in classes):
        base = known.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        scored = rows.select("_id", F.lit(float(base)).alias("score"))
    else:
        trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, subsamplingRate=0.8, seed=seed).fit(train.coalesce(4))
        margin = lambda df: trees.transform(df).withColumn("p", vector_to_array("probability")[1])
        curve = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(margin(calibrate).coalesce(4))
        scored = curve.transform(margin(features).select("_id", "p"))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select(F.col("_id").alias(row_col or id_col), score.alias("score"),
                         F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))

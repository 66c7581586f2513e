"""Language ID by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed to a fixed number of features.
Weights are trained with follow-the-regularised-leader and elastic-net
penalties: in each epoch every shard of the training sample runs the updates
from the same state, and the shards' states are averaged. A temperature fitted
on rows kept out of the training calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.llm.common import unit_interval, written

#: Hashed n-gram features.
FEATURES = 1 << 15
#: Characters hashed at once.
BLOCK = 1 << 18
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-5
TEMPERATURES = tuple(float(t) for t in np.geomspace(0.05, 20.0, 61))
_ODD = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]


def ngram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of the whole text, lower-cased, other ASCII than letters as spaces."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    points = np.where((points < 128) & ((points < 97) | (points > 122)), np.uint32(32), points)
    points = points[~((points == 32) & (np.roll(points, 1) == 32))] if len(points) else points
    counts = np.zeros(FEATURES, np.int64)
    for low in range(0, len(points), BLOCK):
        block = points[low:low + BLOCK + 2]
        mixed = np.zeros(len(block), np.uint32)
        for n in range(3):
            if len(block) <= n:
                break
            mixed = (mixed[:len(block) - n] if n else mixed) * _ODD[2] + block[n:] * _ODD[n] + np.uint32(n)
            grams = mixed[:BLOCK]
            counts += np.bincount(((grams ^ (grams >> np.uint32(15))) * _ODD[1]) >> np.uint32(17), minlength=FEATURES)
    return counts


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of unit length."""
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    size = np.sqrt((x * x).sum())
    return at, x / size if size else x


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of an FTRL state: zero where the first penalty holds, shrunk by the second."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max())
    return p / p.sum()


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the rows' ``_text`` each feature occurs, and the number of rows.

    Each task counts into one array of ``FEATURES`` numbers; the sums over tasks
    are bounded by the number of features.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                df[:-1] += ngram_counts(text.as_py()) > 0
                df[-1] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["f", "n"])

    sums = rows.select("_text").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, np.int64)
    for r in sums:
        out[r.f] = r.n
    return out[:-1], int(out[-1])


def train_epoch(sample: DataFrame, idf: np.ndarray, state: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One pass of every shard over its rows ``(_text, _class)``; the mean of their states.

    What reaches the driver is one state a shard: a bounded number of weights.
    """
    shape = state[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = state[0].copy(), state[1].copy()
        seen = 0
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                at, x = tf_idf(ngram_counts(text.as_py()), idf)
                w = weights(z[at], n[at])
                error = softmax(x @ w)
                error[label] -= 1
                g = x[:, None] * error
                more = g * g
                z[at] += g - (np.sqrt(n[at] + more) - np.sqrt(n[at])) / ALPHA * w
                n[at] += more
                seen += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()]), pa.array([n.tobytes()]), pa.array([seen])],
                                             names=["z", "n", "seen"])

    shards = sample.select("_text", "_class").mapInArrow(run, "z binary, n binary, seen long").collect()
    if not shards:
        return state
    share = [s.seen / sum(x.seen for x in shards) for s in shards]
    return tuple(sum(p * np.frombuffer(s[k]).reshape(shape) for p, s in zip(share, shards)) for k in (0, 1))


def logits_of(rows: DataFrame, idf: np.ndarray, w: np.ndarray) -> DataFrame:
    """Add ``logits`` (array of double, null where the text has no letter) in place of ``_text``."""
    rest = [c for c in rows.columns if c != "_text"]
    schema = T.StructType([*(rows.schema[c] for c in rest), T.StructField("logits", T.ArrayType(T.DoubleType()))])
    dense = w * idf[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(len(rest)):
                text = text.as_py()
                if text is None or not any(map(str.isalpha, text)):
                    out.append(None)
                    continue
                counts = np.log1p(ngram_counts(text))
                size = np.sqrt(((counts * idf) ** 2).sum())
                out.append((counts @ dense / (size or 1.0)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.list_(pa.float64()))], names=[*rest, "logits"])

    return rows.select(*rest, "_text").mapInArrow(run, schema)


def fit_temperature(held: DataFrame) -> float:
    """The temperature of least log loss over ``(logits, _class)`` rows; 1.0 without rows."""
    heat = F.explode(F.array(*map(F.lit, TEMPERATURES))).alias("t")
    scaled = held.filter("logits is not null").select("_class", heat, "logits").select(
        "t", "_class", F.transform("logits", lambda v: v / F.col("t")).alias("v"))
    top = F.array_max("v")
    loss = F.log(F.aggregate(F.transform("v", lambda x: F.exp(x - F.array_max("v"))), F.lit(0.0), lambda a, x: a + x)) \
        + top - F.element_at("v", F.col("_class") + 1)
    best = scaled.groupBy("t").agg(F.avg(loss).alias("loss")).orderBy("loss", "t").first()
    return best.t if best else 1.0


def identify_language(docs: DataFrame, usable: Column, max_train: int = 12_000, epochs: int = 3, shards: int = 4,
                      seed: int = 6, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: ``(id, lang_pred, score)``.

    Learns from text and non-null language of the rows for which ``usable`` (a
    condition on the id) holds: document frequencies from all of them, weights
    and temperature from at most about ``max_train``, drawn by a hash of the id
    with an equal share for each language; a fifth of the sample is kept for
    the temperature. Learned languages are taken to be few (their names and a
    fixed number of weights for each are held on the driver).

    ``lang_pred`` is a learned language, ``und`` with score 0.0 if the text is null
    or has no letter, or if no row could be learned from. ``score`` is the
    calibrated probability of the prediction; ties go to the first language in
    code-point order. Texts are read whole; rows that repeat an id are predicted
    alike; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = docs.filter(usable & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    sizes = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes, key=lambda s: s.encode("utf-8"))
    if not langs:
        return rows.select(F.col("_id").alias(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    df, n = document_frequencies(known)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    quota = max_train / len(langs)
    rate, place = F.lit(0.0), F.lit(None).cast("int")
    for k, lang in enumerate(langs):
        rate = F.when(F.col("_lang") == lang, F.lit(quota / sizes[lang])).otherwise(rate)
        place = F.when(F.col("_lang") == lang, F.lit(k)).otherwise(place)
    sample = written(known.filter(unit_interval(F.col("_id"), seed) < rate).select(
        "_text", place.alias("_class"), unit_interval(F.col("_id"), seed + 1).alias("_part")), "sample")
    train = written(sample.filter("_part < 0.8").repartition(shards, "_part").sortWithinPartitions("_part"), "train")
    state = (np.zeros((FEATURES, len(langs))), np.zeros((FEATURES, len(langs))))
    for _ in range(epochs):
        state = train_epoch(train, idf, state)
    w = weights(*state)
    t = fit_temperature(logits_of(sample.filter("_part >= 0.8").select("_class", "_text"), idf, w))
    scaled = F.transform("logits", lambda v: v / F.lit(t))
    top = F.array_max(scaled)
    total = F.aggregate(F.transform(scaled, lambda v: F.exp(v - top)), F.lit(0.0), lambda a, x: a + x)
    found = F.element_at(F.array(*map(F.lit, langs)), F.array_position(F.col("logits"), F.array_max("logits")).cast("int"))
    return logits_of(rows, idf, w).select(
        F.col("_id").alias(id_col), F.when(F.col("logits").isNull(), "und").otherwise(found).alias("lang_pred"),
        F.when(F.col("logits").isNull(), 0.0).otherwise(1.0 / total).alias("score"))

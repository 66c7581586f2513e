"""Toxicity, language ID and mixing: features, calibration, accuracy, water-filling."""

import binascii
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_support import documents, odd_texts, text
from phenoscope.llm import language_id, mixing, toxicity


def fold(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def test_text_features():
    find = toxicity.term_finder(["veq", "grobe$"])
    at = dict(zip(toxicity.FEATURES, toxicity.text_features("You IDIOT! vequm grobe grobes", find)))
    assert at["listed"] == 1 / 5 and at["learned"] == 2 / 5 and at["near_you"] == 3 / 5 and at["you"] == 1 / 5
    assert at["capitals"] == 6 / 29 and at["obfuscated"] == 0
    hidden = dict(zip(toxicity.FEATURES, toxicity.text_features("such an 1d.1ot", find)))
    assert hidden["listed"] == 0 and hidden["obfuscated"] > 0
    assert toxicity.text_features(None, find) == toxicity.text_features("", find) == [0.0] * 10 + [pytest.approx(np.log(2))]


def toxic_rows():
    rows, labels = odd_texts(), []
    bad = ["zuvrak", "zuvran", "worthless", "moron"]
    for i in range(1000, 2200):
        rnd, toxic = random.Random(i), i % 4 == 0
        words = text(i, 40).split()
        if toxic:
            for _ in range(3):
                words[rnd.randrange(40)] = rnd.choice(bad) + ("" if rnd.random() < 0.5 else "s" if rnd.random() < 0.5 else "")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs = documents(spark, rows)
    known = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1), (5, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, known, fold(5) != 0).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in rows)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id in truth and binascii.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_toxicity_without_labels_or_rows(spark):
    docs = documents(spark, odd_texts())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, none, fold(5) != 0).collect()
    assert len(got) == len(odd_texts()) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    assert toxicity.score_toxicity(docs.limit(0), none, fold(5) != 0).collect() == []


ALPHABETS = {"aa": "abcdefgh", "bb": "efghijklm", "cc": "абвгдежз"}


def lang_text(rnd, lang, n=30):
    return " ".join("".join(rnd.choice(ALPHABETS[lang]) for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def test_language_id_on_held_out_rows(spark):
    rnd = random.Random(5)
    rows = [(i, lang_text(rnd, lang := rnd.choice(list(ALPHABETS))), lang, 0.5) for i in range(400)]
    rows += [(1000, None, "aa", 0.5), (1001, "12 34 !?", "bb", 0.5), (1002, "", None, 0.5), (None, "abc", None, 0.5),
             (1003, lang_text(rnd, "cc", 50_000), None, 0.5), (1004, "xyz", "cc", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in language_id.identify_language(docs, fold(4) != 2, epochs=2).collect()}
    assert len(got) == len(rows) and all(0.0 <= r.score <= 1.0 for r in got.values())
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "cc"
    held = [(i, lang) for i, _, lang, _ in rows[:400] if binascii.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)


def test_language_id_without_labels_or_rows(spark):
    docs = documents(spark, odd_texts()).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify_language(docs, fold(4) != 2).collect()} == {"und"}
    assert language_id.identify_language(docs.limit(0), fold(4) != 2).collect() == []


def test_ngram_counts_are_whole_and_block_independent(monkeypatch):
    line = text(3, 500) + " Été"
    whole = language_id.ngram_counts(line)
    monkeypatch.setattr(language_id, "BLOCK", 100)
    assert (language_id.ngram_counts(line) == whole).all()
    n = len(line)
    assert whole.sum() == n + (n - 1) + (n - 2)


def fill(sizes, weights, share, epochs):
    """Water-filling by definition."""
    total, target, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        level = (total - sum(target[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * level >= epochs * sizes[i]}
        if not over:
            for i in free:
                target[i] = weights[i] * level
            break
        for i in over:
            target[i] = epochs * sizes[i]
        free -= over
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_sources(spark, seed):
    rnd = random.Random(seed)
    names = ["z", "a", "é", "\U0001f600", "B", None, "aa", ""]
    rows = [(i, None if i == 3 else text(i, rnd.randrange(0, 60)), rnd.choice(names[:1 + i % 8]), 1) for i in range(400)]
    rows += [(400, "w " * 20_000, "a", 1), (7, text(7, 10), rows[7][2], 1), (None, "x y", "aa", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs.repartition(7)).collect()))
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    target = dict(zip(order, fill([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 1.5, 2)))
    source = {i: s for i, _, s, _ in rows}
    taken, largest = dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert r.taken == r.repeats * r.size <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1


def test_mix_of_no_rows_or_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0, 0)] * 2

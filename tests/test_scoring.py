"""Harmonic family, min-max, quantile bins; brute-force and property checks."""

import random

import pytest
from pyspark.sql import functions as F

from phenoscope.functions import harmonic as H
from phenoscope.operators import scoring


def brute_harmonic(scores):
    s = sorted((x for x in scores if x is not None), reverse=True)
    return sum(v / (i + 1) ** 2 for i, v in enumerate(s))


def test_inverse_square_sum_exact_and_tail(spark):
    ns = [0, 1, 2, 63, 64, 65, 100, 1000, 123456]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    got = {r.n: r.h for r in df.select("n", H.inverse_square_sum(F.col("n")).alias("h")).collect()}
    for n in ns:
        want = sum(1.0 / (i * i) for i in range(1, n + 1))
        assert got[n] == pytest.approx(want, abs=1e-13)


def test_harmonic_matches_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for t in range(40):
        for _ in range(rng.randint(0, 150)):
            rows.append((f"t{t}", rng.choice([None, 0.0, 0.25, 0.5, 0.75, 1.0, rng.random()])))
        rows.append((f"t{t}", None))
    df = spark.createDataFrame(rows, "k string, s double")
    ms = scoring.score_multiset(df, ["k"], "s")
    got = {r.k: r.h for r in ms.select("k", H.harmonic_sum(F.col("scores")).alias("h")).collect()}
    by_key = {}
    for k, s in rows:
        by_key.setdefault(k, []).append(s)
    for k, scores in by_key.items():
        assert got[k] == pytest.approx(brute_harmonic(scores), abs=1e-12)


def test_harmonic_properties(spark):
    df = spark.createDataFrame([("a", 1.0)] * 500 + [("b", 0.5), ("c", None)], "k string, s double")
    out = {r.k: r for r in scoring.with_harmonic(scoring.score_multiset(df, ["k"], "s")).collect()}
    assert out["a"].harmonicSum <= 1.645 and out["a"].harmonicSumNorm <= 1.0006
    assert out["b"].harmonicSum == 0.5
    assert out["c"].harmonicSum == 0.0          # no scores: 0, not null


def test_scaled_harmonic(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.5)], "k string, s double")
    ms = scoring.score_multiset(df, ["k"], "s").withColumnRenamed("k", "targetFromSourceId")
    out = {r.targetFromSourceId: r for r in scoring.scaled_harmonic(ms).collect()}
    assert out["a"].maximum == pytest.approx(1.25)
    assert out["a"].scaledHarmonicSum == pytest.approx(-1.0)
    assert out["b"].scaledHarmonicSum == pytest.approx(-0.4)


def test_minmax_scale(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 5)], "id string, r int")
    got = {r.id: r.x for r in scoring.minmax_scale(df, "r", "x").collect()}
    assert got == {"a": -1.0, "b": 0.0, "c": 1.0}
    same = spark.createDataFrame([("a", 2), ("b", 2)], "id string, r int")
    assert all(r.x is None for r in scoring.minmax_scale(same, "r", "x").collect())


def test_quantile_bins_exact(spark):
    rng = random.Random(3)
    values = [round(rng.random(), 3) for _ in range(237)] + [None, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")
    got = {r.id: r.b for r in scoring.quantile_bins(df, "x", "b").collect()}
    xs = sorted(v for v in values if v is not None)
    n = len(xs)
    cuts = [xs[(j * n + 9) // 10 - 1] for j in range(1, 10)]
    for i, v in enumerate(values):
        want = None if v is None else 1 + sum(c <= v for c in cuts)
        assert got[i] == want
    assert set(b for b in got.values() if b is not None) <= set(range(1, 11))


def test_quantile_bins_approx_range(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1000)], "id int, x double")
    bins = [r.b for r in scoring.quantile_bins_approx(df, "x", "b").collect()]
    assert min(bins) == 1 and max(bins) == 10


def test_harmonic_invariant_under_order_and_monotone(spark):
    rng = random.Random(21)
    scores = [rng.choice([0.0, 0.25, 0.5, 0.75, 1.0]) for _ in range(60)]
    shuffled = scores[:]
    rng.shuffle(shuffled)
    raised = scores[:]
    raised[7] = min(1.0, raised[7] + 0.25)
    rows = [("a", s) for s in scores] + [("b", s) for s in shuffled] + [("c", s) for s in raised]
    df = spark.createDataFrame(rows, "k string, s double")
    got = {r.k: r.harmonicSum for r in scoring.with_harmonic(scoring.score_multiset(df, ["k"], "s")).collect()}
    assert got["a"] == got["b"]
    assert got["c"] >= got["a"]
    assert max(scores) <= got["a"] <= 1.645 * max(scores)


def test_minmax_within_bounds(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.randint(-50, 50)) for i in range(500)], "id int, r int")
    vals = [r.x for r in scoring.minmax_scale(df, "r", "x").collect()]
    assert min(vals) == -1.0 and max(vals) == 1.0 and all(-1.0 <= v <= 1.0 for v in vals)

"""Running totals, hash-ordered selection, ROC/AUC against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from phenoscope.operators import evaluate
from phenoscope.operators.ordered import exact_cut_points, hash_first_n, ordered_totals, range_buckets


@pytest.mark.parametrize("bucket_rows", [10**6, 90, 7])
def test_ordered_totals_match_cumsum(spark, bucket_rows):
    """One bucket, buckets of several groups, groups of several buckets; null groups, a group of most rows, ties."""
    rng = random.Random(1)
    groups = ["a"] * 300 + ["b"] * 40 + [None] * 30 + [f"g{i}" for i in range(30)]
    rows = [(g, rng.randint(0, 50) / 7.0, rng.randint(1, 3)) for g in groups]
    df = spark.createDataFrame(rows, "g string, x double, w int")
    for desc in (False, True):
        order = F.col("x").desc() if desc else F.col("x").asc()
        out = ordered_totals(df, ["g"], [order], ["w"], bucket_rows).collect()
        assert len(out) == len(rows) and (len({r._rt_bucket for r in out}) > 10) == (bucket_rows == 7)
        for r in out:
            same = [(x, w) for g, x, w in rows if g == r.g]
            assert r.w_all == sum(w for _, w in same)
            assert r.w_run == sum(w for x, w in same if (x >= r.x if desc else x <= r.x))
    total = ordered_totals(df.drop("g"), [], [F.col("x").asc()], ["w"], bucket_rows).collect()
    assert all(r.w_run == sum(w for _, x, w in rows if x <= r.x) and r.w_all == sum(w for *_, w in rows) for r in total)


def test_buckets_follow_the_rows(spark):
    rows = spark.range(4000).select((F.col("id") * 37 % 1000).cast("double").alias("x"))
    for n, want in ((40, 1), (400, 4), (4000, 40)):
        table, buckets = range_buckets(rows.limit(n), [F.col("x").asc()], bucket_rows=100)
        assert buckets == want
        spans = table.groupBy("_rt_bucket").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_rt_bucket").collect()
        assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))
        assert want / 2 <= len(spans) <= want


def test_cut_points_are_discrete_quantiles(spark):
    rng = random.Random(3)
    values = [rng.choice([1.0, 2.0, 2.5, 7.0, rng.random() * 9]) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 9, "x double")
    want = [sorted(values)[-(-j * 501 // 10) - 1] for j in range(1, 10)]
    assert exact_cut_points(df, "x", 10, bucket_rows=20) == want == exact_cut_points(df, "x", 10)
    assert exact_cut_points(df.filter("x is null"), "x", 10) == []


def test_hash_first_n(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "id long")
    got = sorted(r.id for r in hash_first_n(df, "id", 0, 37, hex_digits=2).collect())
    want = sorted(sorted(range(500), key=lambda i: (hashlib.md5(f"{i}:0".encode()).hexdigest(), i))[:37])
    assert got == want


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_against_pairs_and_symmetry(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.4), float(rng.randint(0, 30))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, y int, s double")
    auc = evaluate.roc_auc(df, "y", "s", bucket_rows=8).first().auc
    assert auc == pytest.approx(brute_auc([r[1] for r in rows], [r[2] for r in rows]), abs=1e-12)
    flipped = evaluate.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first().auc
    assert auc + flipped == pytest.approx(1.0, abs=1e-12)


def test_roc_curve_monotone_and_ends_at_one(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < 0.5), float(rng.randint(0, 20))) for _ in range(200)]
    df = spark.createDataFrame(rows, "y int, s double")
    pts = sorted(evaluate.roc_curve(df, "y", "s", bucket_rows=4).collect(), key=lambda r: -r.threshold)
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(pts, pts[1:]))
    assert (pts[-1].tpr, pts[-1].fpr) == (1.0, 1.0)


def test_balanced_sample_keeps_all_positives(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, lab int")
    s = evaluate.balanced_sample(df, "lab", "id", seed=0).collect()
    pos = [r for r in s if r.y == 1]
    neg = [r for r in s if r.y == 0]
    assert len(pos) == sum(1 for _, lab in rows if lab == 1)
    assert len(neg) == len(pos)
    again = sorted(r.id for r in evaluate.balanced_sample(df, "lab", "id", seed=0).collect())
    assert again == sorted(r.id for r in s)


def test_auc_grid_groups(spark):
    rows = [(i, i % 2, (i * 7) % 3 and 1 or 0, float(i % 11), float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, y2 int, a double, b double")
    grid = evaluate.auc_grid(df, ["y", "y2"], ["a", "b"], "id", balanced=False).collect()
    assert len(grid) == 4 and all(0.0 <= r.auc <= 1.0 for r in grid)


def test_grouped_auc_over_many_buckets(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a"] * 8 + ["b", None]), int(rng.random() < 0.4), float(rng.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    found = {r.g: r.auc for r in evaluate.roc_auc(df, "y", "s", ["g"], bucket_rows=9).collect()}
    for g in ("a", "b", None):
        assert found[g] == pytest.approx(brute_auc([y for h, y, _ in rows if h == g], [s for h, _, s in rows if h == g]), abs=1e-12)
    curve = evaluate.roc_curve(df, "y", "s", ["g"], bucket_rows=9).collect()
    assert sum(r.threshold == float("inf") and (r.tp, r.fp) == (0, 0) for r in curve) == 3
    assert len(curve) == 3 + len({(g, s) for g, _, s in rows})

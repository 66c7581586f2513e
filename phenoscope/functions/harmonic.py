"""Harmonic-sum expressions (D-16..D-19) as plain Spark Columns.

The harmonic sum of scores s_1 >= s_2 >= ... is  sum_i s_i / i^2.
Instead of a list of all scores per target (unbounded), the operators keep
a *multiset*: an array of (score, n) structs sorted by score, descending,
one entry per distinct score. A block of n equal scores v that starts at
rank r+1 contributes v * (H(r+n) - H(r)), where H(m) = sum_{i<=m} 1/i^2.
The array length is bounded by the number of distinct score values, so
no task ever holds a target's full list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenoscope.functions.constants import HARMONIC_NORMALISER

_EXACT_UP_TO = 64
_ZETA2 = math.pi ** 2 / 6


def inverse_square_sum(m: Column) -> Column:
    """H(m) = sum_{i=1..m} 1/i^2 as a Column; 0 for m <= 0.

    Exact summation up to 64 terms; above that pi^2/6 minus the
    Euler-Maclaurin tail 1/m - 1/2m^2 + 1/6m^3 - 1/30m^5 + 1/42m^7
    (error below 1e-17).
    """
    m = m.cast("long")
    x = m.cast("double")
    exact = F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(0.0),
                        lambda acc, i: acc + F.lit(1.0) / (i * i).cast("double"))
    tail = (F.lit(1.0) / x - F.lit(0.5) / F.pow(x, 2) + F.lit(1.0 / 6) / F.pow(x, 3)
            - F.lit(1.0 / 30) / F.pow(x, 5) + F.lit(1.0 / 42) / F.pow(x, 7))
    return (F.when(m <= 0, F.lit(0.0))
            .when(m <= _EXACT_UP_TO, exact)
            .otherwise(F.lit(_ZETA2) - tail))


def multiset_count(scores: Column) -> Column:
    """Number of scores held in a (score, n) multiset array."""
    return F.aggregate(scores, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])


def multiset_sum(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x["score"] * x["n"])


def harmonic_sum(scores: Column) -> Column:
    """D-16: sum_i s_i / i^2 over a descending (score, n) multiset; 0 if empty."""
    init = F.struct(F.lit(0).cast("long").alias("r"), F.lit(0.0).alias("s"))

    def step(acc, x):
        upto = acc["r"] + x["n"]
        block = x["score"] * (inverse_square_sum(upto) - inverse_square_sum(acc["r"]))
        return F.struct(upto.alias("r"), (acc["s"] + block).alias("s"))

    return F.aggregate(scores, init, step, lambda acc: acc["s"])


def harmonic_norm(harmonic: Column, normaliser: float = HARMONIC_NORMALISER) -> Column:
    """D-17: the harmonic sum divided by the fixed normaliser."""
    return harmonic / F.lit(normaliser)


def max_harmonic(n: Column) -> Column:
    """D-18: largest possible harmonic sum of n scores in [0, 1]."""
    return inverse_square_sum(n)

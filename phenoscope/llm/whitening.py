"""Embedding whitening from the exact characteristic polynomial of the scatter matrix.

Entries are scaled to integers, so sums and products are exact whatever their order.
The polynomial of the integer scatter matrix is found modulo many primes (Hessenberg
reduction, a task's work each) and put together by Chinese remaindering. Its roots are all
real, so Descartes' rule counts those above a bound exactly, which isolates them. Each
root then gives its component by inverse iteration on the null space in
60-digit arithmetic, again a task each. Rows are read to sum, to check and to project.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries are multiplied by this and rounded down.
SCALE = 64
#: Largest absolute entry whose scaled value is sure to fit a long.
LARGEST = float(1 << 56)
#: Bits of a limb of an exact sum, digits of the inverse iteration, least fractional bits of a root.
LIMB, DIGITS, FRACTION = 40, 60, 128
_MASK = (1 << LIMB) - 1


def usable(rows: DataFrame) -> DataFrame:
    """The rows ``(_id, _vec)`` whose vector is not null and has only finite entries that fit, as doubles."""
    vec = F.col("_vec").cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)
    return rows.select("_id", vec.alias("_vec")).filter(F.col("_vec").isNotNull() & (F.size("_vec") > 0) & F.forall("_vec", fine))


def scaled(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as integers floor(64 * c), a row each."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * SCALE).astype(np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact y'y as Python integers: matrix products in double as long as they are exact there."""
    top = int(np.abs(y).max(initial=1)) or 1
    step = (1 << 53) // (top * top)
    if not step:
        y = y.astype(object)
        return y.T @ y
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), step):
        part = y[i:i + step].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """``value`` as (place, part) with the sum of part * 2^(LIMB * place); only the last may be negative."""
    at = 0
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        yield at, value & _MASK
        value, at = value >> LIMB, at + 1
    yield at, value


def exact_moments(vectors: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and sums of products of the scaled vectors, exact for any number of rows.

    A task sends one matrix, in limbs that Spark adds up; ``dims`` squared sums reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            if batch.num_rows:
                y = scaled(batch.column(0), dims)
                n, total, products = n + len(y), total + y.astype(object).sum(axis=0), products + gram(y)
        values = [(-1, -1, n), *((-1, j, total[j]) for j in range(dims)),
                  *((i, j, products[i, j]) for i in range(dims) for j in range(i, dims))]
        rows = [(i, j, at, part) for i, j, v in values for at, part in limbs(int(v))] if n else []
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, (
            pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["i", "j", "at", "part"])

    sums = vectors.select("_vec").mapInArrow(run, "i int, j int, at int, part long").groupBy("i", "j", "at").agg(F.sum("part").alias("part"))
    found: dict[tuple[int, int], int] = {}
    for r in sums.collect():
        found[r.i, r.j] = found.get((r.i, r.j), 0) + (r.part << LIMB * r.at)
    products = [[found.get((min(i, j), max(i, j)), 0) for j in range(dims)] for i in range(dims)]
    return found.get((-1, -1), 0), [found.get((-1, j), 0) for j in range(dims)], products


def primes(bound: int) -> list[int]:
    """Primes under 2^31, largest first, whose product is over ``bound``."""
    small = np.ones(46341, bool)
    small[:2] = False
    for i in range(2, 216):
        if small[i]:
            small[i * i::i] = False
    small, out, product, high = np.flatnonzero(small), [], 1, 1 << 31
    while product <= bound:
        low = high - (1 << 16)
        left = np.ones(high - low, bool)
        for q in small:
            left[-low % q::q] = False
        for at in np.flatnonzero(left)[::-1]:
            if product <= bound:
                out.append(low + int(at))
                product *= out[-1]
        high = low
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo the prime ``p`` < 2^31, from that of x^d down."""
    d = len(matrix)
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        if below[0]:
            at = m + int(below[0])
            a[[m, at]] = a[[at, m]]
            a[:, [m, at]] = a[:, [at, m]]
        u = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * u % p).sum(axis=1)) % p
    polys = [np.zeros(d + 1, np.int64)]  # from the constant up
    polys[0][0] = 1
    for k in range(d):
        new = np.concatenate(([0], polys[k][:-1])) - polys[k] * a[k, k] % p
        below = 1
        for i in range(1, k + 1):
            below = below * int(a[k - i + 1, k - i]) % p
            if not below:
                break
            new = new - polys[k - i] * (int(a[k - i, k]) * below % p) % p
        polys.append(new % p)
    return polys[d][::-1].tolist()


def elementary(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """e_0..e_d: the elementary symmetric sums of the eigenvalues of a positive semidefinite integer matrix, exact.

    They are not negative and at most C(d, k) (trace / d)^k, which says how many primes are needed.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    used = primes(max(comb(d, k) * trace ** k // d ** k for k in range(d + 1)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_mod(matrix, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = spark.createDataFrame([(p,) for p in used], "p long").repartition(min(len(used), 64))
    residues = {r.p: r.c for r in tasks.mapInArrow(run, "p long, c array<bigint>").collect()}
    product = 1
    for p in used:
        product *= p
    out = [0] * (d + 1)
    for p in used:
        rest = product // p
        unit = rest * pow(rest, -1, p)
        for k, c in enumerate(residues[p]):
            out[k] += (c if k % 2 == 0 else -c) % p * unit
    return [v % product for v in out]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial with only real roots are greater than ``at``: sign changes after a Taylor shift."""
    c = list(poly)
    for end in range(len(c), 1, -1):
        for i in range(1, end):
            c[i] += at * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value(poly: list[int], at: int) -> int:
    out = 0
    for c in poly:
        out = out * at + c
    return out


def largest_roots(sums: list[int], count: int) -> list[Fraction]:
    """The ``count`` largest positive roots, falling, of the polynomial with the elementary sums ``sums``.

    Roots are repeated by multiplicity and taken to ``FRACTION`` bits after the point,
    more if a root is so small that fewer than half of these would tell it.
    """
    rank = max(k for k, e in enumerate(sums) if e)
    count, bits = min(count, rank), FRACTION
    while count:
        poly = [(-e if k % 2 else e) << bits * k for k, e in enumerate(sums[:rank + 1])]
        found: list[int] = []
        open_ = [(0, sums[1] << bits, rank, 0)]  # (low, high], roots above each
        while open_ and len(found) < count:
            low, high, above_low, above_high = open_.pop()  # the highest interval first
            if above_low == above_high:
                continue
            if high - low == 1:
                found += [high] * (above_low - above_high)
                continue
            if above_low - above_high == 1:
                sign = value(poly, high)
                while sign and high - low > 1:
                    middle = (low + high) // 2
                    v = value(poly, middle)
                    if not v or (v > 0) == (sign > 0):
                        high, sign = middle, v
                    else:
                        low = middle
                found.append(high)
                continue
            middle = (low + high) // 2
            above = roots_above(poly, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
        if min(found[:count]) >> bits // 2:
            return [Fraction(v, 1 << bits) for v in found[:count]]
        bits *= 2
    return []


def null_vectors(matrix: list[list[int]], root: Fraction, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of ``matrix - root``, by inverse iteration.

    The largest entry of each is positive.
    """
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS + len(str(max(1, max(abs(v) for row in matrix for v in row)))) * 2
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        lu = [[Decimal(v) - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        tiny = Decimal(10) ** (len(str(max(1, matrix[0][0]))) - context.prec)
        order = list(range(d))
        for k in range(d):
            at = max(range(k, d), key=lambda i: abs(lu[i][k]))
            lu[k], lu[at], order[k], order[at] = lu[at], lu[k], order[at], order[k]
            if abs(lu[k][k]) < tiny:
                lu[k][k] = tiny
            head = lu[k][k + 1:]
            for i in range(k + 1, d):
                row = lu[i]
                if row[k]:
                    row[k] = factor = row[k] / lu[k][k]
                    row[k + 1:] = [x - factor * y for x, y in zip(row[k + 1:], head)]

        def solved(b: list[Decimal]) -> list[Decimal]:
            x = [b[i] for i in order]
            for i in range(d):
                x[i] -= sum((a * v for a, v in zip(lu[i][:i], x)), Decimal(0))
            for i in range(d - 1, -1, -1):
                x[i] = (x[i] - sum((a * v for a, v in zip(lu[i][i + 1:], x[i + 1:])), Decimal(0))) / lu[i][i]
            return x

        def unit(x: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for _ in range(2):
                for o in others:
                    along = sum(a * b for a, b in zip(x, o))
                    x = [a - along * b for a, b in zip(x, o)]
            size = sum(v * v for v in x).sqrt()
            return [v / size for v in x]

        found: list[list[Decimal]] = []
        for c in range(count):
            x = unit([Decimal((i + 1) * (2 * c + 7919) % 1009 - 504) for i in range(d)], found)
            for _ in range(12):
                last, x = x, unit(solved(x), found)
                # the sign may flip from step to step
                if min(max(abs(a - b) for a, b in zip(x, last)), max(abs(a + b) for a, b in zip(x, last))) < Decimal("1e-22"):
                    break
            found.append(x)
        out = []
        for x in found:
            at = max(range(d), key=lambda i: (abs(x[i]), -i))
            out.append([float(v if x[at] > 0 else -v) for v in x])
        return out


def principal(spark: SparkSession, matrix: list[list[int]], count: int) -> tuple[list[Fraction], list[list[float]]]:
    """The ``count`` largest positive eigenvalues of an integer scatter matrix and their unit eigenvectors.

    Eigenvalues that agree to half their fractional bits share one null space.
    """
    if not any(matrix[i][i] for i in range(len(matrix))):
        return [], []
    values = largest_roots(elementary(spark, matrix), count)
    groups: list[list[Fraction]] = []
    for v in values:
        if groups and groups[-1][-1] - v < Fraction(1, 1 << FRACTION // 2):
            groups[-1].append(v)
        else:
            groups.append([v])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_pylist()
            found = [null_vectors(matrix, groups[g][0], len(groups[g])) for g in at]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.list_(pa.float64())))], names=["g", "v"])

    tasks = spark.createDataFrame([(g,) for g in range(len(groups))], "g int").repartition(len(groups))
    found = {r.g: r.v for r in tasks.mapInArrow(run, "g int, v array<array<double>>").collect()}
    return values, [v for g in range(len(groups)) for v in found[g]]


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` for every vector and component.

    An entry c becomes x = floor(64 c) + 1,000,000 (the offset leaves every result as it
    is, so it is not added). ``n`` vectors have sums S and covariance V (divisor n). Components are V's unit eigenvectors,
    numbered from 1 by falling eigenvalue e, at most ``components``; their largest
    entry is positive. ``deviation`` is the sum of (n x - S)^2 over the dimensions, as a
    decimal of 38 digits; ``whitened`` is x - S/n on the component, over sqrt(e);
    ``explained`` is e over the trace of V; ``identity_error`` is the largest absolute
    entry of the covariance of ``whitened`` minus the identity, from all rows.

    Left out are null and empty vectors, those with null, not finite or huge entries (2^56 and more), and vectors
    whose length is not the commonest (of equally common lengths the longest counts), since they lie in another space. A
    component without variance cannot be whitened: with fewer than that many
    dimensions of variance there are fewer components, and none for one vector, equal vectors
    or an empty table. Repeated rows and ids count and are returned each; null ids stay.
    Eigenvectors of equal eigenvalues are some orthonormal basis, the same for all rows and
    on every run. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = usable(rows.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")))
    schema = T.StructType([T.StructField("_id", rows.schema[id_col].dataType), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("w", T.ArrayType(T.DoubleType()))])
    length = vectors.groupBy(F.size("_vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dims = length.d if length else 1
    vectors = vectors.filter(F.size("_vec") == dims)
    n, sums, products = exact_moments(vectors, dims)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    values, axes = principal(spark, matrix, components)
    trace, count = sum(matrix[i][i] for i in range(dims)), len(values)
    # e = value / n^2, so whitened = z' axis / sqrt(value) with z = n x - S
    directions = (np.array(axes).reshape(-1, dims) / np.array([sqrt(v) for v in values]).reshape(-1, 1)).T

    def centred(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S of every row, and its sum of squares, exact."""
        top = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums))
        z = y * n - np.array(sums, np.int64) if dims * top * top < 1 << 62 else y.astype(object) * n - np.array(sums, object)
        return z, (z * z).sum(axis=1)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, deviation = centred(scaled(batch.column(1), dims))
            w = z.astype(np.float64) @ directions
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * count), pa.array(w.ravel()))], names=schema.names)

    def second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            w = centred(scaled(batch.column(0), dims))[0].astype(np.float64) @ directions
            total += np.vstack((w.T @ w, w.sum(axis=0)))
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())],
                                         names=["i", "j", "v"])

    error = 0.0
    if count:
        # decimals add up alike in any order
        found = vectors.select("_vec").mapInArrow(second_moments, "i int, j int, v double").groupBy("i", "j").agg(
            F.sum(F.col("v").cast("decimal(38,15)")).alias("v")).collect()
        cells = np.zeros((count + 1, count))
        for r in found:
            cells[r.i, r.j] = float(r.v) / n
        error = float(np.abs(cells[:count] - np.outer(cells[count], cells[count]) - np.eye(count)).max())
    explained = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    placed = vectors.mapInArrow(projected, schema) if count else spark.createDataFrame([], schema)
    return placed.select("_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("_id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))

"""Running totals in a global order, without a single-partition window.

A window with an ORDER BY but no PARTITION BY moves every row to one task. Here the
order is cut into buckets, so that every row of a bucket precedes every row of the next:

1. totals per bucket                             -- aggregate, map-side combined
2. offsets = sums of all earlier buckets         -- over the buckets, a bounded frame
3. per row: offset + running sum in the bucket   -- window partitioned by bucket

``running_totals`` takes buckets that the caller knows to be monotone (prefixes of a
hash). ``ordered_totals`` makes them by range partitioning on one composite key,
the group columns first, so a group of a third of all rows is cut like any other
and few groups still use every task. The input is read once and written; its
row count sets the number of buckets. Groups are joined null-safe, so rows
whose group columns are null form a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoscope.store import measured, written

_BUCKET = "_rt_bucket"
#: Rows of a bucket, about, and buckets at most: the bound of the frames that are broadcast or sent to one task.
BUCKET_ROWS, MAX_BUCKETS = 200_000, 1 << 16


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row global aggregate to every row of ``df``.

    The row is a scalar subquery (computed once, used as a value), so no
    join is planned.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_scalars")).scalar()
    staged = df.withColumn("_scalars", packed)
    return staged.withColumns({c: F.col(f"_scalars.{c}") for c in cols}).drop("_scalars")


def join_groups(df: DataFrame, per_group: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``per_group`` (one row a group) on ``cols``, null equal to null."""
    renamed = per_group.withColumnsRenamed({c: f"_g_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & df[c].eqNullSafe(renamed[f"_g_{c}"])
    return df.join(renamed, cond, how).drop(*[f"_g_{c}" for c in cols])


def range_buckets(df: DataFrame, order: Sequence[Column], bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """``df`` with ``_rt_bucket``, monotone in ``order``, and the number of buckets: one for each ``bucket_rows`` rows.

    ``df`` is computed once and written; bounds are sampled from the written rows,
    and the bucketed rows are written too, so that no retry can move a row to
    another bucket. Rows that are equal in ``order`` share a bucket.
    """
    # a stored number, since a constant would be taken out of the windows' keys
    table, rows = measured(df.withColumn(_BUCKET, F.lit(0)))
    buckets = min(MAX_BUCKETS, max(1, -(-rows // bucket_rows)))
    if buckets == 1:
        return table, 1
    return written(table.repartitionByRange(buckets, *order).withColumn(_BUCKET, F.spark_partition_id())), buckets


def ordered_totals(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], sum_cols: Sequence[str],
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add for each of ``sum_cols`` ``<name>_run`` and ``<name>_all``: the inclusive running sum in ``order`` and the sum, by group.

    Also ``_rt_bucket`` and ``_rt_edge`` (whether the row's group may reach into
    another bucket). Ties in ``order`` get the same running sum. Only the first and the last group of a
    bucket can go on in another one, so the prefix sums over buckets have at
    most two rows a bucket, however many groups there are.
    """
    groups = list(group_cols)
    table, buckets = range_buckets(df, [*[F.col(c).asc_nulls_first() for c in groups], *order], bucket_rows)
    per = table.groupBy(_BUCKET, *groups).agg(*[F.sum(c).alias(f"_rt_t_{c}") for c in sum_cols])
    if groups:
        key, inside = F.struct(*groups), Window.partitionBy(_BUCKET)
        per = per.withColumns({"_rt_x": F.min(key).over(inside), "_rt_y": F.max(key).over(inside)}).filter(
            key.eqNullSafe(F.col("_rt_x")) | key.eqNullSafe(F.col("_rt_y"))).drop("_rt_x", "_rt_y")
    # two rows a bucket at most: one task, and small enough to broadcast
    edges = per.coalesce(1)
    before = Window.partitionBy(*groups).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(_BUCKET, *groups, F.lit(True).alias("_rt_edge"),
                         *[F.coalesce(F.sum(f"_rt_t_{c}").over(before), F.lit(0)).alias(f"_rt_o_{c}") for c in sum_cols],
                         *[F.sum(f"_rt_t_{c}").over(Window.partitionBy(*groups)).alias(f"_rt_w_{c}") for c in sum_cols])
    within = Window.partitionBy(_BUCKET, *groups)
    rows = table.withColumns({f"{c}_run": F.sum(c).over(within.orderBy(*order)) for c in sum_cols}
                             | {f"{c}_all": F.sum(c).over(within) for c in sum_cols})
    out = join_groups(rows, F.broadcast(edges), [_BUCKET, *groups], "left")
    return out.withColumns({f"{c}_run": F.col(f"{c}_run") + F.coalesce(f"_rt_o_{c}", F.lit(0)) for c in sum_cols}
                           | {f"{c}_all": F.coalesce(f"_rt_w_{c}", f"{c}_all") for c in sum_cols}
                           | {"_rt_edge": F.coalesce("_rt_edge", F.lit(False))}).drop(
        *[f"_rt_{k}_{c}" for k in "ow" for c in sum_cols])


def running_totals(df: DataFrame, order: Sequence[Column], sum_cols: dict[str, Column],
                   bucket: Column, partition_cols: Sequence[str] = (),
                   max_buckets: int | None = None, with_totals: bool = False, ties: bool = True,
                   keep: Column | None = None) -> DataFrame:
    """Add inclusive running sums ``name -> expr`` in ``order`` within ``partition_cols``.

    ``bucket`` must be non-decreasing along ``order``. When ``max_buckets``
    is given and there are no partition columns, the bucket offsets are a
    frame of at most that many rows and are broadcast. ``with_totals`` also
    adds ``<name>_total``, the sum over the whole group, taken from the
    small per-bucket frame (no extra pass over the input). ``keep`` is a
    condition on the bucket offsets ``_rt_o_<name>`` (and the rows' columns) that
    drops rows before the in-bucket window shuffles and sorts them.
    """
    parts = list(partition_cols)
    staged = df.withColumn(_BUCKET, bucket)
    for name, expr in sum_cols.items():
        staged = staged.withColumn(f"_rt_v_{name}", expr)
    totals = staged.groupBy(*parts, _BUCKET).agg(
        *[F.sum(f"_rt_v_{name}").alias(f"_rt_t_{name}") for name in sum_cols])
    before = Window.partitionBy(*parts).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parts)
    offsets = totals.select(
        *parts, _BUCKET,
        *[F.coalesce(F.sum(f"_rt_t_{name}").over(before), F.lit(0)).alias(f"_rt_o_{name}")
          for name in sum_cols],
        *[F.sum(f"_rt_t_{name}").over(whole).alias(f"{name}_total") for name in sum_cols if with_totals])
    if not parts and max_buckets is not None:
        offsets = F.broadcast(offsets)
    joined = join_groups(staged, offsets, parts + [_BUCKET])
    if keep is not None:
        joined = joined.filter(keep)
    inside = Window.partitionBy(*parts, _BUCKET).orderBy(*order)
    if not ties:
        inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for name in sum_cols:
        out = out.withColumn(name, F.col(f"_rt_o_{name}") + F.sum(f"_rt_v_{name}").over(inside))
    drop = [_BUCKET] + [f"_rt_{k}_{name}" for name in sum_cols for k in ("v", "o")]
    return out.drop(*drop)


def hash_key(key: Column, seed: int) -> Column:
    """Deterministic pseudo-random order key: md5 of ``key:seed`` as hex text."""
    return F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed))))


def hash_first_n(df: DataFrame, key: str, seed: int, n: Column | int,
                 hex_digits: int = 3) -> DataFrame:
    """Rows whose (md5(key:seed), key) is among the ``n`` smallest.

    ``n`` may be a Column over a one-row frame crossed in beforehand, or an
    int. Buckets are md5 prefixes (uniform by construction, no skew); only
    buckets that start below ``n`` reach the in-bucket window. Rows with equal
    keys are counted one by one (which of them come first does not matter to
    the key), so exactly ``n`` rows are kept where there are as many.
    """
    h = hash_key(F.col(key), seed)
    staged = df.withColumn("_hk", h)
    limit = F.lit(n) if isinstance(n, int) else n
    ranked = running_totals(
        staged,
        order=[F.col("_hk"), F.col(key)],
        sum_cols={"_rank": F.lit(1).cast("long")},
        bucket=F.substring(F.col("_hk"), 1, hex_digits),
        max_buckets=16 ** hex_digits,
        ties=False,
        keep=F.col("_rt_o__rank") < limit,
    )
    return ranked.filter(F.col("_rank") <= limit).drop("_hk", "_rank")


def value_counts(df: DataFrame, value_col: str) -> DataFrame:
    """``(value, rows)`` of the distinct values that are not null."""
    return df.select(F.col(value_col).alias("_x")).filter(F.col("_x").isNotNull()).groupBy("_x").agg(
        F.count(F.lit(1)).alias("_cnt"))


def exact_cut_points(df: DataFrame, value_col: str, num_bins: int, bucket_rows: int = BUCKET_ROWS) -> list:
    """The values at ranks ceil(j*n/num_bins), j = 1..num_bins-1; empty without values.

    This is the discrete quantile (smallest value whose cumulative share is
    at least j/num_bins), found exactly: distinct values with counts get
    global running counts, and the few that hold a target rank are returned. ``df`` is
    read once. Nulls are ignored.
    """
    ranked = ordered_totals(value_counts(df, value_col), [], [F.col("_x").asc()], ["_cnt"], bucket_rows)
    ranks = F.transform(F.sequence(F.lit(1), F.lit(num_bins - 1)), lambda j: F.floor((j * F.col("_cnt_all") + num_bins - 1) / num_bins))
    times = F.size(F.filter(ranks, lambda k: (k > F.col("_cnt_run") - F.col("_cnt")) & (k <= F.col("_cnt_run"))))
    found = ranked.select("_x", times.alias("times")).filter("times > 0").orderBy("_x").collect()
    return [r._x for r in found for _ in range(r.times)]

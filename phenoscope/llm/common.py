"""Helpers shared by the operators: tables in the shared folder, word cutting,
sorted-run reading of Arrow batches, and connected components by joins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space, and tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

#: Bits of the filter of ``flagged``.
BITMAP = 1 << 24
#: Whether Spark deletes a job's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables written since the innermost ``settled`` began; none outside of one.
_MADE: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, by whatever path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` of the session, or the folder set on the context.
    A scratch folder is made only for a ``local`` master where neither is set;
    on a cluster without one this raises, since a machine-local folder would
    lose rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="phenoscope-shared-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs begun inside are deleted when the job ends, not when the driver's memory is next cleaned."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts the lineage so that a lost executor costs no recomputation from
    the start, fixes values that later steps read more than once, and gives the
    planner the table's true size. Nothing reads the job's shuffle files again, so they go with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    with _shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(table)
    return table


def appended(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One table as of ``written`` with the rows of all ``parts``, of which there is one at least; each is written before the next is asked for."""
    path = None
    for df in parts:
        path = path or f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
        with _shuffles_deleted(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(table)
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more, by the file system that holds it."""
    spark, files = table.sparkSession, table.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if "/llm-" in folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` written; the tables of ``written`` that were made on its way are then deleted.

    Only what ``make`` returns may be read afterwards, so it must not hand on its tables by any other way.
    """
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        table = written(make(), name)
    finally:
        _MADE.reset(token)
    for used in made:
        if used is not table:
            discard(used)
    if outer is not None:
        outer.append(table)
    return table


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores put before those that ``columns`` already has (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def flagged(df: DataFrame, wanted: DataFrame, key: Column, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether ``key``, a long made of columns of both, may be in ``wanted``; false means that it is not.

    A bitmap of ``BITMAP`` bits over the wanted keys (a fixed 2 MB however many they
    are) is broadcast, so no row is shuffled for it.
    """
    of, at, bits = unused([*df.columns, flag], "_bucket", "_bit", "_bitmap")
    place = F.pmod(key, F.lit(BITMAP))
    bucket, bit = F.floor(place / 32768).alias(of), F.pmod(place, F.lit(32768)).alias(at)
    bitmap = wanted.select(bucket, bit).groupBy(of).agg(F.bitmap_construct_agg(at).alias(bits))
    near = df.withColumns({of: bucket, at: bit}).join(F.broadcast(written(bitmap, "bitmap")), of, "left")
    byte = F.conv(F.hex(F.substring(bits, F.floor(F.col(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(at, F.lit(8)).cast("int"))) != 0
    return near.select(*df.columns, F.coalesce(found, F.lit(False)).alias(flag))


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A text that stands for a row's id and text together, in the order of ids, null ids last.

    Rows that repeat an id with another text have keys of their own; only rows equal
    in both share one. Whole numbers are padded, other ids are ordered as text.
    """
    name = F.col(id_col)
    if docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        shown = F.lpad((name.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    else:
        shown = name.cast("string")
    start = F.when(name.isNull(), F.lit("1:")).otherwise(F.concat(F.lit("0:"), shown))
    text = F.when(F.col(text_col).isNull(), F.lit("-")).otherwise(F.md5(F.col(text_col)))
    return F.concat(start, F.lit(":"), text)


def word_count(text: Column) -> Column:
    """Number of words in ``text`` as long; 0 for null, empty and blank texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def unit_interval(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone (40 bits of an MD5)."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 10)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 40))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a stream of batches sorted by ``keys`` at changes of key.

    Yields tables that hold whole key groups (many small ones together); a
    group is never cut by a batch's end, so only one group and one batch are
    held at a time.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last):
            same &= np.asarray(pa.compute.equal(batch.column(k), v).to_numpy(zero_copy_only=False), bool)
        start = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = [batch.slice(start)]
        elif held and any(held[-1].column(k)[held[-1].num_rows - 1] != v for k, v in zip(keys, last)):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edges with the components of the links ``a[i] - b[i]``: each member to its smallest."""
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label, new[np.arange(len(names))])
        new = new[new]
        if (new == label).all():
            break
        label = new
    more = np.flatnonzero(label != np.arange(len(names)))
    return names[label[more]], names[more]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list, as a union-find in joins.

    Each round every node hooks onto its smallest smaller neighbour, the
    resulting parent pointers are halved by self-joins until they point at
    roots, and the edges are relabelled by root; rounds go on until no edge is
    left. Nodes may be of any ordered type. Every step reads written tables, so
    hot nodes are split by adaptive skew joins and a lost executor costs one step.

    Returns ``(node, component_id)`` for every node that has a smaller one in
    its component; ``component_id`` is the smallest node. Roots, self-loops and
    null ends give no row; repeated edges do not matter.
    """
    def tidy(x: Column, y: Column, df: DataFrame) -> DataFrame:
        return df.filter(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    left = written(tidy(F.col(a), F.col(b), edges), "edges")
    label: DataFrame | None = None
    while not left.isEmpty():
        parent = written(left.groupBy("b").agg(F.min("a").alias("p")).withColumnRenamed("b", "node"), "parents")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("g"))
            jumped = parent.join(up, "p", "left").select(
                "node", F.coalesce("g", "p").alias("p"), F.col("g").isNotNull().alias("moved"))
            parent = written(jumped, "parents")
            if parent.filter("moved").isEmpty():
                parent = parent.select("node", "p")
                break
            parent = parent.select("node", "p")
        for end in ("a", "b"):
            root = parent.select(F.col("node").alias(end), F.col("p").alias("_root"))
            left = left.join(root, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
        left = written(tidy(F.col("a"), F.col("b"), left), "edges")
        if label is None:
            label = parent
        else:
            root = parent.select(F.col("node").alias("p"), F.col("p").alias("_root"))
            label = written(label.join(root, "p", "left").select(
                "node", F.coalesce("_root", "p").alias("p")).unionByName(parent), "labels")
    if label is None:
        return edges.sparkSession.createDataFrame([], left.schema).select(
            F.col("b").alias("node"), F.col("a").alias("component_id"))
    return label.select("node", F.col("p").alias("component_id"))

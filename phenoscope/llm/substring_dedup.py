"""Substring dedup over a De Bruijn graph of token k-mers.

The edges of the graph are the windows of ``k`` consecutive words. Consecutive
windows of a document that share their minimizer (the least-hashed shorter word
sequence inside them) are cut out as one path of edges, so that a document is a
short list of paths instead of one row per window, and equal windows of any two
documents lie in paths with the same minimizer. Paths whose minimizer has one
spelling in the whole corpus do not branch and stay compact; only paths of a
minimizer with several spellings are opened into single edges. Compact paths
and edges that a smaller document also has are joined to their first source,
and neighbouring ones with the same source compact into long spans. Spans are held
equal by the digests of their paths at both coordinates; the source's words are
not fetched again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.llm.common import written

#: Words handled at once in one task; a longer text is cut, with an overlap of one window.
BLOCK_WORDS = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def sequence_hashes(line: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words, from prefix sums over the bytes and over the words."""
    up, down = _powers(_STEP, len(line) + 1), _powers(_INVERSE, len(line) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((line.astype(np.uint64) + np.uint64(1)) * up[:-1])))
    words = _mixed((sums[ends] - sums[starts]) * down[starts])
    m = len(words)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * up[:m])))
    return _mixed((sums[n:] - sums[:m - n + 1]) * down[:m - n + 1])


def paths_of(line: bytes, k: int, part: int) -> list[tuple[int, int, int, int, int]]:
    """Paths ``(start, edges, minimizer, first byte, last byte)`` of words joined by one space."""
    data = np.frombuffer(line, np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))
    edges = len(starts) - k + 1
    if edges < 1:
        return []
    h = sequence_hashes(data, starts, ends, part)
    bits = np.uint64((1 << 20) - 1)
    least = (h & ~bits) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first in the window
    width, have = k - part + 1, 1
    while have < width:
        by = min(have, width - have)
        least = np.minimum(least[:-by], least[by:])
        have += by
    at = (least & bits).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:], [edges])) - 1
    return list(zip(first.tolist(), (last - first + 1).tolist(), h[at[first]].view(np.int64).tolist(),
                    starts[first].tolist(), ends[last + k - 1].tolist()))


def _blocks(text: str | None, k: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of at most ``BLOCK_WORDS`` words with their first position; every window is in exactly one."""
    words = (text or "").encode("utf-8").split()
    most = max(BLOCK_WORDS, 2 * k)
    for low in range(0, max(1, len(words) - k + 1), most - k + 1):
        yield low, words[low:low + most]


def paths(rows: DataFrame, k: int, part: int) -> DataFrame:
    """``(_id, _row, start, edges, minimizer, spelling)`` of all paths of ``(_id, _row, _text)``.

    ``spelling`` is a 64-bit digest of all words of the path.
    """
    schema = T.StructType([rows.schema["_id"], T.StructField("_row", T.LongType()), T.StructField("start", T.IntegerType()),
                           T.StructField("edges", T.IntegerType()), T.StructField("minimizer", T.LongType()),
                           T.StructField("spelling", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_digest
        for batch in batches:
            texts = batch.column(2)
            owner: list[int] = []
            found: list[tuple[int, int, int]] = []
            spelled: list[bytes] = []
            for i in range(batch.num_rows):
                for low, words in _blocks(texts[i].as_py(), k):
                    line = b" ".join(words)
                    for start, n, minimizer, a, b in paths_of(line, k, part):
                        owner.append(i)
                        found.append((low + start, n, minimizer))
                        spelled.append(digest(line[a:b]))
                if found and (len(found) > 200_000 or i == batch.num_rows - 1):
                    start, n, minimizer = zip(*found)
                    whose = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(whose), batch.column(1).take(whose), pa.array(start, pa.int32()),
                         pa.array(n, pa.int32()), pa.array(minimizer, pa.int64()),
                         pa.array(np.frombuffer(b"".join(spelled), np.int64))], names=schema.names)
                    owner, found, spelled = [], [], []

    return rows.mapInArrow(run, schema)


def edges_of(rows: DataFrame, k: int) -> DataFrame:
    """``(_id, _row, start, e1, e2)``: the single edges of the paths that ``rows (_id, _row, _text, _open)`` list.

    ``(e1, e2)`` is a 128-bit digest of the window's words.
    """
    schema = T.StructType([rows.schema["_id"], *(T.StructField(c, t) for c, t in (
        ("_row", T.LongType()), ("start", T.IntegerType()), ("e1", T.LongType()), ("e2", T.LongType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for i in range(batch.num_rows):
                words = (batch.column(2)[i].as_py() or "").encode("utf-8").split()
                at = [s for p in batch.column(3)[i].as_py() for s in range(p["start"], p["start"] + p["edges"])]
                for low in range(0, len(at), 1 << 16):
                    some = at[low:low + (1 << 16)]
                    keys = np.frombuffer(b"".join(digest(b" ".join(words[s:s + k])) for s in some), np.int64).reshape(-1, 2)
                    whose = pa.array([i] * len(some))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(whose), batch.column(1).take(whose), pa.array(some, pa.int32()),
                         pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())], names=schema.names)

    return rows.mapInArrow(run, schema)


def repeated_spans(rows: DataFrame, k: int, part: int) -> DataFrame:
    """``(_row, spans)``: the word ranges ``{from, to, source, at}`` of every row that a smaller id repeats.

    ``source`` is the smallest id that has the words and ``at`` their place there.
    """
    cut = paths(rows, k, part)
    meet = cut.groupBy("minimizer").agg(F.min("_id").alias("first"), F.max("_id").alias("_last"),
                                        F.min("spelling").alias("_s"), F.max("spelling").alias("_t"))
    meet = written(meet.filter("first < _last").select("minimizer", "first", (F.col("_s") != F.col("_t")).alias("branches")),
                   "minimizers")
    shared = written(cut.select("_id", "_row", "start", "edges", "minimizer").join(meet, "minimizer"), "shared")
    opened = shared.filter("branches").groupBy("_row").agg(F.collect_list(F.struct("start", "edges")).alias("_open"))
    single = written(edges_of(rows.join(opened, "_row").select("_id", "_row", "_text", "_open"), k), "edges")
    known = written(single.groupBy("e1", "e2").agg(F.min("_id").alias("first"), F.max("_id").alias("_last"))
                    .filter("first < _last").drop("_last"), "repeated")
    twice = written(single.join(known, ["e1", "e2"]), "twice")

    def with_source(found: DataFrame, keys: list[str]) -> DataFrame:
        source = written(found.filter("_id = first").groupBy(*keys).agg(F.min("start").alias("at")), "sources")
        return found.filter("_id > first").join(source, keys).select("_row", "start", "edges", "first", "at")

    compact = with_source(shared.filter("not branches"), ["minimizer"])
    loose = with_source(twice.withColumn("edges", F.lit(1)), ["e1", "e2"])
    steps = compact.unionByName(loose)
    # neighbouring steps at neighbouring places of one source compact into one span
    along = Window.partitionBy("_row", "first", "lag").orderBy("start", "edges")
    end = F.col("start") + F.col("edges")
    placed = steps.withColumn("lag", F.col("start") - F.col("at")).withColumn(
        "reached", F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1)))
    numbered = placed.withColumn("piece", F.sum(F.when(F.col("start") <= F.col("reached"), 0).otherwise(1)).over(
        along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("_row", "first", "lag", "piece").agg(F.min("start").alias("from"), (F.max(end) + k - 1).alias("to"))
    return spans.groupBy("_row").agg(F.collect_list(F.struct(
        "from", "to", F.col("first").alias("source"), (F.col("from") - F.col("lag")).alias("at"))).alias("spans"))


def substring_dedup(docs: DataFrame, k: int = 50, part: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, n_words, n_removed, kept_text, spans)``.

    A word goes if a window of ``k`` words covering it also starts in a row with
    a smaller id. ``kept_text`` has the other words joined by one space, ``spans``
    the removed ranges with source id and place (null if none). ``part`` is the
    length of a minimizer, at most ``k``.

    Null, empty and blank texts have no words; texts of fewer than ``k`` words
    stay whole. Windows repeated only inside one document, or in rows with the same
    id, stay. Rows with a null id stay whole and are no source. An empty table
    gives an empty result; other columns are not read.
    """
    if not 0 < part <= k:
        raise ValueError("part must be between 1 and k")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_row", F.xxhash64(F.col("_id"), F.col("_text"))).select("_id", "_row", "_text")
    spans = repeated_spans(rows.filter(F.col("_id").isNotNull() & F.col("_text").isNotNull()), k, part)
    found = rows.join(written(spans, "spans"), "_row", "left").select("_id", "_text", "spans")
    schema = T.StructType([rows.schema["_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_text", T.StringType()), found.schema["spans"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for i in range(batch.num_rows):
                words = (batch.column(1)[i].as_py() or "").encode("utf-8").split()
                left, low = [], 0
                for span in sorted(batch.column(2)[i].as_py() or (), key=lambda s: s["from"]):
                    if span["from"] > low:
                        left += words[low:span["from"]]
                    low = max(low, span["to"])
                left += words[low:]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string()), batch.column(2)], names=schema.names)

    return found.mapInArrow(run, schema).withColumnRenamed("_id", id_col)

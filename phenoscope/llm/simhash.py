"""SimHash near-dedup: 64-bit fingerprints linked at a small Hamming distance.

Candidates come from deletion-variant signatures. With at most ``d`` differing
bits, a fingerprint cut into ``d // 2 + 1`` segments has one segment with at
most one differing bit. Each segment is indexed once per bit with that bit as
a wildcard, so two such fingerprints share a key, and an equality on the key
followed by a check of the whole distance finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.llm.common import components, runs, star_edges, written

BITS = 64
#: Members of one key compared in one piece; larger keys are dealt out in pairs of pieces.
PIECE = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles of ``text``, repeats included.

    Fewer words than ``shingle`` give one shingle, the whole sequence; none
    (null, empty, blank) gives zero.
    """
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(_id, fp)``: the fingerprint of every row as a signed long."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = np.array([fingerprint(texts[i].as_py(), shingle) for i in range(batch.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["_id", "fp"])

    return rows.mapInArrow(run, T.StructType([rows.schema["_id"], T.StructField("fp", T.LongType())]))


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(key, fp)``: every one-wildcard segment variant of every fingerprint."""
    cuts = np.linspace(0, BITS, max_bits // 2 + 2).astype(int).tolist()
    keys = []
    for s, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        whole = ((1 << (high - low)) - 1) << low
        for bit in range(low, high):
            mask = whole & ~(1 << bit)
            mask -= (mask >> 63) << 64  # as a signed long
            keys.append(F.xxhash64(F.lit(bit), F.lit(s), F.col("fp").bitwiseAND(F.lit(mask))))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def near_pairs(left: np.ndarray, right: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges with the components of the ``left`` x ``right`` links, linear in the members."""
    edges: list[tuple[int, int]] = []
    for i in range(0, len(left), 256):
        block = left[i:i + 256]
        near = np.bitwise_count(block.view(np.uint64)[:, None] ^ right.view(np.uint64)[None]) <= max_bits
        x, y = np.nonzero(near)
        a, b = star_edges(block[x], right[y])
        edges += zip(a.tolist(), b.tolist())
    return edges


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(a, b)``: edges between distinct fingerprints with the components of all links.

    Every link (at most ``max_bits`` differing bits) between members of a key is
    verified, but only stars over what they connect are returned, so the rows
    are linear in the members of a key. A key with more than ``PIECE`` members is cut into pieces
    by a hash, and each pair of pieces is a task's unit of its own.
    """
    keyed = variants(fps, max_bits)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = written(sizes.filter(F.col("n") > PIECE).select(
        "key", F.ceil(F.col("n") / PIECE).cast("int").alias("parts")), "hot")
    if hot.isEmpty():
        dealt = keyed.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("part"), "fp")
    else:
        part = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
        placed = keyed.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
            .withColumn("part", part)
        dealt = placed.select("key", "part", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")) \
            .select("key", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["key", "i", "j"]):
            key, i, j, part, fp = (table.column(c).to_numpy() for c in ("key", "i", "j", "part", "fp"))
            new = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            starts, stops = np.concatenate(([0], new)), np.concatenate((new, [len(key)]))
            edges: list[tuple[int, int]] = []
            size = stops - starts
            two = starts[(size == 2) & (i[starts] == j[starts])]
            close = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_bits]
            edges += zip(np.minimum(fp[close], fp[close + 1]).tolist(), np.maximum(fp[close], fp[close + 1]).tolist())
            for a, b in zip(starts[size > 1].tolist(), stops[size > 1].tolist()):
                if i[a] != j[a]:
                    inside = part[a:b] == i[a]
                    edges += near_pairs(fp[a:b][inside], fp[a:b][~inside], max_bits)
                elif b - a > 2:
                    edges += near_pairs(fp[a:b], fp[a:b], max_bits)
            edges = list(set(edges))
            if edges:
                x, y = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")


def simhash_dedup(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, fingerprint, component_id)``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the
    smallest id reachable over links of at most ``max_bits`` differing bits,
    the row's own included.

    Fingerprints are computed once and written; equal ones become one node, so
    copies are never paired. Null, empty and blank texts have fingerprint zero
    and are linked like any other. Rows that repeat an id keep a row each. Null
    ids take part but are never a ``component_id`` unless the component has no
    other. An empty table gives an empty result; other columns are not read.
    """
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be between 0 and 63")
    marked = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("_id").alias("least")), "nodes")
    label = components(links(nodes.select("fp"), max_bits)) if max_bits else None
    of = nodes if label is None else nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left")
    root = F.col("fp") if label is None else F.coalesce("component_id", "fp")
    of = written(of.select("fp", root.alias("root"), "least"), "roots")
    smallest = written(of.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    named = written(of.join(smallest, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

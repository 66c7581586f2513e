"""Line dedup: fuzzy equal lines of a corpus, one of each component kept.

Lines are compared as sets of character shingles. A line's MinHash signature
holds the minimum of its shingles' hashes under each of ``BANDS * ROWS``
permutations; a band of ``ROWS`` minima is a key. Lines that share a key are
verified by the exact Jaccard similarity of their shingle sets, and links are
joined by a union-find in joins.

Signing and comparing run in Arrow batches with numpy, since the form in DataFrame
functions alone did not come to its end within the check tool's limits (figures in
the README). Spark partitions, sorts, joins and aggregates all rows.

Signatures and verification both take every shingle, whatever a line's length or
words, so two lines never draw their hashes from different populations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoscope.llm.common import components, discard, flagged, row_key, runs, settled, star_edges, unused, written

#: Characters of a shingle.
SHINGLE = 5
#: Minima of a band, and bands of a signature.
ROWS, BANDS = 4, 10
#: Lines of at most this many shingles also give a key for the whole set and for the set without each of its members.
SMALL = 9
#: Part of the minima that two lines must have in common for their texts to be compared across components.
AGREE = 0.575
#: Two bits of each of so many minima make a line's 64-bit sketch; neighbours' texts are compared if so many of them agree.
SKETCH, SKETCH_AGREE = 32, 21
#: Neighbours in a band's key that a line is compared with at first.
NEIGHBOURS = 4
#: Rows held at a time while neighbours are paired; a key with more is cut.
HELD = 1 << 16
#: Members of one key compared in one piece; larger keys are dealt out in pairs of pieces.
PIECE = 1024
#: Characters shingled at a time, if a line has not more.
CHARS = 1 << 18
_BLANK = " \t\r\x0b\x0c"

_RANDOM = np.random.default_rng(20)
_POWERS = _RANDOM.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _RANDOM.integers(1, 1 << 31, ROWS * BANDS, np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RANDOM.integers(0, 1 << 32, ROWS * BANDS, np.uint32)
_BAND = _RANDOM.integers(1, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_row, pos, norm)`` of every line that is not blank; ``norm`` is trimmed and lower-cased, ``pos`` from 0.

    ``_row`` is the row's key: its id and text together.
    """
    rows = docs.select(row_key(docs, id_col, text_col).alias("_row"), F.posexplode(F.split(F.lower(F.col(text_col)), "\n")).alias("pos", "raw"))
    return rows.select("_row", "pos", F.btrim("raw", F.lit(_BLANK)).alias("norm")).filter("norm != ''")


def line_key(norm: Column) -> Column:
    """128-bit hash of a line."""
    return F.unhex(F.md5(norm))


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values with their bits mixed."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cuts(sizes: list[int]) -> Iterator[slice]:
    """Slices of places with at most ``CHARS`` in all; a larger one is alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > CHARS:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, int]:
    """``(members, bits)``: the distinct (place, shingle hash) of all texts in order, the place in the upper ``bits``.

    A text shorter than ``SHINGLE`` is its own shingle, and an empty one a shingle too.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.concatenate((codes, np.zeros(SHINGLE, np.uint32))).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    h = np.zeros(len(codes) - SHINGLE + 1, np.uint64)
    for j, power in enumerate(_POWERS):
        h += codes[j:j + len(h)] * power
    short = np.flatnonzero(lengths < SHINGLE)
    own = np.zeros(len(short), np.uint64)
    for j, power in enumerate(_POWERS):
        own += np.where(j < lengths[short], codes[starts[short] + j], 0).astype(np.uint64) * power
    counts = np.maximum(lengths - SHINGLE + 1, 1)
    first = np.cumsum(counts) - counts
    h = h[np.arange(counts.sum()) + np.repeat(starts - first, counts)]
    h[first[short]] = own
    bits = max(len(texts) - 1, 0).bit_length()
    h = mixed(h) >> np.uint64(bits)
    if bits:
        h |= np.repeat(np.arange(len(texts), dtype=np.uint64), counts) << np.uint64(64 - bits)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))], bits


def places(members: np.ndarray, bits: int) -> np.ndarray:
    """The place of each member of ``shingle_sets``."""
    return (members >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(members), np.int64)


def signed_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Sizes of the shingle sets, their minima, and the keys of small sets."""
    members, bits = shingle_sets(texts)
    place = places(members, bits)
    size = np.bincount(place, minlength=len(texts))
    starts = np.cumsum(size) - size
    hashes = members << np.uint64(bits)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((len(texts), ROWS * BANDS), np.uint32)
    for i, (a, b) in enumerate(zip(_TIMES, _PLUS)):
        minima[:, i] = np.minimum.reduceat(upper * a + b, starts)
    # 40 bits of each hash, so that equal sets have equal sums however many lines were hashed together
    part = hashes >> np.uint64(24)
    total = np.add.reduceat(part, starts)
    few: list[np.ndarray | None] = [None] * len(texts)
    for i in np.flatnonzero(size <= SMALL).tolist():
        one = total[i] - part[starts[i]:starts[i] + size[i]]
        few[i] = mixed(np.concatenate((total[i:i + 1], one)))
    return size, minima, few


def sketches(minima: np.ndarray) -> np.ndarray:
    """64 bits of each row of minima: the lowest two of the first ``SKETCH``."""
    shifts = np.arange(0, 2 * SKETCH, 2, dtype=np.uint64)
    return np.bitwise_or.reduce((minima[:, :SKETCH].astype(np.uint64) & np.uint64(3)) << shifts, axis=1)


def sketches_agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether ``SKETCH_AGREE`` of the minima in two sketches agree."""
    differ = x ^ y
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return np.bitwise_count(differ) <= SKETCH - SKETCH_AGREE


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A key for each band of each row of minima."""
    return mixed((minima.reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + _BAND[:, 0])


def signatures(lines: DataFrame) -> DataFrame:
    """``(handle, n, sketch, keys)`` of each distinct line of ``(handle, norm)``: how many shingles it has, and a key for each band.

    Of two sets of at most ``SMALL`` shingles and a similarity of 0.8, neither has
    more than one that the other has not, so they share a key of small sets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for cut in cuts([len(t) for t in texts]):
                size, minima, few = signed_texts(texts[cut])
                bands = band_keys(minima)
                keys = [k if f is None else np.concatenate((k, f)) for k, f in zip(bands, few)]
                ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[cut], pa.array(size, pa.int32()), pa.array(sketches(minima).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64)))],
                    names=["handle", "n", "sketch", "keys"])

    found = lines.select("handle", "norm").mapInArrow(run, "handle long, n int, sketch long, keys array<bigint>")
    return found.groupBy("handle").agg(*(F.first(c).alias(c) for c in ("n", "sketch", "keys")))


def paired(rows: np.ndarray, cut: list[int], similarity: float) -> pa.RecordBatch:
    """``(key, a, b)`` for sorted ``rows`` of (key, n, handle, sketch): pairs without a key, and the members ``a`` of keys not paired fully.

    ``cut`` names keys that have rows elsewhere.
    """
    key, n, handle, sketch = rows
    at = np.arange(len(key))
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((starts, [len(key)])))
    start, size = np.repeat(starts, size), np.repeat(size, size)
    ahead = [at[:-k][key[k:] == key[:-k]] for k in range(1, NEIGHBOURS + 1)]
    late = np.flatnonzero(at - start > NEIGHBOURS)
    x = np.concatenate((*ahead, start[late]))
    y = np.concatenate((*(i + k for k, i in enumerate(ahead, 1)), late))
    able = np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y])
    able &= sketches_agree(sketch[x].view(np.uint64), sketch[y].view(np.uint64))
    x, y = handle[x[able]], handle[y[able]]
    members = np.flatnonzero((size > NEIGHBOURS + 1) | np.isin(key, cut))
    none = np.zeros(len(members), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((np.zeros(len(x), np.int64), key[members])), mask=np.arange(len(x) + len(members)) < len(x)),
         pa.array(np.concatenate((np.minimum(x, y), handle[members]))),
         pa.array(np.concatenate((np.maximum(x, y), none)), mask=np.arange(len(x) + len(members)) >= len(x))], names=["key", "a", "b"])


def neighbours(keyed: DataFrame, similarity: float) -> DataFrame:
    """``(key, a, b)``: pairs of lines near each other in a key, and members of large keys (see ``paired``).

    In each key a line is paired with its next ``NEIGHBOURS`` in order of size and
    hash and with the key's first, so small keys are paired fully and the rows stay
    linear in large ones; lines alone in their key give no row. Pairs whose
    sizes rule out the similarity, or whose sketches disagree, are left out. Rows are
    dealt by ranges of (key, size, handle), so a key that many lines share is spread
    over tasks; the keys at a range's ends count as large.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cut = np.empty((4, 0), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = np.concatenate((held, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "n", "handle", "sketch")])), axis=1)
            cut = int(held[0, 0]) if cut is None else cut
            if held.shape[1] < HELD:
                continue
            last = int(held[0, -1])
            whole = int(np.searchsorted(held[0], last))
            if not whole:  # one key fills what is held
                whole, cut = held.shape[1], last
            yield paired(held[:, :whole], [cut], similarity)
            held = held[:, whole:]
        if held.shape[1]:
            yield paired(held, [cut, int(held[0, -1])], similarity)

    dealt = keyed.repartitionByRange("key", "n", "handle").sortWithinPartitions("key", "n", "handle")
    return dealt.mapInArrow(run, "key long, a long, b long")


def similar(xs: list[str], ys: list[str], similarity: float) -> np.ndarray:
    """Whether each pair's shingle sets have a Jaccard similarity of at least ``similarity``."""
    out = [np.zeros(0, bool)]
    for cut in cuts([len(x) + len(y) for x, y in zip(xs, ys)]):
        (x, bits), (y, _) = shingle_sets(xs[cut]), shingle_sets(ys[cut])
        rows = len(xs[cut])
        both = np.sort(np.concatenate((x, y)))
        m, n, c = (np.bincount(places(s, bits), minlength=rows) for s in (x, y, both[1:][both[1:] == both[:-1]]))
        out.append(c >= similarity * (m + n - c))
    return np.concatenate(out)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets have a Jaccard similarity of at least ``similarity``.

    The sets are of whole lines; shingles are compared by hashes of 48 bits and more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = similar(batch.column(2).to_pylist(), batch.column(3).to_pylist(), similarity)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    both = pairs.join(texts.select(F.col("handle").alias("a"), F.col("norm").alias("x")), "a") \
        .join(texts.select(F.col("handle").alias("b"), F.col("norm").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def among(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose ``handle`` is in ``wanted``, and a few others, without a shuffle.

    A broadcast bitmap of the wanted lines drops nearly all other rows where they
    are read. An exact semi-join with what this returns, once written, drops the rest; in one
    plan the optimizer would move it below the filter.
    """
    return flagged(lines, wanted, F.col("handle"), "_near").filter("_near").select(*lines.columns)


def joined(key: int, handles: np.ndarray, comps: np.ndarray, texts: list[str], left: np.ndarray, right: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between ``left`` and ``right`` places that are in different components, verified by their texts.

    Lines that a link has joined are not compared again, so many near copies cost little. A pair that
    meets in several keys is compared in that of its first common band alone: there both are members too, or
    the key was small and paired fully.
    """
    comps = comps.copy()
    signed = [signed_texts(texts[cut])[:2] for cut in cuts([len(t) for t in texts])]
    n, minima = (np.concatenate(x) for x in zip(*signed))
    bands, key = band_keys(minima), np.uint64(key & (1 << 64) - 1)
    for i in range(0, len(left), 64):
        block = left[i:i + 64]
        able = (comps[block][:, None] != comps[right][None]) \
            & (np.minimum(n[block][:, None], n[right][None]) >= similarity * np.maximum(n[block][:, None], n[right][None]))
        x, y = np.nonzero(able)
        x, y = block[x], right[y]
        for j in range(0, len(x), 1 << 14):
            p, q = x[j:j + (1 << 14)], y[j:j + (1 << 14)]
            same = bands[p] == bands[q]
            here = (bands[p, same.argmax(axis=1)] == key) | ~same.any(axis=1)
            keep = here & (comps[p] != comps[q])
            p, q = p[keep], q[keep]
            keep = (minima[p] == minima[q]).sum(axis=1) >= AGREE * minima.shape[1]
            p, q = p[keep], q[keep]
            for cut in range(0, len(p), 1 << 10):
                a, b = p[cut:cut + (1 << 10)], q[cut:cut + (1 << 10)]
                apart = comps[a] != comps[b]
                a, b = a[apart], b[apart]
                good = similar([texts[k] for k in a.tolist()], [texts[k] for k in b.tolist()], similarity)
                a, b = a[good], b[good]
                if len(a):
                    yield np.minimum(handles[a], handles[b]), np.maximum(handles[a], handles[b])
                    root, node = star_edges(comps[a], comps[b])
                    order = np.argsort(node)
                    at = np.minimum(np.searchsorted(node[order], comps), len(node) - 1)
                    comps = np.where(node[order][at] == comps, root[order][at], comps)


def across(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: links between lines of a key ``(key, handle, comp)`` that are in different components.

    A key with more than ``PIECE`` members is cut into pieces by a hash, and each pair
    of pieces is a unit of its own, so no member is left out and none is collected with
    all others.
    """
    parts = members.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).select("key", F.ceil(F.col("_n") / PIECE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("handle", F.lit(7)), F.col("parts")).cast("int")
    dealt = members.join(parts, "key").select("key", "handle", "comp", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    dealt = dealt.select("key", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "handle", "comp")
    rows = dealt.join(texts.select("handle", "norm"), "handle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["key", "i", "j"]):
            key, i, j, part, handle, comp = (table.column(c).to_numpy() for c in ("key", "i", "j", "part", "handle", "comp"))
            norm = table.column("norm").to_pylist()
            new = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(key)]):
                at = np.arange(b - a)
                left = at[part[a:b] == i[a]]
                right = left if i[a] == j[a] else at[part[a:b] != i[a]]
                for x, y in joined(int(key[a]), handle[a:b], comp[a:b], norm[a:b], left, right, similarity):
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    order = ["key", "i", "j"]
    return rows.repartition(*order).sortWithinPartitions(*order).select(*order, "part", "handle", "comp", "norm") \
        .mapInArrow(run, "a long, b long").distinct()


def line_components(lines: DataFrame, similarity: float) -> DataFrame:
    """``(line, comp)`` for lines ``(line, handle, norm)`` that have a smaller line in their component.

    Lines in a large key that are not yet in one component are then compared across
    components, which leaves no pair of a key undecided. Rows between the steps carry
    64-bit handles; a handle that two different lines share is linked with nothing.
    """
    signed = written(signatures(lines), "signed")
    keyed = signed.select("handle", "n", "sketch", F.explode("keys").alias("key")).select("key", "n", "handle", "sketch")
    met = written(neighbours(keyed, similarity), "met")
    discard(signed)
    pairs = met.filter("b is not null").select("a", "b").distinct()
    large = met.filter("b is null").select("key", F.col("a").alias("handle"))
    ends = written(pairs.select(F.col("a").alias("handle")).union(pairs.select("b")).union(large.select("handle")).distinct(), "ends")
    near = written(among(lines.select("handle", "norm"), ends), "near")
    found = near.join(ends, "handle", "left_semi").withColumn("line", line_key(F.col("norm"))).groupBy("handle").agg(
        F.min("line").alias("line"), F.max("line").alias("last"), F.first("norm").alias("norm"))
    texts = written(found.filter("line = last").drop("last"), "texts")
    discard(near)
    discard(ends)
    links = written(verified(pairs, texts, similarity), "links")
    label = settled(lambda: components(links), "label")
    placed = written(large.join(label, large["handle"] == label["node"], "left").select(
        "key", "handle", F.coalesce("component_id", "handle").alias("comp")), "placed")
    discard(met)
    split = placed.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).filter("_x != _y").select("key")
    open_ = written(placed.join(split, "key", "left_semi"), "open")
    discard(placed)
    if not open_.isEmpty():
        extra = written(across(open_, texts, similarity), "more")
        if not extra.isEmpty():
            label = settled(lambda: components(links.unionByName(extra)), "label")
    named = texts.select("handle", "line")
    return label.join(named, label["node"] == named["handle"]).select("line", "component_id").join(
        named.select(F.col("handle").alias("component_id"), F.col("line").alias("comp")), "component_id").select("line", "comp")


def line_marks(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_row, pos, line, kept)`` of every line that is not blank; ``line`` is its 128-bit hash, ``_row`` the row's key.

    Of the lines in one component the one with the smallest (key, ``pos``) is kept: that of the smallest id.
    """
    lines = lines_of(docs, id_col, text_col).withColumns({"line": line_key(F.col("norm")), "handle": F.xxhash64("norm")})
    label = settled(lambda: line_components(lines, similarity), "line_components")
    placed = written(lines.select("_row", "pos", "line").join(label, "line", "left").select(
        "_row", "pos", "line", F.coalesce("comp", "line").alias("comp")), "placed")
    discard(label)
    best = placed.groupBy("comp").agg(F.min(F.struct("_row", "pos")).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    best = written(best.select("comp", F.col("best._row").alias("_keep"), F.col("best.pos").alias("_at")), "best")
    kept = F.col("_at").isNull() | ((F.col("_row") == F.col("_keep")) & (F.col("pos") == F.col("_at")))
    return placed.join(best, "comp", "left").select("_row", "pos", "line", kept.alias("kept"))


def line_dedup(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with every line but one of each component taken out of their texts.

    Lines are cut at newlines and compared after trimming and lower-casing, by
    the Jaccard similarity of their sets of 5-character shingles (a line shorter
    than that is one shingle). Lines linked directly or over others form a
    component; the one with the smallest (id, place in the document) stays as it
    was written. Equal lines always share a component; other links are found by
    banding, with a chance of 99.5 % at a similarity of exactly 0.8 and more
    above it; none is missed at 0.8 or above between lines of at most 9 shingles each.

    Blank lines stay. Null and empty texts stay as they are; a document may be left
    with an empty text but is not dropped. Rows that repeat an id with another text are
    documents of their own (of these the text's hash decides which keeps a line); rows equal in id and text are
    one document, and each is returned with the same lines. Null ids come last in the order of ids. All
    other columns are passed through, whatever their names; an empty table gives an empty result.
    """
    key, gone_key, gone_at, near = unused(docs.columns, "_row", "_gone_row", "_gone", "_near")
    gone = settled(lambda: line_marks(docs, similarity, id_col, text_col).filter("not kept").groupBy(
        F.col("_row").alias(gone_key)).agg(F.collect_set("pos").alias(gone_at)), "gone")
    # only rows that may have lost a line are shuffled to meet what they lost
    keyed = flagged(docs.withColumn(key, row_key(docs, id_col, text_col)), gone.withColumnRenamed(gone_key, key), F.xxhash64(key), near)
    joined = keyed.filter(near).join(gone, F.col(key) == F.col(gone_key), "left")
    lines = F.split(F.col(text_col), "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone_at, i)), "\n")
    text = F.when(F.col(gone_at).isNull(), F.col(text_col)).otherwise(left)
    cut = joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
    return keyed.filter(~F.col(near)).select(*docs.columns).unionByName(cut)


def line_digest(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_lines, n_removed, kept_sha256)`` of every input row: counts of lines that are not blank, and a digest of those kept.

    The digest is the SHA-256 of the kept lines' 128-bit hashes in lowercase hex, in order.
    """
    marks = line_marks(docs, similarity, id_col, text_col)
    # a set, since rows equal in id and text have the same lines
    counts = marks.groupBy(F.col("_row").alias("_of")).agg(F.array_sort(F.collect_set(F.struct("pos", "line", "kept"))).alias("_lines"))
    kept = F.filter("_lines", lambda x: x["kept"])
    hashes = F.array_join(F.transform(kept, lambda x: F.lower(F.hex(x["line"]))), "")
    found = counts.select("_of", F.size("_lines").cast("long").alias("n_lines"),
                          (F.size("_lines") - F.size(kept)).cast("long").alias("n_removed"), F.sha2(hashes, 256).alias("kept_sha256"))
    rows = docs.select(F.col(id_col).alias("_id"), row_key(docs, id_col, text_col).alias("_row"))
    zero = F.lit(0).cast("long")
    return rows.join(found, F.col("_row") == F.col("_of"), "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_lines", zero).alias("n_lines"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("kept_sha256", F.sha2(F.lit(""), 256)).alias("kept_sha256"))

"""Phrase collocations per language, counted with HAT-tries.

Tasks count phrases in HAT-tries: hash containers under a shallow trie of word ids,
which burst into a node when they grow too large. A full trie spills whole subtrees as
sorted runs; Spark deals the runs out by prefix, and the runs of a prefix partition are merged.

A frequent phrase lies in a hash bucket whose phrases together are frequent, and has
only frequent parts. So the tries count only what filters let through: passes before
them count phrases by bucket (the number of buckets follows the input), first words and pairs,
then triples of passing pairs, then longer ones. Filters are bitmaps of bounded
size, whose false hits cost time but change no count. Scores and the dropping of phrases inside
longer ones are joins over the frequent phrases.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenoscope.llm.common import written

#: Words of the longest phrase.
LONGEST = 5
#: Entries of a container before it bursts, of a task's tries before subtrees spill, and phrases gathered before they are added.
BURST, ENTRIES, GATHERED = 1 << 14, 1 << 19, 1 << 20
#: Words that a task numbers before it spills all and numbers anew.
VOCABULARY = 1 << 19
#: Bytes of text cut into words at once.
BLOCK = 1 << 20
#: Base-2 logarithm of the bits of a filter, at most (8 MB).
FILTER = 26
#: Buckets a word of the input, times the least count; bytes of text that count as one word.
SPARE, WORD_BYTES = 32, 6
#: Bucket counts that a task holds, and buckets of one row that it sends.
HELD, CHUNK = 1 << 20, 1 << 16
#: Prefix partitions of the runs, and how many of them share the phrases of one first word.
PREFIXES, SLICES = 4096, 16
#: Phrases of one batch of runs.
RUN = 1 << 17
#: Parts of a language's ranking before its best are ranked.
RANK_PARTS = 32

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + b"\t" + _BREAKS, _UPPER.lower() + b" " + b"." * len(_BREAKS))
_CUT = re.compile(rb"[ .]")
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


class Powers:
    """Powers of the hash's base and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> None:
        if len(self.up) < size:
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))))
                                  for b in (np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))))


class Cut:
    """The words of a block of text: starts, ends, numbers of their pieces, and hashes, by whole arrays."""

    def __init__(self, raw: bytes, powers: Powers):
        text = np.frombuffer(raw, np.uint8)
        apart = np.concatenate(([True], (text == 32) | (text == 46), [True]))
        self.raw = raw
        self.starts, self.ends = np.flatnonzero(apart[:-1] & ~apart[1:]), np.flatnonzero(~apart[:-1] & apart[1:])
        breaks = np.concatenate(([0], np.cumsum(text == 46)))
        self.pieces, self.breaks = breaks[self.starts], int(breaks[-1])
        powers.to(len(text) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[text] * powers.up[:len(text)])))
        self.hashes = (total[self.ends] - total[self.starts]) * powers.down[self.starts]

    def ids(self, used: np.ndarray, words: Words) -> np.ndarray:
        """The numbers in ``words`` of the words marked by ``used``, 0 for others.

        Words are looked up once for each distinct hash. All words of a hash are compared
        with the one that is looked up, by eight bytes at both ends, and whole where longer
        than that; if any differs every word is looked up.
        """
        out = np.zeros(len(used), np.int64)
        at = np.flatnonzero(used)
        if not len(at):
            return out
        _, first, rank = np.unique(self.hashes[at], return_index=True, return_inverse=True)
        first, starts, ends = at[first], self.starts, self.ends
        like = first[rank]
        found = np.array([words[self.raw[s:e]] for s, e in zip(starts[first].tolist(), ends[first].tolist())])
        padded = self.raw + bytes(8)
        eight = np.ndarray(len(self.raw) + 1, "<u8", padded, strides=(1,))
        size = ends - starts
        kept = np.uint64(8) * (np.uint64(8) - np.clip(size, 1, 8).astype(np.uint64))
        begin = eight[starts] & (_FULL >> kept)
        end = np.where(size > 8, eight[np.maximum(ends - 8, 0)], 0)
        same = (size[at] == size[like]) & (begin[at] == begin[like]) & (end[at] == end[like])
        long = at[(size[at] > 16) & (at != like)]
        if not same.all() or any(self.raw[starts[i]:ends[i]] != self.raw[starts[j]:ends[j]] for i, j in zip(long, like[np.searchsorted(at, long)])):
            out[at] = [words[self.raw[s:e]] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
        else:
            out[at] = found[rank]
        return out


class Words(dict):
    """Numbers a language's words from 1 in the order they are met."""

    def __init__(self):
        super().__init__()
        self.names = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number


def place(columns: Sequence[np.ndarray], seed: int, size: int) -> np.ndarray:
    """The bucket out of 2^``size`` of phrases given by the hashes of their words, column by column.

    Buckets of fewer bits are the first bits of those of more.
    """
    h = np.full(len(columns[0]), seed, np.uint64)
    for word in columns:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(_BASE) + word
    return (((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - size)).astype(np.int64)


def windows(values: np.ndarray, length: int) -> list[np.ndarray]:
    """Every run of ``length`` neighbours, column by column."""
    count = max(0, len(values) - length + 1)
    return [values[i:i + count] for i in range(length)]


class Box(dict):
    """A hash container: the remaining words of a phrase -> its count."""


class HatTrie:
    """Counts of phrases (tuples of word ids).

    The trie begins as one container. A container that grows over ``burst`` phrases
    of more than one remaining word becomes a node: a dictionary from the next
    word to a container of the rest, and from 0 to one for the phrase that ends there.
    """

    def __init__(self, burst: int):
        self.burst, self.root, self.size = burst, Box(), 0

    def add(self, columns: Sequence[np.ndarray], counts: np.ndarray) -> None:
        """Add phrases of one length, given column by column and sorted by the first ones."""
        self.root = self._add(self.root, [c.tolist() for c in columns], counts.tolist(), 0, len(counts))

    def _add(self, node: dict, columns: list[list[int]], counts: list[int], lo: int, hi: int) -> dict:
        if isinstance(node, Box):
            before = len(node)
            for key, n in zip(zip(*(c[lo:hi] for c in columns)) if columns else [()] * (hi - lo), counts[lo:hi]):
                node[key] = node.get(key, 0) + n
            self.size += len(node) - before
            return self._split(node) if len(node) > self.burst and len(columns) > 1 else node
        if not columns:  # phrases that end here
            node[0] = self._add(node.get(0) or Box(), columns, counts, lo, hi)
            return node
        first, rest = columns[0], columns[1:]
        while lo < hi:
            word, at = first[lo], lo + 1
            while at < hi and first[at] == word:
                at += 1
            node[word] = self._add(node.get(word) or Box(), rest, counts, lo, at)
            lo = at
        return node

    def _split(self, box: Box) -> dict:
        node: dict[int, Box] = {}
        for key, n in box.items():
            node.setdefault(key[0] if key else 0, Box())[key[1:]] = n
        return {w: self._split(b) if len(b) > self.burst and any(len(k) > 1 for k in b) else b for w, b in node.items()}

    def spill(self, keep: int) -> Iterator[list[tuple[tuple[int, ...], int]]]:
        """Take out whole subtrees, largest first, until at most ``keep`` phrases are left."""
        if isinstance(self.root, Box):
            taken = [(k, n) for k, n in self.root.items()] if self.size > keep else []
            self.root = Box() if taken else self.root
            self.size -= len(taken)
            if taken:
                yield taken
            return
        for word in sorted(self.root, key=lambda w: self._count(self.root[w]), reverse=True):
            if self.size <= keep:
                return
            taken = [((word, *k), n) for k, n in self._walk(self.root.pop(word))]
            self.size -= len(taken)
            yield taken

    def _count(self, node: dict) -> int:
        return len(node) if isinstance(node, Box) else sum(map(self._count, node.values()))

    def _walk(self, node: dict) -> Iterator[tuple[tuple[int, ...], int]]:
        if isinstance(node, Box):
            yield from node.items()
        else:
            for word, below in node.items():
                yield from (((word, *k) if word else k, n) for k, n in self._walk(below))


def blocks(texts: Iterator[bytes | None], block: int) -> Iterator[tuple[bytes, bool]]:
    """Texts with letters and separators mapped, joined by breaks to some ``block`` bytes.

    A longer text is cut between words; True says that the next block goes on with it.
    """
    held, size = [], 0
    for text in texts:
        raw, start = (text or b"").translate(_TABLE), 0
        while len(raw) - start > block and (cut := _CUT.search(raw, start + block)):
            yield b".".join([*held, raw[start:cut.start()]]), True
            held, size, start = [], 0, cut.start()
        held.append(raw[start:])
        size += len(held[-1])
        if size > block:
            yield b".".join(held), False
            held, size = [], 0
    if held:
        yield b".".join(held), False


def grouped(columns: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` in ascending order, and how often each occurs."""
    rank = columns[0]
    for c in columns[1:]:  # ranks stay under the number of rows, so the products fit 64 bits
        _, rank = np.unique(rank, return_inverse=True)
        rank = rank * (int(c.max(initial=0)) + 1) + c
    _, first, counts = np.unique(rank, return_index=True, return_counts=True)
    return [c[first] for c in columns], counts


def passing(hashes: np.ndarray, pieces: np.ndarray, seed: int, filters: Mapping[int, np.ndarray], longest: int) -> dict[int, np.ndarray]:
    """By length, whether the phrase that starts at a word lies in one piece and passes the filters with all its parts."""
    out = {}
    for length in range(1, longest + 1):
        ends = windows(pieces, length)
        fine = ends[0] == ends[-1]
        if length > 1:
            fine &= out[length - 1][:-1] & out[length - 1][1:] if len(fine) else fine
        if length in filters:
            bits = filters[length]
            p = place(windows(hashes, length), seed, len(bits).bit_length() + 2)
            fine &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        out[length] = fine
    return out


class Reader:
    """The blocks of ``(lang, text)`` batches as word hashes and pieces, with the last words of a block that a text goes on from."""

    def __init__(self, block: int, carry: int):
        self.block, self.carry, self.powers = block, carry, Powers()

    def read(self, batch: pa.RecordBatch) -> Iterator[tuple[str, int, Cut, np.ndarray, np.ndarray, int, bool]]:
        """(language, seed, block, hashes and pieces with the carried words first, how many those are, whether the text goes on)."""
        by_lang: dict[str, list[int]] = {}
        for i, lang in enumerate(batch.column(0).to_pylist()):
            by_lang.setdefault(lang, []).append(i)
        texts = batch.column(1).cast(pa.binary())
        for lang, at in by_lang.items():
            seed = xxhash.xxh32_intdigest(lang.encode())
            hashes, pieces = np.empty(0, np.uint64), np.empty(0, np.int64)
            for raw, goes_on in blocks((texts[i].as_py() for i in at), self.block):
                cut, carried = Cut(raw, self.powers), len(hashes)
                hashes, pieces = np.concatenate((hashes, cut.hashes)), np.concatenate((pieces, cut.pieces))
                yield lang, seed, cut, hashes, pieces, carried, goes_on
                keep = min(self.carry, len(hashes)) if goes_on else 0
                hashes, pieces = hashes[len(hashes) - keep:], pieces[len(pieces) - keep:] - cut.breaks


def bucket_rows(buckets: np.ndarray, counts: np.ndarray, least: int) -> pa.RecordBatch:
    """Sorted buckets and counts as rows ``(chunk, cells)``: places in the chunk, then counts of ``least`` at most.

    Where a count is cut the sum still reaches ``least``, so what is compared with it stays exact.
    """
    kind = np.uint8 if least < 256 else np.uint32
    chunk, counts = buckets // CHUNK, np.minimum(counts, least).astype(kind)
    edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
    inside = (buckets % CHUNK).astype(np.uint16)
    cells = [inside[i:j].tobytes() + counts[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]
    return pa.RecordBatch.from_arrays([pa.array(chunk[edges[:-1]]), pa.array(cells, pa.binary())], names=["chunk", "cells"])


def bucket_filter(rows: DataFrame, lengths: Sequence[int], filters: Mapping[int, np.ndarray], size: int, least: int, block: int,
                  held: int) -> np.ndarray:
    """A filter with those of 2^``size`` buckets that hold ``least`` phrases of the given lengths.

    Only phrases that pass ``filters`` are counted. Tasks send counts by bucket; a chunk
    of buckets is added up row by row in Spark.
    """
    shared = rows.sparkSession.sparkContext.broadcast(dict(filters))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            buckets, counts = (np.concatenate(c) for c in zip(*pending))
            order = np.argsort(buckets, kind="stable")
            buckets, counts = buckets[order], counts[order]
            first = np.flatnonzero(np.diff(buckets, prepend=-1))
            return buckets[first], np.add.reduceat(counts, first) if len(first) else counts

        reader = Reader(block, max(lengths) - 1)
        for batch in batches:
            for _, seed, _, hashes, pieces, carried, _ in reader.read(batch):
                fine = passing(hashes, pieces, seed, shared.value, max(lengths))
                for length in lengths:
                    fine[length][:max(0, carried - length + 1)] = False
                    pending.append(np.unique(place([c[fine[length]] for c in windows(hashes, length)], seed, size), return_counts=True))
                if sum(len(b) for b, _ in pending) > 2 * held:
                    pending = [summed()]
                    if len(pending[0][0]) > held:
                        yield bucket_rows(*pending[0], least)
                        pending = []
        if pending:
            yield bucket_rows(*summed(), least)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(np.uint8 if least < 256 else np.uint32)
        counts, current = np.zeros(CHUNK, np.int64), None

        def hits() -> pa.RecordBatch:
            found = np.flatnonzero(counts >= least) + current * CHUNK
            return pa.RecordBatch.from_arrays([pa.array(found >> max(0, size - FILTER))], names=["p"])

        for batch in batches:
            for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if chunk != current:
                    if current is not None:
                        yield hits()
                    counts[:], current = 0, chunk
                n = len(cells) // (2 + kind.itemsize)
                counts[np.frombuffer(cells, np.uint16, n)] += np.frombuffer(cells, kind, n, 2 * n)
        if current is not None:
            yield hits()

    sent = rows.mapInArrow(count, "chunk long, cells binary").repartition("chunk").sortWithinPartitions("chunk")
    return bitmap(sent.mapInArrow(merge, "p long"), min(size, FILTER))


def bitmap(places: DataFrame, size: int) -> np.ndarray:
    """2^``size`` bits, those in ``(p)`` set. Put together in Spark; 2^(``size`` - 15) rows of 4 KB reach the driver."""
    width = 32768
    merged = places.select(F.floor(F.col("p") / width).alias("bucket"), F.pmod("p", F.lit(width)).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << size) // 8, np.uint8)
    for row in merged.collect():
        out[row.bucket * width // 8:(row.bucket + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def runs_of(lang: str, names: list[bytes], subtrees: Iterator[list[tuple[tuple[int, ...], int]]]) -> Iterator[pa.RecordBatch]:
    """Spilled subtrees as rows ``(prefix, lang, phrases, counts)``: the sorted run of a prefix partition each."""
    parts: dict[int, list[tuple[bytes, int]]] = {}
    held = 0

    def rows() -> pa.RecordBatch:
        for part in parts.values():
            part.sort()
        phrases = [[p for p, _ in part] for part in parts.values()]
        return pa.RecordBatch.from_arrays([
            pa.array(list(parts), pa.int32()), pa.array([lang] * len(parts)), pa.array(phrases, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
            pa.array([[n for _, n in part] for part in parts.values()], pa.list_(pa.int64()))], names=["prefix", "lang", "phrases", "counts"])

    for taken in subtrees:
        for key, n in taken:
            phrase = b" ".join([names[i] for i in key])
            prefix = (zlib.crc32(names[key[0]]) + zlib.crc32(phrase) % SLICES * (PREFIXES // SLICES)) % PREFIXES
            parts.setdefault(prefix, []).append((phrase, n))
            held += 1
            if held == RUN:
                yield rows()
                parts, held = {}, 0
    if parts:
        yield rows()


def counted(rows: DataFrame, filters: Mapping[int, np.ndarray], least: int, burst: int, entries: int, gathered: int,
            vocabulary: int, block: int) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases in ``(lang, text)`` that pass the filters and occur ``least`` times.

    Under the empty phrase there is the number of all words of a language.
    """
    longest = max(filters)
    shared = rows.sparkSession.sparkContext.broadcast(dict(filters))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Words] = {}
        tries: dict[str, HatTrie] = {}
        totals: dict[str, int] = {}
        waiting: dict[tuple[str, int], list[list[np.ndarray]]] = {}
        waits = 0

        def added() -> None:
            for (lang, _), parts in waiting.items():
                tries[lang].add(*grouped([np.concatenate(c) for c in zip(*parts)]))
            waiting.clear()

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            size = sum(t.size for t in tries.values())
            for lang, trie in tries.items():
                yield from runs_of(lang, words[lang].names, trie.spill(trie.size * keep // max(1, size)))

        reader = Reader(block, longest - 1)
        for batch in batches:
            tail = np.empty(0, np.int64)
            for lang, seed, cut, hashes, pieces, carried, goes_on in reader.read(batch):
                if lang not in words:
                    words[lang], tries[lang] = Words(), HatTrie(burst)
                totals[lang] = totals.get(lang, 0) + len(hashes) - carried
                fine = passing(hashes, pieces, seed, shared.value, longest)
                used = fine[1].copy()
                used[max(0, len(used) - longest + 1):] |= goes_on  # the next block needs their numbers
                ids = np.concatenate((tail, cut.ids(used[carried:], words[lang])))
                for length, starts in fine.items():
                    starts[:max(0, carried - length + 1)] = False
                    if starts.any():
                        waiting.setdefault((lang, length), []).append([c[starts] for c in windows(ids, length)])
                        waits += int(np.count_nonzero(starts))
                tail = ids[max(0, len(ids) - longest + 1):] if goes_on else ids[:0]
                full = sum(map(len, words.values())) > vocabulary
                if waits > gathered or full:
                    added()
                    waits = 0
                if full:
                    names = [words[lang].names[i] for i in tail]
                    yield from spilled(0)
                    words, tries = {lang: Words()}, {lang: HatTrie(burst)}
                    tail = np.array([words[lang][w] for w in names], np.int64)
                elif sum(t.size for t in tries.values()) > entries:
                    yield from spilled(entries // 2)
        added()
        yield from spilled(0)
        if totals:
            yield pa.RecordBatch.from_arrays([
                pa.array([-1] * len(totals), pa.int32()), pa.array(list(totals)), pa.array([[""]] * len(totals)),
                pa.array([[n] for n in totals.values()])], names=["prefix", "lang", "phrases", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        current = None

        def found() -> pa.RecordBatch:
            kept = [(p, n) for p, n in counts.items() if n >= least or not p]
            return pa.RecordBatch.from_arrays([pa.array([current[1]] * len(kept), pa.string()), pa.array([p for p, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], names=["lang", "phrase", "n"])

        for batch in batches:
            prefixes, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, key in enumerate(zip(prefixes, langs)):
                if key != current:
                    if current is not None:
                        yield found()
                    counts, current = {}, key
                for p, n in zip(batch.column(2)[i].as_py(), batch.column(3)[i].as_py()):
                    counts[p] = counts.get(p, 0) + n
        if current is not None:
            yield found()

    runs = rows.mapInArrow(count, "prefix int, lang string, phrases array<string>, counts array<bigint>")
    return runs.repartition("prefix", "lang").sortWithinPartitions("prefix", "lang").mapInArrow(merge, "lang string, phrase string, n long")


def frequent_phrases(rows: DataFrame, least: int, longest: int = LONGEST, burst: int = BURST, entries: int = ENTRIES,
                     gathered: int = GATHERED, vocabulary: int = VOCABULARY, block: int = BLOCK, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, f)`` of all phrases of up to ``longest`` words that occur ``least`` times, and ``(lang, n)``.

    ``rows`` is ``(lang, text)``, read once for its size, once for the buckets of words and pairs,
    once for those of triples, once for those of longer phrases, and once to count.
    """
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    size = max(16, (total // WORD_BYTES * SPARE // least).bit_length())
    filters: dict[int, np.ndarray] = {}
    for lengths in ([1, 2], [3], list(range(4, longest + 1))):
        lengths = [k for k in lengths if k <= longest]
        if lengths and (not filters or filters[max(filters)].any()):
            bits = bucket_filter(rows, lengths, filters, size, least, block, held)
            filters |= {k: bits for k in lengths}
    found = counted(rows, filters, least, burst, entries, gathered, vocabulary, block)
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    kept = written(found.select("lang", "phrase", words.alias("k"), F.col("n").alias("f")), "frequent")
    return kept.filter("k > 0"), kept.filter("k = 0").select("lang", F.col("f").alias("n"))


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, k, a, l, r, n, score)`` of phrases of two words and more, by their lowest-scoring cut.

    The score is floor(1000 * a * n / (l * r)); products are decimals of 38 digits, so
    it is exact for counts up to some 10^17. Of equal scores the earliest cut counts.
    """
    words = F.split("phrase", " ")
    cuts = frequent.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("words")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", F.array_join(F.slice("words", 1, F.col("cut")), " ").alias("first"),
                       F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    both = cuts.join(frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
        .join(frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]) \
        .join(totals, "lang")
    wide = lambda c: c.cast("decimal(19,0)")
    score = F.call_function("div", wide(1000 * F.col("a")) * wide(F.col("n")), wide(F.col("l")) * wide(F.col("r")))
    best = both.withColumn("score", score).groupBy("lang", "phrase", "k", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score")


def outermost(frequent: DataFrame, candidates: DataFrame, inside_percent: int) -> DataFrame:
    """The candidates that lie in no longer frequent phrase with at least ``inside_percent`` % of their occurrences."""
    words = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    inside = frequent.filter("k > 2").select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return candidates.join(most, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, inside_percent: int = 100, longest: int = LONGEST,
                 text_col: str = "text", lang_col: str = "lang", **limits: int) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of 2 to ``longest`` words of every language.

    A-Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. ``n`` counts all words of the language, ``a`` the
    phrase's occurrences within pieces (overlaps included, ``least`` at least), ``l`` and
    ``r`` those of its two parts at the lowest-scoring cut. Phrases that lie in a longer
    frequent one with ``inside_percent`` % of their occurrences are left out; of the others
    a language's first ``top`` are returned, by score and ``a`` descending, then by
    phrase in byte order, so ties have one order.

    Null texts are empty and null languages are ``und``; rows that repeat a text count
    each. Empty, blank and separator-only texts add nothing; texts of any length are read whole, in
    blocks. Phrases do not cross documents. A language without a frequent phrase, and
    an empty table, give no row. Other columns are not read. ``limits`` are those of
    ``frequent_phrases`` (container, trie, vocabulary and block sizes); results do not depend on them.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    frequent, totals = frequent_phrases(rows, least, longest, **limits)
    candidates = written(outermost(frequent, scored(frequent, totals), inside_percent), "candidates")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = candidates.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB, at the production parameters.
ORACLE_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
cut AS (SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \\t]+') IF w <> ''] AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM cut, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM f WHERE f >= 100),
cuts AS (
    SELECT lang, phrase, k, f AS a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1)),
scored AS (
    SELECT c.lang, c.phrase, c.k, c.a, x.f AS l, y.f AS r, n.n,
        ((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score, cut
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.first
    JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM frequent g WHERE g.lang = b.lang AND g.k > b.k AND 100 * g.f >= 100 * b.a
        AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
SELECT * FROM ranked WHERE rank <= 2000
"""

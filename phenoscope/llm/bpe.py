"""Byte-level BPE encoding and decoding by walking a trie of distinct words.

The words of a block of documents are inserted into a trie, stored as a sorted
list: the path shared by neighbouring words is the part of the trie already
walked. The depth-first walk gives every node (a prefix of a word) one state,
the last token of the prefix's encoding. A prefix ending at byte ``i`` has last
token ``t`` exactly if ``t`` ends there and is compatible with the last token
of the prefix before it, so states of shared prefixes are computed once, and a
word's encoding is read back from its end.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice
from pathlib import Path
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the published pattern that cuts text before the merges
#: (alternatives that start with different characters may stand in any order).
PIECE = regex.compile(r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                      r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
NEIGHBOURS = re.compile(r"\s\s")
#: Distinct words whose encodings a worker keeps; beyond it the store starts anew.
KEPT_WORDS = 700_000
#: Characters of text handled at once; a longer text is a block of its own.
BLOCK_CHARS = 1_000_000
_NEVER = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable symbol that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary, as tables over token ids.

    ``left``/``right`` hold, for each token, the tokens on its left and right
    edge from single byte to whole, each with the rank of the merge that uses
    it up. ``usable`` maps bytes to the tokens that their own bytes encode to,
    and ``ends`` finds those that end at each byte of a word, longest first.
    """

    token_bytes: dict[int, bytes]
    rank: dict[tuple[int, int], int]
    left: dict[int, list[tuple[int, int]]]
    right: dict[int, list[tuple[int, int]]]
    special: dict[str, int]
    usable: dict[bytes, int] = field(default_factory=dict)
    ends: ahocorasick.Automaton | None = None
    fits: dict[int, bool] = field(default_factory=dict)
    known: dict[str, bytes] = field(default_factory=dict)
    of_unit: dict[str, bytes] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str) -> Vocabulary:
        """From the JSON text of a ``tokenizers`` file of byte-level BPE."""
        data = json.loads(text)
        symbols = byte_symbols()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = {bytes(symbols[c] for c in token): i for token, i in data["model"]["vocab"].items()
               if token not in special}
        token_bytes = {i: b for b, i in ids.items()}
        made: dict[int, tuple[int, int, int]] = {}
        rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y = (ids[bytes(symbols[c] for c in s)] for s in (a, b))
            rank.setdefault((x, y), r)
            made.setdefault(ids[token_bytes[x] + token_bytes[y]], (r, x, y))
        out = cls(token_bytes | {i: s.encode() for s, i in special.items()}, rank, {}, {}, special)
        for token in sorted(token_bytes, key=lambda t: made.get(t, (-1,))[0]):
            if token not in made:
                if len(token_bytes[token]) == 1:
                    out.left[token] = out.right[token] = [(token, _NEVER)]
                    out.usable[token_bytes[token]] = token
                continue
            r, x, y = made[token]
            if x not in out.left or y not in out.left:
                continue
            out.left[token] = [*out.left[x][:-1], (x, r), (token, _NEVER)]
            out.right[token] = [*out.right[y][:-1], (y, r), (token, _NEVER)]
            if out.whole(x, y, r):
                out.usable[token_bytes[token]] = token
        out.ends = ahocorasick.Automaton()
        for b, token in out.usable.items():
            out.ends.add_word(b.decode("latin-1"), (token, len(b)))
        out.ends.make_automaton()
        return out

    def meets(self, a: int, b: int, below: int) -> bool:
        """Whether merges of rank under ``below`` join something across the border of ``a`` and ``b``."""
        edge, other = self.right[a], self.left[b]
        i = j = 0
        while True:
            (x, x_goes), (y, y_goes) = edge[i], other[j]
            r = self.rank.get((x, y), _NEVER)
            if r < below and r < x_goes and r <= y_goes:  # of equal ranks the left one goes first
                return True
            if min(x_goes, y_goes) >= below:
                return False
            if x_goes <= y_goes:
                i += 1
            else:
                j += 1

    def whole(self, a: int, b: int, r: int) -> bool:
        """Whether the bytes of the token merged from ``a`` and ``b`` encode to that token."""
        return (self.token_bytes[a] in self.usable and self.token_bytes[b] in self.usable
                and not self.meets(a, b, r))

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay side by side in an encoding."""
        if len(self.fits) > 3_000_000:
            self.fits.clear()
        fit = self.fits[a << 20 | b] = not self.meets(a, b, _NEVER)
        return fit

    def encode_words(self, words: Iterable[str]) -> None:
        """Add the encodings of ``words`` to ``known``, walking their trie depth first."""
        last, size = [-1], [0]  # of each prefix of the current path: last token, its length
        before, fits, fitting = "", self.fits, self.compatible
        for path in sorted(w.encode("utf-8", "surrogatepass").decode("latin-1") for w in words):
            shared = 0
            for x, y in zip(before, path):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            done = shared
            for at, (token, n) in self.ends.iter(path):
                if at < done:
                    continue  # this prefix has its state
                start = at + 1 - n
                if start:
                    fit = fits.get(last[start] << 20 | token)
                    if not (fitting(last[start], token) if fit is None else fit):
                        continue
                last.append(token)
                size.append(n)
                done += 1
            ids, end = [], len(path)
            while end:
                ids.append(last[end])
                end -= size[end]
            ids.reverse()
            self.known[path.encode("latin-1").decode("utf-8", "surrogatepass")] = pack(f"<{len(ids)}I", *ids)
            before = path

    def encode_units(self, units: set[str]) -> None:
        """Add the encodings of ``units`` (strings that the merges never reach across) to ``of_unit``."""
        for store in (self.known, self.of_unit):
            if len(store) > KEPT_WORDS:
                for old in list(islice(store, KEPT_WORDS // 2)):
                    del store[old]
        cut = {u: PIECE.findall(u) for u in units.difference(self.of_unit)}
        self.encode_words({w for words in cut.values() for w in words}.difference(self.known))
        get = self.known.__getitem__
        for unit, words in cut.items():
            self.of_unit[unit] = b"".join(map(get, words))

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A single space between two other characters always starts a new piece,
        so a text without neighbouring white space is cut there, and only
        distinct units go through the pattern.
        """
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        work: list[list[list[str]]] = []
        for text in texts:
            parts = cut.split(text) if cut and any(s in text for s in self.special) else [text]
            work.append([[p] if i % 2 else PIECE.findall(p) if NEIGHBOURS.search(p) else p.replace(" ", "\0 ").split("\0")
                         if "\0" not in p else PIECE.findall(p) for i, p in enumerate(parts)])
        self.encode_units({u for parts in work for units in parts[::2] for u in units})
        get = self.of_unit.__getitem__
        return [b"".join(pack("<I", self.special[p[0]]) if i % 2 else b"".join(map(get, p))
                         for i, p in enumerate(parts)) for parts in work]

    def decode(self, ids: bytes) -> str:
        """Text of ids as ``encode_block`` gives them; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def load(text: str) -> Vocabulary:
    """The vocabulary of this JSON text, built once per worker."""
    if text not in _LOADED:
        _LOADED[text] = Vocabulary.from_json(text)
    return _LOADED[text]


def bpe_encode_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per input row: ``(id, n_tokens, ids, decoded)``.

    ``ids`` is binary, little-endian unsigned 32-bit integers, equal to the ids
    of the ``tokenizers`` library without added special tokens (a special
    token's string inside a text gives its id). ``decoded`` is the text of
    those ids.

    ``vocabulary_path`` is a byte-level BPE file read on the driver; its content
    (a fixed few MB) is broadcast. Rows need no shuffle. A null or empty text
    has no tokens and decodes to the empty text; a null id stays null; repeated
    rows give repeated rows; other columns are not read.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(Path(vocabulary_path).read_text(encoding="utf-8"))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(content.value)
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.compute.utf8_length(texts).to_pylist()
            start = 0
            while start < batch.num_rows:
                end, size = start + 1, sizes[start]
                while end < batch.num_rows and size + sizes[end] <= BLOCK_CHARS:
                    size += sizes[end]
                    end += 1
                ids = vocabulary.encode_block(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, end - start), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array(map(vocabulary.decode, ids), pa.string())],
                    names=["_id", "n_tokens", "ids", "decoded"])
                start = end

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)

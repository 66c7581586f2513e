"""Phrase collocations against a count by hand."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_support import documents, odd_texts, text
from phenoscope.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def by_hand(rows, least, top, percent=100, longest=5):
    """``rows`` of (text, lang) -> the expected tuples."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = {}, Counter()
    for body, lang in rows:
        lang = "und" if lang is None else lang
        counts = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (body or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if c >= least}
        found = []
        for p, a in frequent.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * c >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                                 for q, c in frequent.items()):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:i]] * counts[p[i:]]), i) for i in range(1, len(p))]
            score, i = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:i]], counts[p[i:]]))
        out += [(lang, at + 1, p.decode(), -a, left, right, n[lang], -score)
                for at, (score, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(t, lang, k, "x", 1) for k, (t, lang) in enumerate(rows)],
                               "text string, lang string, doc_id long, phrase string, n int")
    out = C.collocations(df.repartition(3), **options)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


LANGS = ["en", "de", None, "und", "ü"]


def corpus():
    rows = [(text(i % 9, 60 + i).replace(" ka", ". KA", 3), LANGS[i % 5]) for i in range(40)]
    rows += [("a a a a a a a, a a", "en")] * 3 + [("new york\tcity hall; New  York city", "en")] * 4
    return rows + [(t, "en") for _, t in odd_texts() if t is None or len(t) < 5000] + [("\x1c\x85 \u00a0 \x00 x", "en")] * 4


SMALL = {"burst": 3, "entries": 12, "vocabulary": 40, "block": 64, "held": 9, "gathered": 5}


@pytest.mark.parametrize("limits", [{}, SMALL], ids=["production", "small"])
def test_like_a_count_by_hand(spark, limits):
    """Small limits make containers burst, subtrees spill, words be numbered anew and texts be cut."""
    rows = corpus()
    assert run(spark, rows, least=4, top=30, **limits) == by_hand(rows, 4, 30)


def test_longer_phrases_by_share_and_other_lengths(spark):
    rows = corpus()
    assert run(spark, rows, least=3, top=50, inside_percent=60, longest=3) == by_hand(rows, 3, 50, 60, 3)


def test_equal_scores_in_byte_order(spark):
    rows = [(" . ".join([f"{w} z{w}"] * 5), "en") for w in ("b", "a", "ü", "z", "\U0001f600", "\uffff")]
    found = run(spark, rows, least=5, top=4)
    assert [r[2] for r in found] == ["a za", "b zb", "z zz", "ü zü"] and found == by_hand(rows, 5, 4)


def test_very_long_text_and_no_rows(spark):
    rows = [("one two " * 150_000, "en")]
    assert run(spark, rows, least=1000, top=9, block=1 << 14) == by_hand(rows, 1000, 9)
    assert run(spark, [(None, None), ("", "en"), (" ,;\n", "de")], least=1) == []
    docs = documents(spark, odd_texts())
    assert C.collocations(docs.filter(F.lit(False))).collect() == []
    assert C.collocations(docs, least=10_000_000).collect() == []


def test_scores_over_64_bits(spark):
    n, a, left, right = 9 * 10**16 + 7, 8 * 10**15 + 3, 8 * 10**15 + 5, 9 * 10**15 + 1
    frequent = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    (row,) = C.scored(frequent, totals).collect()
    assert row.score == 1000 * a * n // (left * right)


def test_buckets_are_added_up():
    import numpy as np
    batch = C.bucket_rows(np.array([0, 1, 65535, 65536, 1 << 20]), np.array([1, 300, 5, 7, 2]), 100).to_pydict()
    assert batch["chunk"] == [0, 1, 16] and [len(c) for c in batch["cells"]] == [9, 3, 3]
    assert list(np.frombuffer(batch["cells"][0], np.uint8, 3, 6)) == [1, 100, 5]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    import numpy as np
    raw = b"one two one abcdefgh-rest-of-a-long-word abcdefgh-tset-of-a-long-word two x"
    for hashes in (None, [1, 1, 1, 2, 2, 1, 1], [1, 2, 1, 3, 3, 2, 4]):
        cut, words = C.Cut(raw, C.Powers()), C.Words()
        if hashes:
            cut.hashes = np.array(hashes, np.uint64)
        ids = cut.ids(np.array([True] * 6 + [False]), words)
        assert [words.names[i] for i in ids] == raw.split()[:6] + [b""]


def test_trie_bursts_and_spills():
    import numpy as np
    trie = C.HatTrie(burst=2)
    cols = [np.array([1, 1, 1, 2]), np.array([1, 1, 2, 1]), np.array([1, 2, 1, 1])]
    trie.add(cols, np.array([1, 2, 3, 4]))
    trie.add(cols, np.array([1, 1, 1, 1]))
    assert not isinstance(trie.root, C.Box) and trie.size == 4
    spilled = list(trie.spill(1))
    assert [dict(s) for s in spilled] == [{(1, 1, 1): 2, (1, 1, 2): 3, (1, 2, 1): 4}] and trie.size == 1
    trie.add([np.array([2])], np.array([6]))
    for _ in range(2):
        trie.add([np.array([2, 2, 2]), np.array([1, 3, 4])], np.array([1, 1, 1]))
    assert [dict(s) for s in trie.spill(0)] == [{(2, 1, 1): 5, (2,): 6, (2, 1): 2, (2, 3): 2, (2, 4): 2}] and trie.size == 0

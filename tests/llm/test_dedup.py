"""Exact, substring, SimHash and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_support import closure, documents, odd_texts, text
from phenoscope.llm import common, exact_dedup, line_dedup, simhash, substring_dedup


def near_copies(spark, n=40):
    rnd = random.Random(8)
    rows = odd_texts()
    base = text(50, 140)
    for i in range(20, 20 + n):
        words = base.split()
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(len(words))] = "edit%d" % rnd.randrange(5)
        rows.append((i, " ".join(words)))
    rows += [(100 + i, text(300 + i, 30) + " " + text(51, 60) + " " + text(400 + i, 30)) for i in range(10)]
    return documents(spark, rows), rows


def test_exact_dedup(spark):
    docs, rows = near_copies(spark)
    got = exact_dedup.exact_dedup(docs).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    assert len(got) == len(rows)
    expected = []
    for i, t in rows:
        members = groups[norm(t)]
        keep = min(members)[2]
        expected.append((i, keep, len(members), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_exact_dedup_keeps_collided_texts_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: exact_dedup.F.substring(exact_dedup.F.sha2(c, 256), 1, 2))
    rows = [(i, f"text {i % 300}") for i in range(600)]
    got = exact_dedup.exact_dedup(documents(spark, rows)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, i % 300, 2) for i, _ in rows}


def substring_brute(rows, k):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - k + 1):
            key = tuple(w[s:s + k])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            if i is not None and first.get(tuple(w[s:s + k]), i) < i:
                gone[s:s + k] = [True] * k
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("k,part", [(50, 25), (8, 3), (5, 5)])
def test_substring_dedup(spark, k, part):
    docs, rows = near_copies(spark)
    got = [tuple(r) for r in substring_dedup.substring_dedup(docs, k, part).select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(map(str, got)) == sorted(map(str, substring_brute(rows, k)))


def test_substring_dedup_over_block_borders(spark, monkeypatch):
    for size in (16, 23):
        pieces = [substring_dedup.paths_of(b" ".join(w), 8, 4) for _, w in _cut(monkeypatch, size, text(9, 200))]
        assert sum(n for p in pieces for _, n, *_ in p) == 200 - 8 + 1


def _cut(monkeypatch, size, line):
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", size)
    return list(substring_dedup._blocks(line, 8))


def test_repeated_words_and_ties(spark):
    rows = [(1, "a " * 200), (2, "a " * 90), (3, "a b " * 80), (4, "b a " * 60), (5, "a " * 49)]
    got = [tuple(r) for r in substring_dedup.substring_dedup(documents(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(got) == sorted(substring_brute(rows, 50))


def fingerprint_brute(t, n=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bits", [0, 1, 4, 7])
def test_simhash_links(spark, bits):
    docs, rows = near_copies(spark)
    got = simhash.simhash_dedup(docs, max_bits=bits).collect()
    marks = [(i, fingerprint_brute(t)) for i, t in rows]
    assert sorted(map(str, ((r.doc_id, int(r.fingerprint, 16)) for r in got))) == sorted(map(str, marks))
    places = range(len(marks))
    order = sorted(places, key=lambda p: (marks[p][0] is None, marks[p][0] or 0))
    rank = {p: r for r, p in enumerate(order)}
    label = closure(list(places), lambda a, b: (marks[a][1] ^ marks[b][1]).bit_count() <= bits)
    best = {c: min((p for p in places if label[p] == c), key=rank.get) for c in set(label.values())}
    expected = sorted(str((marks[p][0], marks[best[label[p]]][0])) for p in places)
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == expected


def test_simhash_hot_keys_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 8)
    rnd = random.Random(4)
    fps = {0}
    while len(fps) < 150:
        fps.add(rnd.choice(list(fps)) ^ (1 << rnd.randrange(20)) ^ (1 << rnd.randrange(20)))
    fps |= {rnd.getrandbits(63) for _ in range(100)}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(frame, 4)
    from phenoscope.llm.common import components
    got = {r.node: r.component_id for r in components(edges).collect()}
    label = closure(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    assert {f: got.get(f, f) for f in fps} == label
    assert edges.count() < 64 * 250 * 3


def row_keys(rows):
    """The operator's order of rows: id, null ids last, then the text's hash."""
    return [(i is None, i or 0, "-" if t is None else hashlib.md5(t.encode()).hexdigest()) for i, t in rows]


def lines_brute(rows, similarity=0.8):
    """``(key, place)`` of the lines to take out."""
    k = line_dedup.SHINGLE
    seen = sorted({(key, p, line.lower().strip(" \t\r\x0b\x0c")) for key, (i, t) in zip(row_keys(rows), rows)
                   for p, line in enumerate((t or "").split("\n"))})
    seen = [s for s in seen if s[2]]
    lines = sorted({s[2] for s in seen})
    sets = [{s[j:j + k] for j in range(max(1, len(s) - k + 1))} for s in lines]
    label = closure(range(len(lines)), lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]))
    of, best = dict(zip(lines, label.values())), {}
    for key, p, line in seen:
        best.setdefault(of[line], (key, p))
    return {(key, p) for key, p, line in seen if best[of[line]] != (key, p)}


def gone_of(marks):
    """``(key, place)`` of the lines that ``line_marks`` does not keep."""
    out = set()
    for r in marks.filter("not kept").collect():
        null, shown, digest = r._row.split(":")
        out.add(((null == "1", int(shown) - (1 << 63) if shown else 0, digest), r.pos))
    return out


def line_rows():
    rnd = random.Random(6)
    rows = [r for r in odd_texts() if r[0] not in (7, 8)]
    base = [text(70 + i, 22) for i in range(6)]
    for i in range(20, 45):
        picked = []
        for line in rnd.sample(base, 3):
            words = line.split()
            if rnd.random() < 0.5:
                words[rnd.randrange(22)] += "s"
            picked.append("  " + " ".join(words).upper() if rnd.random() < 0.3 else " ".join(words))
        rows.append((i, "\n".join([*picked, "", text(500 + i, 15)])))
    return rows


def test_line_dedup(spark):
    rows = line_rows()
    gone = lines_brute(rows)
    docs = documents(spark, rows)
    out = line_dedup.line_dedup(docs)
    assert out.columns == docs.columns
    keys = row_keys(rows)
    expected = [(i, t if t is None else "\n".join(s for p, s in enumerate(t.split("\n")) if (key, p) not in gone)) for key, (i, t) in zip(keys, rows)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, expected))
    digest = line_dedup.line_digest(docs).collect()
    assert sorted(str((r.doc_id, r.n_removed)) for r in digest) == sorted(
        str((i, sum(bool(s.strip()) for p, s in enumerate((t or "").split("\n")) if (key, p) in gone))) for key, (i, t) in zip(keys, rows))


def test_no_line_is_lost_where_ids_repeat_or_are_null(spark):
    rows = [(1, "A line"), (2, "A line"), (2, "B other"), (None, "A line"), (None, "B other"), (None, "C third"), (3, "A line\nD last"), (3, "A line\nD last")]
    docs = spark.createDataFrame([(i, t, [1], 2, "x") for i, t in rows], "doc_id long, text string, _gone array<int>, _row int, _gone_row string")
    out = line_dedup.line_dedup(docs).collect()
    assert sorted(str((r.doc_id, r.text, r._gone, r._row, r._gone_row)) for r in out) == sorted(
        str((i, t, [1], 2, "x")) for i, t in [(1, "A line"), (2, ""), (2, "B other"), (None, ""), (None, ""), (None, "C third"), (3, "D last"), (3, "D last")])


def alike(n, seed=21):
    """Lines that share much of a template: some pairs are near copies, most are not."""
    rnd, base = random.Random(seed), text(90, 24).split()
    out = set()
    while len(out) < n:
        words = list(base)
        for _ in range(rnd.randrange(1, 6)):
            words[rnd.randrange(24)] = rnd.choice(["xu%d", "yo%dq", "ze%d"]) % rnd.randrange(30)
        out.add(" ".join(words))
    return sorted(out)


def test_neighbours_pair_small_keys_wholly_and_name_the_members_of_large_ones():
    sizes = [1, 2, 5, 6, 40, 3]
    key = np.repeat(np.arange(len(sizes)), sizes)
    rows = np.stack([key, np.full(len(key), 50), np.arange(len(key)) + 100, np.zeros(len(key), np.int64)])
    got = line_dedup.paired(rows, [0, 5], 0.8).to_pylist()
    members = {(r["key"], r["a"]) for r in got if r["b"] is None}
    assert members == {(k, h) for k, _, h, _ in rows.T.tolist() if k in (0, 3, 4, 5)}
    pairs = {(r["a"], r["b"]) for r in got if r["b"] is not None}
    of = dict(zip(rows[2].tolist(), key.tolist()))
    for k, n in enumerate(sizes):
        own = sorted(h for h in of if of[h] == k)
        inside = {p for p in pairs if of[p[0]] == k}
        assert all(of[y] == k for _, y in inside)
        if n <= line_dedup.NEIGHBOURS + 1:
            assert inside == {(x, y) for x in own for y in own if x < y}
        else:
            assert len(inside) <= n * (line_dedup.NEIGHBOURS + 1) and {y for _, y in inside} == set(own[1:])
    assert line_dedup.paired(np.array([[7, 7], [50, 80], [1, 2], [0, 0]]), [], 0.8).num_rows == 0
    assert line_dedup.paired(np.array([[7, 7], [50, 50], [1, 2], [0, -1]]), [], 0.8).num_rows == 0


@pytest.mark.parametrize("piece", [4, 1024])
def test_members_of_large_keys_are_compared_wholly(spark, monkeypatch, piece):
    """All lines are members of all their keys and none is linked yet: no link between lines that share a key is lost."""
    monkeypatch.setattr(line_dedup, "PIECE", piece)
    lines = alike(150)
    bands = line_dedup.band_keys(line_dedup.signed_texts(lines)[1])
    assert max(np.unique(bands, return_counts=True)[1]) > 8
    frame = spark.createDataFrame(list(enumerate(lines)), "handle long, norm string")
    members = spark.createDataFrame([(int(k), i, i) for i, row in enumerate(bands.view(np.int64).tolist()) for k in row], "key long, handle long, comp long")
    linked = {(r.a, r.b) for r in line_dedup.across(members, frame, 0.8).collect()}
    shared = lambda a, b: (bands[a] == bands[b]).any() and jaccard(lines[a], lines[b]) >= 0.8
    assert all(shared(a, b) for a, b in linked)
    expected = closure(range(len(lines)), shared)
    assert closure(range(len(lines)), lambda a, b: (a, b) in linked or (b, a) in linked) == expected
    assert 1 < len(set(expected.values())) < len(lines)


def test_members_of_a_key_of_small_sets_are_compared(spark):
    texts = spark.createDataFrame([(1, "abcdefgh"), (2, "abcdefghi"), (3, "zbcdefgh")], "handle long, norm string")
    members = texts.select(F.lit(3).cast("long").alias("key"), "handle", F.col("handle").alias("comp"))
    bands = line_dedup.band_keys(line_dedup.signed_texts(["abcdefgh", "abcdefghi", "zbcdefgh"])[1])
    got = {(r.a, r.b) for r in line_dedup.across(members, texts, 0.8).collect()}
    assert got == (set() if (bands[0] == bands[1]).any() else {(1, 2)})


def test_line_dedup_where_ranges_cut_keys(spark):
    """Templates give keys of many members, which the ranges of four partitions cut."""
    rows = list(enumerate(alike(60)))
    assert gone_of(line_dedup.line_marks(documents(spark, rows))) == lines_brute(rows)


def test_neighbours_of_a_key_longer_than_what_is_held(spark, monkeypatch):
    n = line_dedup.HELD + 20_000
    keyed = spark.range(n).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("handle"), F.lit(50).alias("n"), F.lit(0).cast("long").alias("sketch"))
    got = line_dedup.neighbours(keyed, 0.8)
    assert got.filter("b is null").select("a").distinct().count() == n
    assert got.filter("b is not null").count() <= n * (line_dedup.NEIGHBOURS + 1)


def test_shingle_sets_are_those_of_the_text():
    texts = ["ab", "abcde", "abcdeabcde", "é\U0001f600日本語x", "a" * 300, "abcd", text(4, 80)]
    whole, bits = line_dedup.shingle_sets(texts)
    place = line_dedup.places(whole, bits)
    for i, t in enumerate(texts):
        k = line_dedup.SHINGLE
        assert (place == i).sum() == len({t[j:j + k] for j in range(max(1, len(t) - k + 1))})
        alone, none = line_dedup.shingle_sets([t])
        assert none == 0 and (alone >> np.uint64(bits) == whole[place == i] & np.uint64((1 << 64 - bits) - 1)).all()
        size, minima, few = line_dedup.signed_texts([t])
        every = line_dedup.signed_texts(texts)
        assert size[0] == every[0][i] and (minima[0] == every[1][i]).all() and np.array_equal(few[0], every[2][i])


def test_similar_is_exact():
    lines = alike(80, 5) + ["ab", "abc", "ab", "x" * 400]
    left, right = zip(*((a, b) for a in lines for b in lines))
    assert line_dedup.similar(list(left), list(right), 0.8).tolist() == [jaccard(a, b) >= 0.8 for a, b in zip(left, right)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], documents(spark, [(1, "a")]).schema)
    assert exact_dedup.exact_dedup(docs).collect() == []
    assert substring_dedup.substring_dedup(docs).collect() == []
    assert simhash.simhash_dedup(docs).collect() == []
    assert line_dedup.line_dedup(docs).collect() == []
    assert line_dedup.line_digest(docs).collect() == []


def test_sequence_hashes_depend_on_words_alone():
    line = b"aa b ccc aa b ccc d"
    data = np.frombuffer(line, np.uint8)
    gaps = np.flatnonzero(data == 32)
    h = substring_dedup.sequence_hashes(data, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)])), 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4


def found_pairs(spark, pairs):
    """Which of the ``pairs`` of lines the operator joins."""
    rows = [(i, a + "\n" + b) for i, (a, b) in enumerate(pairs)]
    gone = {(key[1], p) for key, p in gone_of(line_dedup.line_marks(documents(spark, rows)))}
    return [(i, 1) in gone for i in range(len(pairs))]


def letters(rnd, n):
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def test_line_dedup_of_lines_about_as_long_and_dense(spark):
    rnd, pairs = random.Random(11), []
    for _ in range(40):
        line = " ".join(letters(rnd, 6) for _ in range(30))[:rnd.randrange(115, 120)].strip()
        pairs.append((line, line + letters(rnd, 6)))
    for _ in range(40):
        line = " ".join(letters(rnd, 24) for _ in range(10))
        pairs.append((line, line[:100] + " " + line[101:]) if line[100] != " " else (line, line + "x"))
    assert sum(found_pairs(spark, pairs)) == len(pairs)


def jaccard(a, b):
    k = line_dedup.SHINGLE
    x, y = ({s[j:j + k] for j in range(max(1, len(s) - k + 1))} for s in (a, b))
    return len(x & y) / len(x | y)


def test_line_dedup_of_few_shingles_and_of_long_tokens(spark):
    rnd, short, long = random.Random(12), [], []
    for _ in range(120):
        line = letters(rnd, line_dedup.SHINGLE + 3)
        short.append((line, line + letters(rnd, 1)))
    while len(long) < 150:
        words = [letters(rnd, rnd.randrange(18, 23)) for _ in range(rnd.randrange(6, 9))]
        line = " ".join(words)
        for k in rnd.sample(range(len(words)), rnd.randrange(1, 3)):
            words[k] = letters(rnd, 1) + words[k][1:]
        if 0.8 <= jaccard(line, " ".join(words)) < 0.9:
            long.append((line, " ".join(words)))
    assert all(jaccard(a, b) >= 0.8 for a, b in short)
    found = found_pairs(spark, short + long)
    assert all(found[:120])
    assert sum(found[120:]) >= 147


def test_line_dedup_of_one_changed_letter(spark):
    rnd, pairs = random.Random(13), []
    for n in range(50, 100):
        line = " ".join(letters(rnd, 7) for _ in range(13))[:n - 1] + "z"
        at = rnd.randrange(10, n - 10)
        pairs.append((line, line[:at] + "0" + line[at + 1:]))
    assert all(found_pairs(spark, pairs))


@pytest.mark.parametrize("size", [25, 40, 100, 400])
def test_lines_at_the_threshold_meet(size):
    """Sets at a similarity of 0.8: at least 99 in 100 share a band, at most 5 in 1,000 are left out by sketches, 2 by minima."""
    rnd, trials = np.random.default_rng(size), 3_000
    common = -(-8 * size // 9)  # the smallest overlap of two sets of this size with a similarity of 0.8
    minima = np.empty((2, trials, len(line_dedup._TIMES)), np.uint32)
    for k in range(trials):
        union = rnd.integers(0, 1 << 32, 2 * size - common, dtype=np.uint32)
        for side, s in enumerate((union[:size], np.delete(union, slice(common, size)))):
            minima[side, k] = (s[:, None] * line_dedup._TIMES + line_dedup._PLUS).min(axis=0)
    x, y = minima
    assert (x == y).reshape(trials, line_dedup.BANDS, line_dedup.ROWS).all(axis=2).any(axis=1).mean() >= 0.99
    assert line_dedup.sketches_agree(line_dedup.sketches(x), line_dedup.sketches(y)).mean() >= 0.995
    assert ((x == y).sum(axis=1) >= line_dedup.AGREE * x.shape[1]).mean() >= 0.998

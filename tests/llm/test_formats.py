"""BPE, chat formatting and embeddings against the libraries and brute force."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_support import documents, odd_texts
from phenoscope.llm import bpe, chat_format, embedding_dedup

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def test_bpe_equals_the_library(spark, library):
    docs = documents(spark, odd_texts())
    got = bpe.bpe_encode_decode(docs, PATH).collect()
    assert len(got) == len(odd_texts())
    expected = []
    for i, t in odd_texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, ((i, n, bytearray(b) if isinstance(got[0].ids, bytearray) else b, d)
                                                                for i, n, b, d in expected)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x0b\x1c\x85 ᠎​　'sdtlvemr.,!<|>09"), st.characters(exclude_categories=["Cs"]))))
def test_bpe_on_any_text(t):
    vocabulary = bpe.load(open(PATH, encoding="utf-8").read())
    if not hasattr(test_bpe_on_any_text, "library"):
        test_bpe_on_any_text.library = Tokenizer.from_file(PATH)
    for line in (t, f"a {t} b", t + "<|endoftext|>" + t):
        ids = vocabulary.encode_block([line])[0]
        assert np.frombuffer(ids, "<u4").tolist() == test_bpe_on_any_text.library.encode(line, add_special_tokens=False).ids
        assert vocabulary.decode(ids) == line


def test_bpe_when_the_store_of_words_overflows(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    vocabulary = bpe.load(open(PATH, encoding="utf-8").read())
    for k in range(5):
        line = " ".join(f"word{j}x{k}" for j in range(40))
        assert np.frombuffer(vocabulary.encode_block([line])[0], "<u4").tolist() == library.encode(line).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<\\|im_stard>\nen é"))
def test_escapes_are_reversible(t):
    assert "<|" not in chat_format.escape(t) and chat_format.unescape(chat_format.escape(t)) == t
    role = chat_format.escape_role(t)
    assert "<|" not in role and "\n" not in role and chat_format.unescape_role(role) == t


CHATS = [(1, 0, "user", "Hi <|im_end|> é"), (1, 1, "assistant", "<\\|x|> ok"), (1, 2, "assistant", None), (1, 3, None, "t"),
         (2, 0, "assistant", "<"), (2, 1, "assistant", "\\|im_start|>"), (2, 1, "assistant", "\\|im_start|>"),
         (3, None, "a\nb", ""), (3, 5, "assistant", "z" * 30_000), (None, 0, "system", "s"), (-1, 0, "user", "<|endoftext|>")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*c, 1, "x") for c in CHATS], "conv_id long, turn int, role string, text string, position int, ids string")
    formatted = chat_format.format_chats(turns, PATH)
    got = {r.conv_id: r for r in chat_format.read_back(formatted, PATH).collect()}
    assert set(got) == {c[0] for c in CHATS}
    for conv, r in got.items():
        rows = sorted((c for c in CHATS if c[0] == conv), key=lambda c: (c[1] is None, c[1] or 0, c[2] or "", c[3] or ""))
        whole = "".join(f"{c[2] or ''}\n{c[3] or ''}\n" for c in rows)
        learned = "".join(c[3] or "" for c in rows if c[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(rows), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        text = "".join(f"<|im_start|>{chat_format.escape_role(c[2] or '')}\n{chat_format.escape(c[3] or '')}<|im_end|>\n" for c in rows)
        assert r.formatted_chars == len(text)
    for conv in (1, 2, 3):  # places follow from sums of lengths, and the mask stays inside its turn
        places = sorted((r.position, r.first_token, len(r.ids), r.loss_from, r.loss_to) for r in formatted.collect() if r.conv_id == conv)
        assert [p[1] for p in places] == [sum(q[2] for q in places[:k]) for k in range(len(places))]
        assert all(first < low <= high < first + n for _, first, n, low, high in places)


def test_chat_of_no_rows(spark):
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat_format.read_back(chat_format.format_chats(turns, PATH), PATH).collect() == []


def vectors():
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(260):
        v = rnd.normal(size=12)
        rows.append((i, v.tolist()))
        if i % 5 == 0:
            for k in range(rnd.integers(1, 5)):
                rows.append((1000 + 10 * i + k, (v * (k + 1) + rnd.normal(size=12) * 0.12).tolist()))
    dense = rnd.normal(size=12)
    rows += [(10_000 + i, (dense + rnd.normal(size=12) * 0.05).tolist()) for i in range(150)]
    rows += [(20_000, None), (20_001, []), (20_002, [0.0] * 12), (20_003, [1.0, None] * 6), (20_004, [float("nan")] + [1.0] * 11),
             (20_005, [float("inf")] + [1.0] * 11), (20_006, [1e300] * 12), (20_007, [1e-300] * 12), (20_008, [1.0] * 12),
             (20_008, [1.0] * 12), (20_009, [1.0] * 7), (20_010, [2.0] * 7), (None, rows[0][1])]
    return rows


@pytest.mark.parametrize("pivots,shard_rows,cosine", [(256, 4096, 0.95), (8, 64, 0.95), (16, 40, 0.5)])
def test_embedding_dedup(spark, pivots, shard_rows, cosine):
    rows = vectors()
    frame = spark.createDataFrame([(*r, 1, "n") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = embedding_dedup.embedding_dedup(frame, cosine, pivots, shard_rows).collect()
    def unit(v):
        if not v or None in v or not np.isfinite(v).all() or not np.abs(v).max():
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    near = lambda a, b: (a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
                         and units[a] @ units[b] >= cosine)
    links = {p: [q for q in range(len(rows)) if near(p, q)] for p in range(len(rows))}
    label = _components(links)
    expected = []
    for p, (i, _) in enumerate(rows):
        ids = [rows[q][0] for q in range(len(rows)) if label[q] == label[p] and rows[q][0] is not None]
        least = min(ids) if ids else None
        expected.append((i, len(links[p]), least, i == least))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def _components(links):
    label = {p: p for p in links}
    for p in links:
        stack = [p] if label[p] == p else []
        while stack:
            q = stack.pop()
            for r in links[q]:
                if label[r] > p and r != p:
                    label[r] = p
                    stack.append(r)
    return label


def test_embedding_of_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.embedding_dedup(frame).collect() == []


def test_shard_links_prune_and_lose_nothing():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(60, 6))
    x = np.concatenate([c + rnd.normal(size=(20, 6)) * 0.03 for c in centres])
    x /= np.linalg.norm(x, axis=1)[:, None]
    import pandas as pd
    shard = embedding_dedup.shard_levels(pd.DataFrame({"node": [f"{i:05d}" for i in range(len(x))], "dim": 6, "unit": [v.tobytes() for v in x]}))
    tree = [shard[f"c{k}"].to_numpy() for k in range(3)]
    i, j = embedding_dedup.shard_links(x, x, tree, tree, 0.99)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(x @ x.T >= 0.99))))


def test_shard_traversal_prunes_inside_nested_cells():
    import pandas as pd
    for seed in range(4):
        rng = np.random.default_rng(seed)
        x = rng.normal(size=(40, 32))[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * rng.uniform(0.02, 0.6, (4000, 1))
        x /= np.linalg.norm(x, axis=1)[:, None]
        shard = embedding_dedup.shard_levels(pd.DataFrame(
            {"node": [f"{i:05d}" for i in range(len(x))], "dim": 32, "unit": [v.tobytes() for v in x]}))
        tree = [shard[f"c{k}"].to_numpy() for k in range(len(embedding_dedup.RADII))]
        i, j = embedding_dedup.shard_links(x, x, tree, tree, 0.95)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(x @ x.T >= 0.95))))
        for above, cell in zip(tree, tree[1:]):
            assert (above[cell] == above).all() and (cell[cell] == cell).all()


def test_null_conversation_is_not_the_text_null(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    turns = spark.createDataFrame([(None, 0, "user", "a"), ("null", 0, "user", "b"), ("", 0, "user", "c")], "conv_id string, turn int, role string, text string")
    rows = chat_format.read_back(chat_format.format_chats(turns, path), path).collect()
    assert sorted((str(r.conv_id), r.n_turns) for r in rows) == [("", 1), ("None", 1), ("null", 1)]

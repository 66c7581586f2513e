"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "ser", "van", "dol", "pem") for b in ("ri", "ta", "no", "gel", "bu", "", "shi")]


def text(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    """``rows`` of (doc_id, text) with further columns whose names clash with those the operators use inside."""
    full = [(i, t, "en", s if (s := ["a", "b", None, "ü", "c"][k % 5]) else None, None if t is None else len(t), k, "x", 1.5)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "_id int, line string, score double")


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Null, empty, blank, very long and repeated texts, repeated and null ids."""
    long = text(1, 60_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, text(2, 120)), (6, text(2, 120)), (6, text(2, 120)),
            (7, long), (8, long + " end"), (9, "x" * 50_000), (None, text(2, 120)), (None, None),
            (10, "Ünï \x85   \U0001f600 <|endoftext|>"), (11, text(2, 120).replace(" ", "  \n")), (12, "<|im_end|>")]


def closure(ids, linked) -> dict:
    """The smallest id reachable from each over ``linked(a, b)``."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and linked(a, b):
                    label[a] = label[b]
                    changed = True
    return label

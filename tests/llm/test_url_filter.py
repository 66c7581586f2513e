"""URL filter: rules by hand, features by hand, held-out accuracy of the trees."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phenoscope.llm import url_filter as U
from phenoscope.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://a.com", "HTTP://A.Com/", "https://www.Example.COM/en/x?y=1#z", "http://example.com/en/1",
        "http://sub.example.com/en", "http://sub.example.com/en/", "x://x.www.example.com/en/a://b.net/es/", "http://notexample.com/en/",
        "http://a.net/es/1", "http://a.net/fr", "http://net/fr/1", "http://a.net.org/fr/", "ftp://a.org?x=/en/", "http://a.com#/en/",
        "http://a.com:80/en/", "http://ÀÉ.com/ÉN/", "http://.com/", "http://a.com./", "://com/", "http://" + "a." * 3000 + "net/es/" + "x" * 9000,
        "http://a.b\n.com/p\nq"]


def judged_by_hand(url, rules):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end].translate(lower), rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(r), r, v) for v, r in rules
            for h, p in [r.split("/", 1)] if ("." + host).endswith("." + h) and path.startswith("/" + p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def pages(spark, urls):
    return spark.createDataFrame([(i if i % 7 else None, u, "<html>", "x", 1, 0.5) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string, host string, fold int, score double")


def test_rules_like_by_hand(spark):
    rows = U.with_rules(pages(spark, URLS).select("url"), URL_RULES).collect()
    assert {(r.url, r.host, r.path, r.rule, r.judged) for r in rows} == {(u, *judged_by_hand(u, URL_RULES)) for u in URLS}
    rules = [*URL_RULES, ("allow", "net/fr/"), ("block", "a.net/e"), ("allow", "b.c.d.e/")]  # of equal rules block counts
    rows = U.with_rules(pages(spark, URLS).select("url"), rules).collect()
    by_url = {r.url: r for r in rows}
    assert by_url["http://net/fr/1"].judged == "block" and by_url["http://a.net/es/1"].rule == "net/es/"


def test_every_row_is_judged(spark):
    out = U.url_filter(pages(spark, URLS * 3), URL_RULES)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    rows = out.collect()
    assert len(rows) == 3 * len(URLS) and {r.verdict for r in rows} <= {"allow", "block"}
    assert Counter((r.host, r.path, r.rule) for r in rows) == Counter(judged_by_hand(u, URL_RULES)[:3] for u in URLS * 3)
    assert all((r.score is None) == (r.rule is not None) for r in rows)
    again = U.url_filter(pages(spark, URLS * 3).repartition(5), URL_RULES).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_no_rows_no_rules_and_one_class(spark):
    assert U.url_filter(pages(spark, URLS).filter(F.lit(False)), URL_RULES).collect() == []
    assert {(r.verdict, r.score) for r in U.url_filter(pages(spark, URLS)).collect()} == {("allow", 0.0)}
    rows = U.url_filter(pages(spark, ["http://a.com/", "http://b.org/"]), [("block", "com/")]).collect()
    assert {(r.rule, r.verdict, r.score) for r in rows} == {("com/", "block", None), (None, "block", 1.0)}


def test_features_by_hand(spark):
    urls = ["http://a-b.example.org/en/12.html?p=1&q=2#t", "", "aaaa", "https://x.y/ab//c"]
    rows = U.with_features(U.with_rules(spark.createDataFrame([(u,) for u in urls], "url string"), ())).collect()
    for r in rows:
        n = len(r.url)
        bits = -sum(c / n * math.log2(c / n) for c in Counter(r.url).values())
        assert r.length == n and r.entropy == pytest.approx(bits, abs=1e-9) and r.digits == pytest.approx(sum(c.isdigit() for c in r.url) / max(1, n))
    first = {r.url: r for r in rows}[urls[0]]
    assert (first.suffix, first.domain, first.segment, first.extension) == ("org", "example.org", "en", "html")
    assert (first.labels, first.depth, first.parameters, first.fragment, first.marks) == (3, 2, 2, 1, pytest.approx(1 / len(urls[0])))


def test_own_fold_is_left_out(spark):
    known = spark.createDataFrame([("u", f, b) for f, b in ((0, 1), (0, 1), (1, 0))], "suffix string, fold int, block int")
    known = known.withColumns({k: F.lit("t") for k in U.KINDS if k != "suffix"})
    rows = U.with_statistics(known.select("*").union(known.limit(1).withColumn("fold", F.lit(-1))), U.token_counts(known), 0.5).collect()
    share = {r.fold: (r.suffix_share, r.suffix_seen) for r in rows}
    prior = U.PRIOR
    assert share[0] == pytest.approx(((0 + prior / 2) / (1 + prior), math.log(2)))
    assert share[1] == pytest.approx(((2 + prior / 2) / (2 + prior), math.log(3)))
    assert share[-1] == pytest.approx(((2 + prior / 2) / (3 + prior), math.log(4)))


def test_held_out_accuracy(spark):
    """Spam URLs are long, full of digits and parameters; some suffixes are mostly spam."""
    rnd = random.Random(7)

    def url(block):
        host = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(4, 9)))
        suffix = rnd.choice(["biz", "biz", "org"] if block else ["org", "org", "edu", "biz"])
        digits = "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(5, 15) if block else rnd.randrange(0, 5)))
        query = "&".join(f"p{i}={rnd.randrange(99)}" for i in range(rnd.randrange(0, 5 if block else 2)))
        return f"http://{host}.{suffix}/x/{digits}" + (f"?{query}" if query else "")

    rows = [(u, b) for i in range(900) for b in [i % 2] for u in [url(b)]]
    train, test = rows[:600], rows[600:]
    labelled = spark.createDataFrame(train + [(None, 1), ("http://q.org/", None), ("http://q.org/", 7)], "url string, block int")
    found = U.url_filter(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(test)], "page_id long, url string"), labelled=labelled)
    right = sum((r.verdict == "block") == (test[r.page_id][1] == 1) for r in found.collect())
    assert right / len(test) > 0.9

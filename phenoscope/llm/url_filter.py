"""URL filter: rules by host and path, and gradient-boosted trees for URLs without a rule.

Everything is read off the URL: lengths, depth, digit ratio, entropy, parameters, and
statistics of suffixes and segments (how often the labelled URLs with one are blocked).
DataFrame functions and MLlib's trees only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.llm.common import unit_interval, written

#: Folds of the labelled URLs; a URL's own fold is left out of its statistics while trees are grown.
FOLDS = 5
#: Labelled URLs that the overall share counts for in a suffix's share.
PRIOR = 4.0
#: What statistics are kept of: the host's last label and last two, the path's first segment and its extension.
KINDS = ("suffix", "domain", "segment", "extension")
_LEXICAL = ("length", "host_length", "path_length", "labels", "depth", "digits", "marks", "entropy", "parameters", "fragment")
FEATURES = (*_LEXICAL, *(f"{k}_{x}" for k in KINDS for x in ("share", "seen")))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def last_labels(host: Column, count: int) -> Column:
    """The host's last ``count`` labels; null if it has fewer."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) >= count, F.array_join(F.slice(labels, -count, count), "."))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> dict[int, DataFrame]:
    """By number of labels in a rule's host: ``(host, [(path, rule, verdict)])``, a row a host.

    A rule is (verdict, host with path); of equal rules ``block`` counts.
    """
    by_host: dict[str, dict[str, str]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        paths = by_host.setdefault(host, {})
        paths[slash + path] = "block" if "block" in (verdict, paths.get(slash + path)) else verdict
    out = {}
    for count in sorted({h.count(".") + 1 for h in by_host}):
        rows = [(h, [(p, h + p, v) for p, v in sorted(paths.items())]) for h, paths in sorted(by_host.items()) if h.count(".") + 1 == count]
        out[count] = spark.createDataFrame(rows, "host string, rules array<struct<path: string, rule: string, verdict: string>>")
    return out


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``urls`` with ``host``, ``path`` and the longest fitting ``rule`` with its ``judged`` verdict, both null if none fits.

    One join for each number of labels that hosts of rules have; no row is multiplied.
    """
    out = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = []
    for count, table in rule_table(urls.sparkSession, rules).items():
        name = f"rules{count}"
        out = out.withColumn("tail", last_labels(F.col("host"), count)).join(
            table.select(F.col("host").alias("tail"), F.col("rules").alias(name)), "tail", "left").drop("tail")
        found.append(F.coalesce(F.col(name), F.array().cast(table.schema["rules"].dataType)))
    if not found:
        return out.withColumns({"rule": F.lit(None).cast("string"), "judged": F.lit(None).cast("string")})
    fits = F.filter(F.concat(*found), lambda r: F.col("path").startswith(r["path"]))
    longest = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return out.withColumn("best", longest).select(*urls.columns, "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("judged"))


def entropy(text: Column) -> Column:
    """Bits of entropy of the characters: lengths of the runs of equal ones in the sorted characters."""
    def of(chars: Column) -> Column:
        n = F.size(chars)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(chars, i) != F.get(chars, i - 1)))
        ends = F.concat(F.slice(starts, 2, n), F.array(n))
        shares = F.zip_with(starts, ends, lambda s, e: (e - s) / n)
        return F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))

    chars = F.array_sort(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    return F.when(F.length(text) > 0, F.transform(F.array(chars), of)[0]).otherwise(F.lit(0.0))


def with_features(urls: DataFrame) -> DataFrame:
    """``(url, host, path, ...)`` with the lexical features, and the tokens that have statistics, one column a kind."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    size = F.greatest(F.length(url), F.lit(1))
    share = lambda kept: F.length(F.regexp_replace(url, kept, "")) / size
    lexical = dict(zip(_LEXICAL, (
        F.length(url), F.length(host), F.length(path), F.size(F.split(host, r"\.")), F.size(segments), share("[^0-9]"),
        share("[A-Za-z0-9/:.?#&=]"), entropy(url), F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), url.contains("#").cast("int"))))
    tokens = dict(zip(KINDS, (last_labels(host, 1), last_labels(host, 2), F.get(segments, F.lit(0)),
                              F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))))
    return urls.withColumns({**{k: c.cast("double") for k, c in lexical.items()}, **{k: F.coalesce(c, F.lit("")) for k, c in tokens.items()}})


def token_counts(known: DataFrame) -> DataFrame:
    """``(kind, token, seen, blocked)``: arrays of counts of labelled URLs by fold, over all of ``known``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("token")) for k in KINDS])).alias("t")
    rows = known.select(pairs, "fold", "block").select("t.*", "fold", "block")
    in_fold = lambda f: F.col("fold") == f
    return rows.groupBy("kind", "token").agg(
        F.array(*[F.count_if(in_fold(f)) for f in range(FOLDS)]).alias("seen"),
        F.array(*[F.count_if(in_fold(f) & (F.col("block") == 1)) for f in range(FOLDS)]).alias("blocked"))


def with_statistics(urls: DataFrame, counts: DataFrame, base: float) -> DataFrame:
    """``urls`` with the share blocked and the number seen of every kind of token, without those of the row's own ``fold`` (-1: none)."""
    out = urls
    zero = F.array_repeat(F.lit(0).cast("long"), FOLDS)
    for kind in KINDS:
        out = out.join(counts.filter(F.col("kind") == kind).select(F.col("token").alias(kind), "seen", "blocked"), kind, "left")
        others = lambda c: F.aggregate(F.transform(F.coalesce(c, zero), lambda v, f: F.when(f != F.col("fold"), v).otherwise(0)),
                                       F.lit(0).cast("long"), lambda a, v: a + v)
        seen, blocked = others(F.col("seen")), others(F.col("blocked"))
        out = out.withColumns({f"{kind}_share": (blocked + PRIOR * base) / (seen + PRIOR), f"{kind}_seen": F.log1p(seen.cast("double"))}).drop("seen", "blocked")
    return out


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = (), labelled: DataFrame | None = None, max_train: int = 16_000,
               seed: int = 13, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``(id, host, path, rule, verdict, score)``.

    ``rules`` are (``allow`` or ``block``, host with path); a rule fits its host and all
    subdomains where the URL's path starts with the rule's, and the longest that fits gives
    the verdict. Other URLs are judged by trees: ``block`` from a ``score`` (chance of being blocked)
    of 0.5 on; ``score`` is null where a rule judged. Trees learn from ``labelled``
    ``(url, block 0/1)``, by default the URLs that rules judge: statistics of suffixes and
    segments from all of them, trees from at most about ``max_train`` distinct ones, drawn by a hash.

    Null URLs and those without ``://`` have empty host and path, fit no rule and are judged
    by features of what there is. URLs of any length are read whole. Repeated rows and ids are judged alike and returned each; null
    ids stay. A labelled URL that repeats counts once, as blocked if any row says so; null labels are not learned
    from. Without URLs of both classes the score is the share blocked (0.0 without labelled URLs). An
    empty table gives no row. Other columns are not read.
    """
    spark = pages.sparkSession
    judged = written(with_rules(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url")), rules), "judged")
    if labelled is None:
        told = judged.filter("judged is not null and url is not null").select("url", (F.col("judged") == "block").cast("int").alias("block"))
    else:
        told = labelled.select("url", F.col("block").cast("int").alias("block")).filter("url is not null and block in (0, 1)")
    known = told.groupBy("url").agg(F.max("block").alias("block"))
    known = known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")),
                               "fold": F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")})
    known = written(with_features(known), "known")
    total, base = known.agg(F.count(F.lit(1)), F.coalesce(F.avg("block"), F.lit(0.0))).first()
    open_ = judged.filter("judged is null")
    if 0 < base < 1:
        counts = written(token_counts(known), "counts")
        sample = written(known.filter(unit_interval(F.col("url"), seed) < max_train / total), "sample")
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        train = written(with_statistics(sample, counts, base).select(*FEATURES, F.col("block").cast("double").alias("label")), "train")
        if train.select("label").distinct().count() == 2:
            # few rows, sorted, so that trees do not depend on the order in which tasks end
            trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=seed).fit(
                vectors.transform(train.coalesce(1).sortWithinPartitions("label", *FEATURES)))
            featured = with_statistics(with_features(open_).withColumn("fold", F.lit(-1)), counts, base)
            scored = trees.transform(vectors.transform(featured)).withColumn("score", vector_to_array("probability")[1])
        else:
            scored = open_.withColumn("score", F.lit(float(base)))
    else:
        scored = open_.withColumn("score", F.lit(float(base)))
    columns = ["_id", "host", "path", "rule", "verdict", "score"]
    by_trees = scored.withColumn("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).select(*columns)
    by_rule = judged.filter("judged is not null").withColumns({"verdict": F.col("judged"), "score": F.lit(None).cast("double")}).select(*columns)
    return by_rule.unionByName(by_trees).withColumnRenamed("_id", id_col)

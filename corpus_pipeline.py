"""A corpus pipeline over ``documents``: five stages, each calling one operator.

Toxic documents go, near-equal lines go, one document of each near-copy group
stays, sources are mixed to their target weights, and what is left is encoded.
``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and all but the last return the columns of ``docs``. ``run`` writes every stage's
result to the shared folder and reads it again as the next one's input; then the
input and all else that the stage wrote are deleted.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.llm.bpe import bpe_encode_decode
from phenoscope.llm.common import discard, flagged, read_table, row_key, settled, unused, written
from phenoscope.llm.line_dedup import line_dedup
from phenoscope.llm.mixing import mix_sources
from phenoscope.llm.simhash import simhash_dedup
from phenoscope.llm.toxicity import score_toxicity


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, its id and text together, and the key's name, which no other column has.

    Stages act on keys, so of several texts under one id, or without one, each is judged by itself.
    """
    (key,) = unused(docs.columns, "row_key")
    return docs.withColumn(key, row_key(docs)), key


def without(docs: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``dropped``.

    Only rows that a bitmap of the dropped keys lets by meet these in a join; the others are not shuffled.
    """
    gone = written(dropped.select(key).distinct(), "dropped")
    near, found = unused(docs.columns, "near", "found")
    rows = flagged(docs, gone, F.xxhash64(key), near)
    # an outer join, since an anti-join would be moved below the filter
    met = rows.filter(near).join(gone.withColumn(found, F.lit(True)), key, "left").filter(F.col(found).isNull())
    return rows.filter(~F.col(near)).select(*docs.columns).unionByName(met.select(*docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity operator does not reject (score under 0.5).

    The model learns from table ``labels`` outside the held-out fold, as in the
    operator's query. Null and empty texts are scored like any other; rows that repeat
    an id, and rows without one, are judged by their own text.
    """
    rows, key = keyed(docs)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    scored = score_toxicity(rows, read_table(spark, sf_dir, "labels"), fold != 0, row_col=key)
    return without(rows, scored.filter("predicted = 1"), key).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with near-equal lines taken out but one; ``n_chars`` follows the text.

    Documents stay even if no line is left; null texts stay null.
    """
    kept = line_dedup(docs)
    if "n_chars" not in docs.columns:
        return kept
    size = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest id; rows without an id come last.

    Of several texts under one id that are no near copies each stays. Of rows equal in id
    and text one stays, the smallest by the other columns.
    """
    rows, key = keyed(docs)
    found = simhash_dedup(rows, shingle=4, max_bits=4, id_col=key)
    kept = written(without(rows, found.filter(F.col(key) != F.col("component_id")), key), "kept")
    repeated = kept.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    first = kept.join(repeated.select(key), key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("first")).select("first.*")
    return kept.join(repeated.select(key), key, "left_anti").select(*docs.columns).unionByName(first)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: 0, 1 or 2 rows. Rows equal in id and text are taken equally often."""
    rows, key = keyed(docs)
    repeats, epoch = unused(rows.columns, "repeats", "epoch")
    taken = mix_sources(rows, id_col=key).filter("repeats > 0").groupBy(key).agg(F.max("repeats").cast("int").alias(repeats))
    return rows.join(written(taken, "taken"), key).withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(repeats)))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)`` for every row of the mix.

    ``ids`` are little-endian unsigned 32-bit integers of the byte-level vocabulary;
    the last digest is that of the text decoded from them. Null and empty texts have no ids; repeated rows and
    null ids are returned each.
    """
    coded = bpe_encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash_dedup", drop_near_copies),
          ("mix_sources", mix), ("bpe", encode)]

#: Trained scores, hashing by XXH64 and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over table ``documents``."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = settled(functools.partial(stage, spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

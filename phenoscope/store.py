"""Tables that later plans read more than once, in the folder that the driver and all executors share.

Writing cuts the lineage: a lost executor costs no recomputation from the start, the
planner knows the true sizes, and values that depend on a sample or on partition numbers
stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoscope.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir`` (below the context's folder where that is unset)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/phenoscope-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written and read again; ``partition_by`` columns become folders, so a filter on them prunes files."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written, and its number of rows (from the files' footers; ``df`` itself is computed once)."""
    table = written(df)
    return table, table.count()


#: Bits of one bitmap of ``among``, bitmaps at most (32 MB together), and bits for each wanted key.
BITMAP_BITS, MAX_BITMAPS, BITS_A_KEY = 32768, 1 << 13, 16


def among(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose ``keys`` are in ``wanted`` (a table of ``written``), and a few others, without a shuffle.

    A bitmap with two bits of each wanted key's hash is broadcast and drops nearly all other rows (98.5 %)
    where they are read; past 16 million keys it grows no further and drops fewer.
    The caller's join drops the rest.
    """
    bitmaps = min(MAX_BITMAPS, max(1, -(-wanted.count() * BITS_A_KEY // BITMAP_BITS)))
    place = F.pmod("_hash", F.lit(bitmaps * BITMAP_BITS))
    # both bits lie in one bitmap, the second by other bits of the hash
    at = {"_bitmap_no": F.floor(place / BITMAP_BITS), "_bit": F.pmod(place, F.lit(BITMAP_BITS)).cast("int"),
          "_bit2": F.pmod(F.shiftrightunsigned("_hash", 40), F.lit(BITMAP_BITS)).cast("int")}
    placed = lambda rows: rows.withColumn("_hash", F.xxhash64(*keys)).withColumns(at)
    bits = placed(wanted.select(*keys)).select("_bitmap_no", F.explode(F.array("_bit", "_bit2")).alias("_bit")).groupBy(
        "_bitmap_no").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    word = lambda i: F.conv(F.hex(F.substring("_bitmap", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    words = bits.select("_bitmap_no", F.transform(F.sequence(F.lit(0), F.lit(BITMAP_BITS // 64 - 1)), word).alias("_words"))

    def is_set(bit: str) -> Column:  # a word's first byte is its highest one
        b = F.col(bit)
        place_in_word = F.lit(56) - F.shiftright(b.bitwiseAND(F.lit(63)), 3) * 8 + b.bitwiseAND(F.lit(7))
        return F.getbit(F.get("_words", F.shiftright(b, 6)), place_in_word) == 1

    return placed(df).join(F.broadcast(words), "_bitmap_no").filter(is_set("_bit") & is_set("_bit2")).select(*df.columns)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``, as many as a shuffle has partitions.

    Scans keep the buckets as partitioning, so aggregates by ``key`` and joins of
    such tables on it need no exchange.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"phenoscope_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)

"""Readers for the input tables (O-01 parquet, O-02 CSV).

Paths are parameters; a release version is just part of the path the caller
builds. Parquet readers declare their schema, so Catalyst can prune columns and
push filters into the scan; CSV columns are found by their header.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.functions.constants import CURATED_PHENOTYPE_WEIGHTS
from phenoscope.sources import schemas


def release_path(root: str, release: str, dataset: str) -> str:
    """``<root>/<release>/output/etl/parquet/<dataset>`` layout of a data release."""
    return f"{root.rstrip('/')}/{release}/output/etl/parquet/{dataset}"


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.EVIDENCE)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.TARGETS)


def read_mechanism_of_action(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.MECHANISM_OF_ACTION)


def read_mouse_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.MOUSE_PHENOTYPES)


def read_drug_warnings(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.DRUG_WARNINGS)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], malformed: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """The named columns of a CSV file with a header, all as text.

    Columns are found by their header, so their order and number in the file do
    not matter (a declared schema would bind by position). A missing one raises.
    Quoted fields may hold separators and doubled quotes, with ``multi_line`` also line ends
    (a file is then read by one task, so it should be one of many). With ``malformed`` there is a column of
    that name with the text of records whose number of fields is not the header's;
    it is null for all others. Without it fields that lack are null and those beyond are dropped.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    raw = reader.csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    if malformed is None:
        return raw.select(*[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in raw.columns), T.StructField(malformed, T.StringType())])
    told = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed).csv(path)
    return told.select(*[F.col(f"`{c}`") for c in [*columns, malformed]])


def write_csv(df: DataFrame, path: str) -> None:
    """``df`` as CSV files with a header, in the form that ``read_csv`` reads; nulls and empty texts both come back as null."""
    df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_approvals_csv(spark: SparkSession, path: str) -> DataFrame:
    """Approved-drug table: ``targetIds`` holds ``;``-separated target ids."""
    return read_csv(spark, path, ["targetIds"])


def read_phenotype_weights_csv(spark: SparkSession, path: str) -> DataFrame:
    """Curated phenotype-class weights (D-14) from a CSV file.

    The file ends every line with a comma, so a fourth, unnamed column holds
    an optional mark. The score is read as a double; zero stays 0.0, an empty
    score is null, and text that is no number fails the query that reads it.
    """
    raw = read_csv(spark, path, ["id", "label", "score"])
    number = F.col("score").try_cast("double")
    bad = F.col("score").isNotNull() & (F.trim("score") != "") & number.isNull()
    return raw.select(
        F.col("id").alias("idLabel"),
        F.col("label").alias("phenoLabel"),
        F.when(bad, F.raise_error(F.concat(F.lit("not a score: "), F.col("score"))).cast("double"))
        .otherwise(number).alias("curatedScore"),
    )


def curated_phenotype_weights(spark: SparkSession) -> DataFrame:
    """The shipped 28-row weight table as a local relation (broadcast-sized)."""
    return spark.createDataFrame(list(CURATED_PHENOTYPE_WEIGHTS), schemas.PHENOTYPE_WEIGHTS)

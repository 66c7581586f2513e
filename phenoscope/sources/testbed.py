"""Input roles built from the driver's test tables.

The test tables hold no biomedical data, so each input of the analysis is
derived row by row from a driver table (no aggregation, so every role grows
linearly with the scale factor):

==================  =====================================================
role                built from
==================  =====================================================
evidence            lineitem JOIN orders (target=part, disease=customer)
targets             part (nested hallmarks, liabilities, constraints)
mechanismOfAction   lineitem JOIN supplier
mousePhenotypes     events (target=user, label=event type and class)
drugWarnings        supplier, one row per warning type (null: no warning)
approvals           part (a ``;``-separated id list per row, null: none)
labelled scores     documents JOIN labels
==================  =====================================================

Nested values are picked from small option lists by a key modulo their
length. The option lists are plain data; ``phenoscope.plans.oracle_sql`` renders
the same lists as DuckDB literals for the oracle queries.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.functions.constants import (
    ACTIVATOR_ACTIONS, EVIDENCE_SOURCES, INHIBITOR_ACTIONS, LOF_CONSEQUENCES,
)
from phenoscope.sources import schemas
from phenoscope.store import written


@dataclass(frozen=True)
class RowValue:
    """A value computed from the source row: Spark column factory + DuckDB SQL text."""
    spark: Callable[[], Column]
    sql: str


# ---------------------------------------------------------------------------
# option lists (test data design, not analysis constants)
# ---------------------------------------------------------------------------
TESTBED_SOURCES = EVIDENCE_SOURCES + ("genomics_england", "europepmc")

SIGNIFICANCE_OPTIONS = (
    None,
    ["pathogenic"],
    ["pathogenic", "benign"],
    ["likely pathogenic"],
    ["protective"],
    ["Pathogenic"],
    ["benign", "pathogenic"],
)

CONSEQUENCE_OPTIONS = (None,) + LOF_CONSEQUENCES + (
    "SO_0002053", "SO_0002054", "SO_0002317", "SO_0002315", "SO_0001583")

QTL_OPTIONS = (None, None, "SO_0002316", "SO_0002315", "SO_0001583")


def _samples(*codes):
    return [{"functionalConsequenceId": c} for c in codes]


SAMPLE_OPTIONS = (
    None,
    [],
    _samples("SO_0002053"),
    _samples("SO_0002054"),
    _samples("SO_0002053", "SO_0002054"),
    _samples("SO_0001583"),
)


def _phen(*pairs):
    return [{"id": i, "label": lab} for i, lab in pairs]


# a phenotype label is an event type and one of so many classes: of targets in the
# phenotypes (three to a target), of diseases in the evidence, so that labels differ
# in the diseases behind them
LABEL_CLASSES = 211


def _label(kind: str) -> RowValue:
    return RowValue(lambda: F.concat(F.lit(f"{kind} "), F.pmod("o_custkey", F.lit(LABEL_CLASSES)).cast("string")),
                    f"('{kind} ' || (o_custkey % {LABEL_CLASSES}))")


PHENOTYPE_OPTIONS = (
    None,
    [],
    _phen(("MP:0000001", _label("view"))),
    _phen(("MP:0000002", _label("click")), ("MP:0000003", _label("error"))),
    _phen(("MP:0000004", _label("purchase")), ("MP:0000001", _label("view"))),
    _phen(("MP:0000005", _label("signup"))),
)


def _hall(*descriptions):
    return {"attributes": [{"description": d} for d in descriptions]}


HALLMARK_OPTIONS = (
    None,
    {"attributes": []},
    _hall("TSG"),
    _hall("oncogene"),
    _hall("Oncogene"),
    _hall("oncogene,TSG"),
    _hall("oncogene,fusion"),
    _hall("TSG", "oncogene"),
    _hall("fusion,oncogene", "oncogene,fusion"),
    _hall("cancer hallmark", None),
)


def _liab(*pairs):
    return [{"datasource": d, "event": e} for d, e in pairs]


_P_TYPE_EVENT = RowValue(lambda: F.concat(F.col("p_type"), F.lit(" assay")), "(p_type || ' assay')")

LIABILITY_OPTIONS = (
    None,
    [],
    _liab(("ToxCast", _P_TYPE_EVENT)),
    _liab(("Brennan et al. (2024)", "cardiac"), ("PharmGKB", "hepatic")),
    _liab(("Lynch et al. (2017)", "cardiac"), ("ToxCast", "hepatic"), ("AOP-Wiki", None)),
    _liab((None, "renal")),
    _liab(("Force et al. (2007)", RowValue(lambda: F.col("p_brand"), "p_brand")),
          ("Lynch et al. (2017)", _P_TYPE_EVENT)),
)

ACTION_OPTIONS = INHIBITOR_ACTIONS + ACTIVATOR_ACTIONS + ("OPENER", None)

_MP = "MP:"
CLASS_OPTIONS = (
    [],
    [{"id": _MP + "0005370"}],
    [{"id": _MP + "0003631"}, {"id": _MP + "0005381"}],
    [{"id": _MP + "0005369"}],
    [{"id": _MP + "0002873"}],
    [{"id": _MP + "9999999"}],
    [{"id": _MP + "0005385"}, {"id": _MP + "0005387"}, {"id": _MP + "0005390"}],
    None,
)

TOXICITY_OPTIONS = (
    None,
    "hepatotoxicity",
    "cardiotoxicity",
    "gastrointestinal toxicity",
    "dermatological.toxicity",
    "neurotoxicity",
)
# the classes with a flag column of their own (null becomes "unknown"); the last option is left to "other"
TOXICITY_CLASSES = ("unknown",) + TOXICITY_OPTIONS[1:-1]


# ---------------------------------------------------------------------------
# literal rendering for Spark
# ---------------------------------------------------------------------------
def spark_literal(value, dtype: T.DataType) -> Column:
    """A typed Spark literal for nested Python data (None, str, float, list, dict)."""
    if isinstance(value, RowValue):
        return value.spark().cast(dtype)
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        if not value:
            return F.array().cast(dtype)
        return F.array(*[spark_literal(v, dtype.elementType) for v in value])
    if isinstance(dtype, T.StructType):
        return F.struct(*[spark_literal(value.get(f.name), f.dataType).alias(f.name)
                          for f in dtype.fields])
    return F.lit(value).cast(dtype)


def _computed(value) -> bool:
    """Whether an option holds a value of the row."""
    if isinstance(value, (list, dict)):
        return any(map(_computed, value.values() if isinstance(value, dict) else value))
    return isinstance(value, RowValue)


def pick(key: Column, options, dtype: T.DataType) -> Column:
    """``options[key % len(options)]``: an array constant, or one CASE expression where an option needs the row.

    A CASE for every list would make the evidence's generated method too long (over 8,000 bytes) for the JVM to compile.
    """
    k = F.pmod(key, F.lit(len(options)))
    if not any(map(_computed, options)):
        values = F.array(*[spark_literal(option, dtype) for option in options]).cast(T.ArrayType(dtype))
        return F.get(values, k.cast("int"))
    expr = None
    for i, option in enumerate(options):
        value = spark_literal(option, dtype)
        expr = F.when(k == i, value) if expr is None else expr.when(k == i, value)
    return expr


def _field(schema: T.StructType, name: str) -> T.DataType:
    return schema[name].dataType


# ---------------------------------------------------------------------------
# roles
# ---------------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pick_source, line = F.col("l_orderkey") + F.col("l_linenumber"), F.col("l_linenumber")

    def of(*sources: str) -> Column:
        return F.pmod(pick_source, F.lit(len(TESTBED_SOURCES))).isin(*map(TESTBED_SOURCES.index, sources))

    # what comes of lineitem alone is computed before it is shuffled to the orders, and only where it is used
    narrow = li.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(of("chembl", "intogen"), F.col("l_suppkey")).alias("l_suppkey"),
        F.floor(F.col("l_quantity")).cast("int").alias("quantity"),
        F.when(F.pmod(line, F.lit(3)) == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_discount") - F.lit(0.05)).alias("beta"),
        F.when(F.pmod(line, F.lit(2)) == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_tax") / F.lit(0.04)).alias("oddsRatio"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = narrow.join(orders, narrow.l_orderkey == orders.o_orderkey, "inner")
    s = schemas.EVIDENCE
    return rows.select(
        pick(pick_source, TESTBED_SOURCES, T.StringType()).alias("datasourceId"),
        F.when(line == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("T"), F.col("l_partkey").cast("string"))).alias("targetId"),
        F.when(F.pmod(F.col("l_orderkey"), F.lit(23)) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("D"), F.col("o_custkey").cast("string")))
        .alias("diseaseId"),
        F.when(of("chembl"), F.concat(F.lit("CHEMBL"), F.col("l_suppkey").cast("string"))).alias("drugId"),
        "beta", "oddsRatio",
        pick(F.col("quantity"), SIGNIFICANCE_OPTIONS, _field(s, "clinicalSignificances")).alias("clinicalSignificances"),
        pick(F.col("l_partkey"), CONSEQUENCE_OPTIONS, T.StringType())
        .alias("variantFunctionalConsequenceId"),
        pick(pick_source, QTL_OPTIONS, T.StringType()).alias("variantFunctionalConsequenceFromQtlId"),
        F.when(of("intogen"), pick(F.col("l_suppkey"), SAMPLE_OPTIONS, _field(s, "mutatedSamples")))
        .alias("mutatedSamples"),
        F.when(of("impc"), pick(F.col("l_partkey"), PHENOTYPE_OPTIONS, _field(s, "diseaseModelAssociatedModelPhenotypes")))
        .alias("diseaseModelAssociatedModelPhenotypes"),
    )


def stored_evidence(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``evidence`` written by source, the layout of a release: a filter on the source reads only its files.

    ``keep`` is a filter that the analysis begins with anyway: other rows are then neither joined nor written.
    """
    return written(keep(evidence(spark, sf_dir)), ["datasourceId"])


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    s = schemas.TARGETS
    constraint_type = _field(s, "constraint")
    lof = F.struct(F.lit("lof").alias("constraintType"), F.col("p_size").alias("upperRank"),
                   (F.col("p_retailprice") / F.lit(2000.0)).alias("oe"),
                   ((F.col("p_size") - F.lit(25)) / F.lit(10.0)).alias("score"))
    syn = F.struct(F.lit("syn").alias("constraintType"),
                   (F.col("p_size") * F.lit(2)).alias("upperRank"),
                   F.lit(1.0).alias("oe"), F.lit(0.5).alias("score"))
    k11 = F.pmod(F.col("p_partkey"), F.lit(11))
    constraint = (
        F.when(k11 == 0, F.lit(None).cast(constraint_type))
        .when(k11 == 1, F.array(syn).cast(constraint_type))
        .otherwise(F.array(syn, lof).cast(constraint_type))
    )
    return part.select(
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("approvedSymbol"),
        pick(F.col("p_partkey"), HALLMARK_OPTIONS, _field(s, "hallmarks")).alias("hallmarks"),
        pick(F.col("p_partkey"), LIABILITY_OPTIONS, _field(s, "safetyLiabilities"))
        .alias("safetyLiabilities"),
        constraint.alias("constraint"),
    )


def mechanism_of_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = li.join(sup, li.l_suppkey == sup.s_suppkey, "inner")
    t1 = F.concat(F.lit("T"), F.col("l_partkey").cast("string"))
    t2 = F.concat(F.lit("T"), (F.col("l_partkey") + 1).cast("string"))
    return rows.select(
        F.when(F.pmod(F.col("l_partkey"), F.lit(17)) == 0, F.lit(None).cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("CHEMBL"), F.col("l_suppkey").cast("string"))))
        .alias("chemblIds"),
        F.when(F.col("l_linenumber") == 1, F.array(t1)).otherwise(F.array(t1, t2)).alias("targets"),
        pick(F.col("s_nationkey") + F.col("l_partkey"), ACTION_OPTIONS, T.StringType())
        .alias("actionType"),
        F.concat(F.lit("moa "), F.col("s_nationkey").cast("string")).alias("mechanismOfAction"),
    )


def mouse_phenotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("targetFromSourceId"),
        F.concat_ws(" ", "event_type", F.pmod(F.col("user_id") + F.pmod("event_id", F.lit(3)), F.lit(LABEL_CLASSES))
                    .cast("string")).alias("modelPhenotypeLabel"),
        pick(F.col("event_id"), CLASS_OPTIONS, _field(schemas.MOUSE_PHENOTYPES, "modelPhenotypeClasses"))
        .alias("modelPhenotypeClasses"),
    )


def drug_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    k4 = F.pmod(F.col("s_suppkey"), F.lit(4))

    def rows(warning: str | None, keep) -> DataFrame:
        return sup.filter(k4.isin(*keep)).select(
            F.array(F.concat(F.lit("CHEMBL"), F.col("s_suppkey").cast("string"))).alias("chemblIds"),
            pick(F.col("s_nationkey"), TOXICITY_OPTIONS, T.StringType()).alias("toxicityClass"),
            F.lit(warning).cast("string").alias("warningType"),
        )

    return rows("Black Box Warning", (0, 1)).unionByName(rows("Withdrawn", (1, 2))).unionByName(rows(None, (3,)))


def approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey").cast("string")
    ids = F.concat(F.lit(" T"), pk, F.lit(" ; T"), (F.col("p_partkey") + 2).cast("string"), F.lit(";T"), pk, F.lit(" "))
    return part.select(F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, ids).alias("targetIds"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, y2, score, score2): labels as outcomes, document size as predictor."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "inner").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("int").alias("y"),
        F.col("toxic").cast("int").alias("y2"),
        F.col("n_chars").cast("double").alias("score"),
        F.pmod(F.col("doc_id"), F.lit(17)).cast("double").alias("score2"),
    )

"""Declared read schemas for the input tables.

Declaring the schema keeps reads free of inference jobs and lets the parquet
reader prune nested fields to the ones an operator touches.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()


def _arr(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element, True)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


EVIDENCE = _struct(
    ("datasourceId", _S),
    ("targetId", _S),
    ("diseaseId", _S),
    ("drugId", _S),
    ("beta", _D),
    ("oddsRatio", _D),
    ("clinicalSignificances", _arr(_S)),
    ("variantFunctionalConsequenceId", _S),
    ("variantFunctionalConsequenceFromQtlId", _S),
    ("mutatedSamples", _arr(_struct(("functionalConsequenceId", _S)))),
    ("diseaseModelAssociatedModelPhenotypes", _arr(_struct(("id", _S), ("label", _S)))),
)

TARGETS = _struct(
    ("id", _S),
    ("approvedSymbol", _S),
    ("hallmarks", _struct(("attributes", _arr(_struct(("description", _S)))))),
    ("safetyLiabilities", _arr(_struct(("datasource", _S), ("event", _S)))),
    ("constraint", _arr(_struct(("constraintType", _S), ("upperRank", T.IntegerType()),
                                ("oe", _D), ("score", _D)))),
)

MECHANISM_OF_ACTION = _struct(
    ("chemblIds", _arr(_S)),
    ("targets", _arr(_S)),
    ("actionType", _S),
    ("mechanismOfAction", _S),
)

MOUSE_PHENOTYPES = _struct(
    ("targetFromSourceId", _S),
    ("modelPhenotypeLabel", _S),
    ("modelPhenotypeClasses", _arr(_struct(("id", _S)))),
)

DRUG_WARNINGS = _struct(
    ("chemblIds", _arr(_S)),
    ("toxicityClass", _S),
    ("warningType", _S),
)

# CSV inputs: header line, every column read as text unless declared.


PHENOTYPE_WEIGHTS = _struct(("idLabel", _S), ("phenoLabel", _S), ("curatedScore", _D))

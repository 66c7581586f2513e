"""One row per case of the labelling rule tables (variant effect, direction,
homogenized cell, onco label, coherency)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoscope.functions import rules as R

LOF = "SO_0001587"      # stop_gained, a LoF consequence
GOF = "SO_0002053"
QD, QU, QX = "SO_0002316", "SO_0002315", "SO_0001583"
CONFLICT = "conflict/noEvaluable"

EFFECT_SCHEMA = T.StructType([
    T.StructField("src", T.StringType()), T.StructField("vc", T.StringType()),
    T.StructField("q", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("disease", T.StringType()), T.StructField("onco", T.StringType()),
    T.StructField("annot", T.IntegerType()), T.StructField("codes", T.ArrayType(T.StringType())),
    T.StructField("actions", T.ArrayType(T.StringType())), T.StructField("expected", T.StringType()),
])

G = "ot_genetics_portal"
EFFECT_CASES = [
    # genetics portal: consequence set, no QTL
    (G, LOF, None, "t", "d", None, 0, None, None, "LoF"),
    (G, GOF, None, "t", "d", None, 0, None, None, "GoF"),
    (G, QX, None, "t", "d", None, 0, None, None, "noEvaluable"),
    # LoF consequence with QTL
    (G, LOF, QD, "t", "d", None, 0, None, None, "LoF"),
    (G, LOF, QU, "t", "d", None, 0, None, None, CONFLICT),
    (G, LOF, QX, "t", "d", None, 0, None, None, "LoF"),
    # neither LoF nor GoF, with QTL
    (G, QX, QD, "t", "d", None, 0, None, None, "LoF"),
    (G, QX, QU, "t", "d", None, 0, None, None, "GoF"),
    (G, QX, QX, "t", "d", None, 0, None, None, "noEvaluable"),
    # GoF consequence with QTL (no fallback: null)
    (G, GOF, QD, "t", "d", None, 0, None, None, CONFLICT),
    (G, GOF, QU, "t", "d", None, 0, None, None, "GoF"),
    (G, GOF, QX, "t", "d", None, 0, None, None, None),
    # no consequence
    (G, None, QD, "t", "d", None, 0, None, None, "LoF"),
    (G, None, QU, "t", "d", None, 0, None, None, "GoF"),
    (G, None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("gene_burden", None, None, "t", "d", None, 0, None, None, "LoF"),
    ("gene_burden", None, None, None, "d", None, 0, None, None, "noEvaluable"),
    ("eva", LOF, None, "t", "d", None, 0, None, None, "LoF"),
    ("eva", GOF, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("eva_somatic", LOF, None, "t", "d", None, 0, None, None, "LoF"),
    ("eva_somatic", None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("gene2phenotype", "SO_0002317", None, "t", "d", None, 0, None, None, "LoF"),
    ("gene2phenotype", "SO_0002315", None, "t", "d", None, 0, None, None, "GoF"),
    ("gene2phenotype", LOF, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("orphanet", "SO_0002054", None, "t", "d", None, 0, None, None, "LoF"),
    ("orphanet", "SO_0002053", None, "t", "d", None, 0, None, None, "GoF"),
    ("orphanet", None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("cancer_gene_census", None, None, "t", "d", "oncogene", 0, None, None, "GoF"),
    ("cancer_gene_census", None, None, "t", "d", "TSG", 0, None, None, "LoF"),
    ("cancer_gene_census", None, None, "t", "d", "bivalent", 0, None, None, "bivalent"),
    ("cancer_gene_census", None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("intogen", None, None, "t", "d", None, 1, ["SO_0002053"], None, "GoF"),
    ("intogen", None, None, "t", "d", None, 1, ["SO_0002054"], None, "LoF"),
    ("intogen", None, None, "t", "d", None, 1, ["SO_0001583"], None, None),
    ("intogen", None, None, "t", "d", None, 2, ["SO_0002053"], None, "bivalentIntogen"),
    ("intogen", None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("impc", None, None, "t", "d", None, 0, None, None, "LoF"),
    ("impc", None, None, "t", None, None, 0, None, None, "noEvaluable"),
    ("chembl", None, None, "t", "d", None, 0, None, ["INHIBITOR", "AGONIST"], "LoF"),
    ("chembl", None, None, "t", "d", None, 0, None, ["AGONIST"], "GoF"),
    ("chembl", None, None, "t", "d", None, 0, None, ["OPENER"], "noEvaluable"),
    ("chembl", None, None, "t", "d", None, 0, None, None, "noEvaluable"),
    ("europepmc", LOF, None, "t", "d", None, 0, None, None, None),
]


def test_variant_effect_table(spark):
    df = spark.createDataFrame(EFFECT_CASES, EFFECT_SCHEMA)
    c = F.col
    out = df.withColumn("got", R.variant_effect(c("src"), c("vc"), c("q"), c("target"), c("disease"),
                                                c("onco"), c("annot"), c("codes"), c("actions")))
    bad = [(r.src, r.vc, r.q, r.expected, r.got) for r in out.collect() if r.expected != r.got]
    assert not bad


DIRECTION_SCHEMA = "src string, beta double, odds double, sig array<string>, disease string, expected string"
DIRECTION_CASES = [
    (G, 0.2, None, None, "d", "risk"),
    (G, -0.2, None, None, "d", "protect"),
    (G, 0.0, None, None, "d", "noEvaluable"),
    (G, None, 1.5, None, "d", "risk"),
    (G, None, 0.5, None, "d", "protect"),
    (G, None, 1.0, None, "d", "noEvaluable"),
    (G, None, None, None, "d", "noEvaluable"),
    (G, 0.2, 1.5, None, "d", CONFLICT),
    ("gene_burden", 0.2, 1.5, None, "d", "conflict"),
    ("gene_burden", None, 0.5, None, "d", "protect"),
    ("eva", None, None, ["pathogenic"], "d", "risk"),
    ("eva", None, None, ["pathogenic", "benign"], "d", "noEvaluable"),
    ("eva", None, None, ["benign", "pathogenic"], "d", "risk"),
    ("eva", None, None, ["likely pathogenic"], "d", "risk"),
    ("eva", None, None, ["protective"], "d", "protect"),
    ("eva", None, None, ["Pathogenic"], "d", "noEvaluable"),
    ("eva_somatic", None, None, None, "d", "noEvaluable"),
    ("gene2phenotype", None, None, None, "d", "risk"),
    ("orphanet", None, None, None, None, "noEvaluable"),
    ("cancer_gene_census", None, None, None, "d", "risk"),
    ("intogen", None, None, None, "d", "risk"),
    ("impc", None, None, None, "d", "risk"),
    ("chembl", None, None, None, "d", "protect"),
    ("chembl", None, None, None, None, "noEvaluable"),
]


def test_direction_table(spark):
    df = spark.createDataFrame(DIRECTION_CASES, DIRECTION_SCHEMA)
    c = F.col
    out = df.withColumn("got", R.direction_on_trait(c("src"), c("beta"), c("odds"), c("sig"), c("disease")))
    bad = [(r.src, r.beta, r.odds, r.sig, r.expected, r.got) for r in out.collect() if r.expected != r.got]
    assert not bad


def test_homogenized(spark):
    rows = [("LoF", "risk", "LoF_risk"), ("LoF", "protect", "LoF_protect"), ("GoF", "risk", "GoF_risk"),
            ("GoF", "protect", "GoF_protect"), ("bivalent", "risk", "noEvaluable"),
            (None, "risk", "noEvaluable"), ("LoF", None, "noEvaluable")]
    df = spark.createDataFrame(rows, "e string, d string, expected string")
    out = df.withColumn("got", R.homogenized(F.col("e"), F.col("d"))).collect()
    assert all(r.got == r.expected for r in out)


@pytest.mark.parametrize("descriptions,expected", [
    (["TSG"], "TSG"),
    (["oncogene"], "oncogene"),
    (["Oncogene"], "oncogene"),
    (["oncogene,TSG"], "bivalent"),
    (["TSG", "oncogene"], "bivalent"),
    (["oncogene,fusion"], "noEvaluable"),
    (["fusion,oncogene"], "oncogene"),
    (["fusion,oncogene", "oncogene,fusion"], "oncogene"),
    ([], "noEvaluable"),
])
def test_onco_label(spark, descriptions, expected):
    df = spark.createDataFrame([(descriptions,)], "d array<string>")
    assert df.select(R.onco_label(F.col("d")).alias("x")).first().x == expected


@pytest.mark.parametrize("cells,noeval,diag,one", [
    ((None, None, None, None), None, "noEvid", "noEvid"),
    ((None, None, None, None), 3, "EvidNotDoE", "EvidNotDoE"),
    ((None, None, 2, None), None, "coherent", "coherent"),
    ((None, 1, None, None), 5, "coherent", "coherent"),
    ((1, None, 1, None), None, "dispar", "dispar"),
    ((None, 1, 1, None), None, "dispar", "dispar"),
    ((None, None, 1, 1), None, "coherent", "dispar"),   # diagonal pair agrees
    ((1, 1, None, None), None, "coherent", "dispar"),   # the other diagonal
    ((1, None, None, 1), None, "dispar", "dispar"),
    ((None, 1, None, 1), None, "dispar", "dispar"),
])
def test_coherency(spark, cells, noeval, diag, one):
    df = spark.createDataFrame([cells + (noeval,)],
                               "GoF_risk long, LoF_protect long, LoF_risk long, GoF_protect long, noEvaluable long")
    from phenoscope.operators.doe import coherency
    row = coherency(df).first()
    assert (row.coherencyDiagonal, row.coherencyOneCell) == (diag, one)


def test_coherency_adds_missing_columns(spark):
    from phenoscope.operators.doe import coherency
    df = spark.createDataFrame([(1,)], "LoF_risk long")
    row = coherency(df).first()
    assert row.coherencyDiagonal == "coherent" and row.noEvaluable is None

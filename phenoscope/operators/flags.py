"""Flags per target: drug sets, warning pivots, presence, binarising, matrix.

D-21 drugs_by_effect, D-23 warning_flags, D-24 combine_flags,
D-27 presence_flags, D-33 binarise, D-38 phenotype_matrix(_wide).
Pivots always take explicit values, written as one conditional aggregation
(one shuffle, no job to discover the values); the output schema never
depends on the data.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_name(value: str) -> str:
    """Column-safe name for a pivot value: non-alphanumerics become ``_``."""
    return re.sub(r"[^0-9A-Za-z]+", "_", value).strip("_") or "unknown"


def unique_names(values: Sequence[str], suffix: str = "", taken: Sequence[str] = ()) -> dict[str, str]:
    """A column name for each value; names that clash, apart from case, get ``_2``, ``_3`` and so on."""
    used, out = {t.lower() for t in taken}, {}
    for value in dict.fromkeys(values):
        base, k = clean_name(value), 1
        name = base + suffix
        while name.lower() in used:
            k += 1
            name = f"{base}_{k}{suffix}"
        used.add(name.lower())
        out[value] = name
    return out


def warning_columns(classes: Sequence[str], suffix: str) -> list[str]:
    """Names of the flag columns of ``warning_flags``: ``all…``, one per class, ``other…``."""
    everything = "all" + suffix.lstrip("_")
    names = list(unique_names(classes, suffix, [everything]).values())
    return names + list(unique_names(["other"], suffix, [everything, *names]).values()) + [everything]


def warning_classes(target_warnings: DataFrame, key: str = "targetId") -> DataFrame:
    """D-23 (long form): distinct (target, warningType, toxicityClass), with ``unknown`` for a null class.

    Holds every class whatever the columns of the wide form.
    """
    return target_warnings.filter(F.col("warningType").isNotNull()).select(
        key, "warningType", F.coalesce("toxicityClass", F.lit("unknown")).alias("toxicityClass")).distinct()


#: The source whose rows name a drug.
DRUG_SOURCE = "chembl"


def drugs_by_effect(assessment: DataFrame, source: str = DRUG_SOURCE,
                    label: str = "LoF_protect", count_col: str | None = None) -> DataFrame:
    """D-21: (targetId, drugId, count) of assessed rows of one source and cell.

    ``count_col`` names a row-count column when the input is a summary.
    """
    rows = assessment.filter((F.col("datasourceId") == source) & (F.col("homogenized") == label))
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    return rows.groupBy("targetId", "drugId").agg(n.cast("long").alias("count"))


def warning_flags(target_warnings: DataFrame, warning: str, suffix: str,
                  classes: Sequence[str], key: str = "targetId") -> DataFrame:
    """D-23: per target, a 0/1 column per toxicity class with the given warning.

    A null class is the value ``unknown``; classes that are not listed set
    ``other<suffix>``, so that no warning is lost (their names are in
    ``warning_classes``). ``all<suffix>`` is 1 for every target with the warning
    (``allBBW`` for suffix ``_BBW``). The list may be empty.
    """
    rows = target_warnings.filter(F.col("warningType") == warning).withColumn(
        "_cls", F.coalesce(F.col("toxicityClass"), F.lit("unknown")))
    # a pivot with fixed values, written as one conditional aggregation
    names = warning_columns(classes, suffix)
    known = list(dict.fromkeys(classes))
    flags = [F.max((F.col("_cls") == cls).cast("int")).alias(name) for cls, name in zip(known, names)]
    other = F.max((~F.col("_cls").isin(known)).cast("int")) if known else F.max(F.lit(1))
    return rows.groupBy(key).agg(*flags, other.alias(names[-2])).withColumn(names[-1], F.lit(1))


def combine_flags(withdrawn: DataFrame, black_box: DataFrame, key: str = "targetId") -> DataFrame:
    """D-24: full outer join of two flag frames; missing flags become 0.

    ``any_warning`` is 1 on every row: a target is here because it has
    at least one of the two warnings.
    """
    joined = withdrawn.join(black_box, on=key, how="full_outer").withColumn("any_warning", F.lit(1))
    flags = [c for c in joined.columns if c != key]
    return joined.na.fill(0, subset=flags)


def presence_flags(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """D-27: ``new = 1 if source is not null else 0`` for each (source -> new)."""
    return df.withColumns({new: F.col(source).isNotNull().cast("int") for source, new in mapping.items()})


def binarise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D-33: value > 1 -> 1, null -> 0, otherwise the value, for named columns.

    A text column (such as ``approved``) becomes 1 where it has a value.
    """
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        x = F.col(c)
        if kinds[c] == "string":
            return x.isNotNull().cast("int")
        return F.when(x > 1, F.lit(1)).when(x.isNull(), F.lit(0)).otherwise(x)

    return df.withColumns({c: one(c) for c in cols})


def phenotype_matrix(phenotypes: DataFrame) -> DataFrame:
    """D-38 (long form): one row per distinct (target, phenotype label), value 1."""
    return (phenotypes.select("targetFromSourceId", "modelPhenotypeLabel")
            .filter(F.col("modelPhenotypeLabel").isNotNull()).distinct()
            .withColumn("value", F.lit(1)))


def phenotype_matrix_wide(phenotypes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """D-38 (wide): a 0/1 column per given label, one row per target.

    Labels that are not given have no column; ``phenotype_matrix`` holds all.
    """
    label = F.col("modelPhenotypeLabel")
    cols = [F.max(F.when(label == lab, F.lit(1)).otherwise(F.lit(0))).alias(name)
            for lab, name in unique_names(labels, taken=["targetFromSourceId"]).items()]
    return phenotypes.groupBy("targetFromSourceId").agg(*cols)

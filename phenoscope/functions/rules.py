"""Labelling rules as data: ordered (predicate, label) tables -> one Column.

Every table is first-match-wins. A label of ``None`` is a real outcome
(null): the row matched and gets no label. ``OTHERWISE`` marks the fallback.
The tables restate the decision lists of the analysed job flat, so that
each row of a table is one case a unit test can name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenoscope.functions import constants as K

OTHERWISE = object()
Rule = tuple[object, object]


def _value(v) -> Column:
    if isinstance(v, Column):
        return v
    if v is None:
        return F.lit(None).cast("string")
    return F.lit(v)


def first_match(rules: Sequence[Rule]) -> Column:
    """CASE WHEN p1 THEN l1 WHEN p2 THEN l2 ... [ELSE default] END."""
    expr = None
    for cond, label in rules:
        if cond is OTHERWISE:
            return expr.otherwise(_value(label))
        expr = F.when(cond, _value(label)) if expr is None else expr.when(cond, _value(label))
    return expr


def by_source(source: Column, per_source: Mapping[str, Column]) -> Column:
    """Dispatch on the evidence source; unknown sources get null."""
    expr = None
    for name, col in per_source.items():
        expr = F.when(source == name, col) if expr is None else expr.when(source == name, col)
    return expr


def _overlaps(arr: Column, values: Sequence[str]) -> Column:
    return F.arrays_overlap(arr, F.array(*[F.lit(v) for v in values]))


# ---------------------------------------------------------------------------
# D-05 variant effect
# ---------------------------------------------------------------------------
def variant_effect(source: Column, vc: Column, qtl: Column, target: Column, disease: Column,
                   onco_label: Column, intogen_labels: Column, sample_codes: Column,
                   action_types: Column) -> Column:
    in_lof = vc.isin(*K.LOF_CONSEQUENCES)
    is_gof = vc == K.GOF_CODE
    q_down = qtl == K.QTL_DECREASE
    q_up = qtl == K.QTL_INCREASE
    conflict = "conflict/noEvaluable"
    genetics = first_match([
        (vc.isNull() & q_down, "LoF"),
        (vc.isNull() & q_up, "GoF"),
        (vc.isNull(), "noEvaluable"),
        (qtl.isNull() & in_lof, "LoF"),
        (qtl.isNull() & is_gof, "GoF"),
        (qtl.isNull(), "noEvaluable"),
        (in_lof & q_up, conflict),
        (in_lof, "LoF"),
        (is_gof & q_down, conflict),
        (is_gof & q_up, "GoF"),
        (is_gof, None),
        (q_down, "LoF"),
        (q_up, "GoF"),
        (OTHERWISE, "noEvaluable"),
    ])
    lof_variant = first_match([(in_lof, "LoF"), (OTHERWISE, "noEvaluable")])
    intogen = first_match([
        ((intogen_labels == 1) & _overlaps(sample_codes, [K.GOF_CODE]), "GoF"),
        ((intogen_labels == 1) & _overlaps(sample_codes, [K.LOF_CODE]), "LoF"),
        (intogen_labels == 1, None),
        (intogen_labels > 1, "bivalentIntogen"),
        (OTHERWISE, "noEvaluable"),
    ])
    actions = F.coalesce(action_types, F.array().cast("array<string>"))
    return by_source(source, {
        "ot_genetics_portal": genetics,
        "gene_burden": first_match([(target.isNotNull(), "LoF"), (OTHERWISE, "noEvaluable")]),
        "eva": lof_variant,
        "eva_somatic": lof_variant,
        "gene2phenotype": first_match([
            (vc == K.ABSENT_PRODUCT, "LoF"), (vc == K.QTL_INCREASE, "GoF"), (OTHERWISE, "noEvaluable")]),
        "orphanet": first_match([
            (vc == K.LOF_CODE, "LoF"), (vc == K.GOF_CODE, "GoF"), (OTHERWISE, "noEvaluable")]),
        "cancer_gene_census": first_match([
            (onco_label == "oncogene", "GoF"), (onco_label == "TSG", "LoF"),
            (onco_label == "bivalent", "bivalent"), (OTHERWISE, "noEvaluable")]),
        "intogen": intogen,
        "impc": first_match([(disease.isNotNull(), "LoF"), (OTHERWISE, "noEvaluable")]),
        "chembl": first_match([
            (_overlaps(actions, K.INHIBITOR_ACTIONS), "LoF"),
            (_overlaps(actions, K.ACTIVATOR_ACTIONS), "GoF"),
            (OTHERWISE, "noEvaluable")]),
    })


# ---------------------------------------------------------------------------
# D-06 direction on trait
# ---------------------------------------------------------------------------
def _effect_size_rule(beta: Column, odds: Column, both_label: str) -> Column:
    return first_match([
        (beta.isNull() & odds.isNull(), "noEvaluable"),
        (beta.isNotNull() & odds.isNotNull(), both_label),
        (beta > 0, "risk"),
        (beta < 0, "protect"),
        (beta.isNotNull(), "noEvaluable"),
        (odds > 1, "risk"),
        (odds < 1, "protect"),
        (OTHERWISE, "noEvaluable"),
    ])


def direction_on_trait(source: Column, beta: Column, odds: Column, significances: Column,
                       disease: Column) -> Column:
    joined = F.concat_ws(",", significances)
    clinical = first_match([
        (joined.rlike("(pathogenic)$"), "risk"),
        (joined.contains("protect"), "protect"),
        (OTHERWISE, "noEvaluable"),
    ])
    disease_risk = first_match([(disease.isNotNull(), "risk"), (OTHERWISE, "noEvaluable")])
    return by_source(source, {
        "ot_genetics_portal": _effect_size_rule(beta, odds, "conflict/noEvaluable"),
        "gene_burden": _effect_size_rule(beta, odds, "conflict"),
        "eva": clinical,
        "eva_somatic": clinical,
        "gene2phenotype": disease_risk,
        "orphanet": disease_risk,
        "cancer_gene_census": disease_risk,
        "intogen": disease_risk,
        "impc": disease_risk,
        "chembl": first_match([(disease.isNotNull(), "protect"), (OTHERWISE, "noEvaluable")]),
    })


# ---------------------------------------------------------------------------
# D-07 homogenized cell
# ---------------------------------------------------------------------------
HOMOGENIZED_CELLS = ("LoF_risk", "LoF_protect", "GoF_risk", "GoF_protect")


def homogenized(effect: Column, direction: Column) -> Column:
    """(LoF|GoF) x (risk|protect) -> ``<effect>_<direction>``; anything else noEvaluable.

    Each input is referenced once (a lookup of ``effect_direction`` in a
    literal map), so the large label expressions are never duplicated when
    Catalyst collapses the projections.
    """
    cells = F.create_map(*[F.lit(x) for c in HOMOGENIZED_CELLS for x in (c, c)])
    key = F.concat_ws("_", effect, direction)
    return F.coalesce(F.try_element_at(cells, key), F.lit("noEvaluable"))


# ---------------------------------------------------------------------------
# D-03 onco label over the (sorted) set of hallmark descriptions
# ---------------------------------------------------------------------------
def onco_label(descriptions: Column) -> Column:
    def any_match(pattern: str) -> Column:
        return F.exists(descriptions, lambda d: d.rlike(pattern))

    return first_match([
        (any_match("ncogene") & any_match("TSG"), "bivalent"),
        (any_match(r"ncogene(\s|$)"), "oncogene"),
        (any_match(r"TSG(\s|$)"), "TSG"),
        (OTHERWISE, "noEvaluable"),
    ])


# ---------------------------------------------------------------------------
# D-09 coherency of the four direction cells
# ---------------------------------------------------------------------------
def coherency(gof_risk: Column, lof_protect: Column, lof_risk: Column, gof_protect: Column,
              no_evaluable: Column, one_cell: bool) -> Column:
    cells = [gof_risk, lof_protect, lof_risk, gof_protect]
    none_set = F.lit(True)
    for c in cells:
        none_set = none_set & c.isNull()
    if one_cell:
        exactly_one = sum((c.isNotNull().cast("int") for c in cells), F.lit(0)) == 1
        verdict = first_match([(exactly_one, "coherent"), (OTHERWISE, "dispar")])
    else:
        clash = ((gof_risk.isNotNull() & lof_risk.isNotNull())
                 | (lof_protect.isNotNull() & lof_risk.isNotNull())
                 | (gof_protect.isNotNull() & gof_risk.isNotNull())
                 | (gof_protect.isNotNull() & lof_protect.isNotNull()))
        verdict = first_match([(clash, "dispar"), (OTHERWISE, "coherent")])
    return first_match([
        (none_set & no_evaluable.isNull(), "noEvid"),
        (none_set, "EvidNotDoE"),
        (OTHERWISE, verdict),
    ])


# ---------------------------------------------------------------------------
# D-28..D-32 disease class and severity
# ---------------------------------------------------------------------------
def disease_class(source: Column) -> Column:
    return first_match([
        (source.isin(*K.RARE_DISEASE_SOURCES), "rare"),
        (source.isin(*K.COMMON_DISEASE_SOURCES), "common"),
    ])


def severity(types: Column, weights: Mapping[str, float], otherwise: float | None,
             both_requires: Column | None = None) -> Column:
    """Severity of a set of disease classes: one class, both, none, else ``otherwise``."""
    n = F.size(types)
    both = n == 2 if both_requires is None else (n == 2) & both_requires
    rules = [
        ((n == 1) & F.array_contains(types, "common"), F.lit(weights["common"])),
        ((n == 1) & F.array_contains(types, "rare"), F.lit(weights["rare"])),
        (both, F.lit(weights["both"])),
        (n == 0, F.lit(0.0)),
    ]
    expr = first_match(rules)
    if otherwise is not None:
        expr = expr.otherwise(F.lit(otherwise))
    return expr.cast("double")

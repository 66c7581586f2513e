"""DuckDB formulations of every registered query (the correctness oracle).

Each query is written independently of the Spark operators: window
functions with ORDER BY, correlated counts, UNNEST and plain CASE chains.
Only the test-data derivation (``testbed``) is shared, rendered here from
the same option lists as SQL literals, so both engines see identical input.
"""

from __future__ import annotations

from phenoscope.functions import constants as C
from phenoscope.sources import testbed as TB


# ---------------------------------------------------------------------------
# literal rendering
# ---------------------------------------------------------------------------
def lit(value) -> str:
    if isinstance(value, TB.RowValue):
        return value.sql
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(lit(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"'{k}': {lit(v)}" for k, v in value.items()) + "}"
    raise TypeError(value)


def pick(key: str, options, sql_type: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {lit(o)}" for i, o in enumerate(options))
    return f"CAST(CASE ({key}) % {len(options)} {arms} END AS {sql_type})"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def sql_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


# ---------------------------------------------------------------------------
# testbed roles as CTEs
# ---------------------------------------------------------------------------
EVIDENCE = f"""
evidence AS (
  SELECT
    datasourceId,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 'T' || l_partkey END AS targetId,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE 'D' || o_custkey END AS diseaseId,
    CASE WHEN datasourceId = 'chembl' THEN 'CHEMBL' || l_suppkey END AS drugId,
    CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount - CAST(0.05 AS DOUBLE) END AS beta,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_tax / CAST(0.04 AS DOUBLE) END AS oddsRatio,
    {pick('CAST(FLOOR(l_quantity) AS INTEGER)', TB.SIGNIFICANCE_OPTIONS, 'VARCHAR[]')} AS clinicalSignificances,
    {pick('l_partkey', TB.CONSEQUENCE_OPTIONS, 'VARCHAR')} AS variantFunctionalConsequenceId,
    {pick('l_orderkey + l_linenumber', TB.QTL_OPTIONS, 'VARCHAR')} AS variantFunctionalConsequenceFromQtlId,
    CASE WHEN datasourceId = 'intogen' THEN
      {pick('l_suppkey', TB.SAMPLE_OPTIONS, 'STRUCT(functionalConsequenceId VARCHAR)[]')} END AS mutatedSamples,
    CASE WHEN datasourceId = 'impc' THEN
      {pick('l_partkey', TB.PHENOTYPE_OPTIONS, 'STRUCT(id VARCHAR, label VARCHAR)[]')} END
      AS diseaseModelAssociatedModelPhenotypes
  FROM (
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_discount,
           l.l_tax, o.o_custkey,
           {pick('l.l_orderkey + l.l_linenumber', TB.TESTBED_SOURCES, 'VARCHAR')} AS datasourceId
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  )
)"""

TARGETS = f"""
targets AS (
  SELECT
    'T' || p_partkey AS id,
    p_name AS approvedSymbol,
    {pick('p_partkey', TB.HALLMARK_OPTIONS, 'STRUCT(attributes STRUCT(description VARCHAR)[])')} AS hallmarks,
    {pick('p_partkey', TB.LIABILITY_OPTIONS, 'STRUCT(datasource VARCHAR, event VARCHAR)[]')} AS safetyLiabilities,
    CAST(CASE WHEN p_partkey % 11 = 0 THEN NULL
         WHEN p_partkey % 11 = 1 THEN [{{'constraintType': 'syn', 'upperRank': p_size * 2,
                                         'oe': CAST(1.0 AS DOUBLE), 'score': CAST(0.5 AS DOUBLE)}}]
         ELSE [{{'constraintType': 'syn', 'upperRank': p_size * 2,
                 'oe': CAST(1.0 AS DOUBLE), 'score': CAST(0.5 AS DOUBLE)}},
               {{'constraintType': 'lof', 'upperRank': p_size,
                 'oe': p_retailprice / CAST(2000.0 AS DOUBLE),
                 'score': (p_size - 25) / CAST(10.0 AS DOUBLE)}}]
    END AS STRUCT(constraintType VARCHAR, upperRank INTEGER, oe DOUBLE, score DOUBLE)[]) AS "constraint"
  FROM part
)"""

MOA = f"""
moa AS (
  SELECT
    CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE ['CHEMBL' || l_suppkey] END AS chemblIds,
    CASE WHEN l_linenumber = 1 THEN ['T' || l_partkey]
         ELSE ['T' || l_partkey, 'T' || (l_partkey + 1)] END AS targets,
    {pick('s_nationkey + l_partkey', TB.ACTION_OPTIONS, 'VARCHAR')} AS actionType,
    'moa ' || s_nationkey AS mechanismOfAction
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
)"""

MOPHE = f"""
mophe AS (
  SELECT 'T' || user_id AS targetFromSourceId,
         concat_ws(' ', event_type, (user_id + event_id % 3) % {TB.LABEL_CLASSES}) AS modelPhenotypeLabel,
         {pick('event_id', TB.CLASS_OPTIONS, 'STRUCT(id VARCHAR)[]')} AS modelPhenotypeClasses
  FROM events
)"""

WARNINGS = f"""
warnings AS (
  SELECT ['CHEMBL' || s_suppkey] AS chemblIds,
         {pick('s_nationkey', TB.TOXICITY_OPTIONS, 'VARCHAR')} AS toxicityClass,
         'Black Box Warning' AS warningType
  FROM supplier WHERE s_suppkey % 4 IN (0, 1)
  UNION ALL
  SELECT ['CHEMBL' || s_suppkey],
         {pick('s_nationkey', TB.TOXICITY_OPTIONS, 'VARCHAR')},
         'Withdrawn'
  FROM supplier WHERE s_suppkey % 4 IN (1, 2)
  UNION ALL
  SELECT ['CHEMBL' || s_suppkey],
         {pick('s_nationkey', TB.TOXICITY_OPTIONS, 'VARCHAR')},
         NULL
  FROM supplier WHERE s_suppkey % 4 = 3
)"""

APPROVALS = """
approvals AS (
  SELECT CASE WHEN p_size % 5 = 0
              THEN ' T' || p_partkey || ' ; T' || (p_partkey + 2) || ';T' || p_partkey || ' ' END AS targetIds
  FROM part
)"""

WEIGHTS = "weights(idLabel, phenoLabel, curatedScore) AS (VALUES " + ", ".join(
    f"({lit(i)}, {lit(lab)}, {lit(float(s))})" for i, lab, s in C.CURATED_PHENOTYPE_WEIGHTS) + ")"

LABELLED = """
labelled AS (
  SELECT d.doc_id AS id, CAST(l.quality AS INTEGER) AS y, CAST(l.toxic AS INTEGER) AS y2,
         CAST(d.n_chars AS DOUBLE) AS score, CAST(d.doc_id % 17 AS DOUBLE) AS score2
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


# ---------------------------------------------------------------------------
# shared derived CTEs
# ---------------------------------------------------------------------------
# explode_outer of the class ids, left join of the weights
SCORED_CLASSES = """
scored AS (
  SELECT e.targetFromSourceId, w.curatedScore AS score
  FROM (
    SELECT targetFromSourceId,
           UNNEST(CASE WHEN modelPhenotypeClasses IS NULL OR len(modelPhenotypeClasses) = 0
                       THEN [NULL] ELSE list_transform(modelPhenotypeClasses, lambda c: c.id) END) AS classId
    FROM mophe
  ) e LEFT JOIN weights w ON e.classId = w.idLabel
)"""


def harmonic_by_rank(source: str, key: str, score: str) -> str:
    """SELECT key, n_scores, harmonic (unrounded) over a (key, score) relation."""
    return f"""
  SELECT k.{key}, COUNT(r.s) AS n_scores, COALESCE(SUM(r.s / (r.rn * r.rn)), 0) AS harmonic
  FROM (SELECT DISTINCT {key} FROM {source}) k
  LEFT JOIN (
    SELECT {key}, {score} AS s,
           ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {score} DESC) AS rn
    FROM {source} WHERE {score} IS NOT NULL
  ) r ON k.{key} IS NOT DISTINCT FROM r.{key}
  GROUP BY k.{key}"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    norm = lit(C.HARMONIC_NORMALISER)

    q["curated_scores"] = with_ctes(MOPHE, WEIGHTS) + """
SELECT w.idLabel, w.phenoLabel, w.curatedScore, COUNT(c.classId) AS n_uses
FROM weights w LEFT JOIN (
  SELECT UNNEST(list_transform(modelPhenotypeClasses, lambda c: c.id)) AS classId FROM mophe
) c ON c.classId = w.idLabel
GROUP BY w.idLabel, w.phenoLabel, w.curatedScore"""

    q["score_lists"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES) + """
SELECT targetFromSourceId, COUNT(score) AS n_scores, ROUND(COALESCE(SUM(score), 0), 6) AS sum_scores,
       CAST(COUNT(DISTINCT score) AS INTEGER) AS n_distinct
FROM scored GROUP BY targetFromSourceId"""

    q["harmonic_sum"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES) + f"""
SELECT targetFromSourceId, n_scores, ROUND(harmonic, 6) AS harmonicSum,
       ROUND(harmonic / {norm}, 6) AS harmonicSumNorm
FROM ({harmonic_by_rank('scored', 'targetFromSourceId', 'score')})"""

    q["harmonic_norm"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES) + f"""
SELECT targetFromSourceId, ROUND(harmonic / {norm}, 6) AS harmonicSumNorm
FROM ({harmonic_by_rank('scored', 'targetFromSourceId', 'score')})"""

    q.update(build_features())
    q.update(build_doe())
    q.update(build_severity())
    q.update(build_evaluation())
    return q


def outer(arr: str) -> str:
    """UNNEST argument with explode_outer semantics (null/empty -> one null)."""
    return f"CASE WHEN {arr} IS NULL OR len({arr}) = 0 THEN [NULL] ELSE {arr} END"


def h2(n: str) -> str:
    """sum_{i=1..n} 1/i^2 by a list comprehension."""
    return (f"COALESCE(list_sum(list_transform(range(1, {n} + 1), "
            f"lambda i: CAST(1 AS DOUBLE) / (i * i))), 0)")


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


LOF_IN = in_list(C.LOF_CONSEQUENCES)

HARMONIC_SCORES = f"""
hs AS (
  SELECT targetFromSourceId AS id, n_scores, harmonic AS harmonicSum,
         harmonic / {dbl(C.HARMONIC_NORMALISER)} AS harmonicSumNorm
  FROM ({harmonic_by_rank('scored', 'targetFromSourceId', 'score')})
)"""

LOF_ROWS = """
lof AS (
  SELECT id, c.upperRank AS upperRank, c.oe AS oe, c.score AS scoreConstraint, c.constraintType AS constraintType
  FROM (SELECT id, UNNEST("constraint") AS c FROM targets)
  WHERE c.constraintType = 'lof'
)"""

TOLERANCE = """
tol AS (
  SELECT id, 2 * ((upperRank - mn) / (mx - mn)) - 1 AS cal_score, constraintType
  FROM lof, (SELECT MIN(upperRank) AS mn, MAX(upperRank) AS mx FROM lof)
)"""


def liability(name: str, excluded) -> str:
    return f"""
{name} AS (
  SELECT id, COUNT(l.event) AS {'safetyLiabl' if name == 'liab' else 'noToxCast'}
  FROM (SELECT id, UNNEST(safetyLiabilities) AS l FROM targets)
  WHERE l.datasource NOT IN {in_list(excluded)}
  GROUP BY id
)"""


APPROVED = """
appr AS (
  SELECT DISTINCT trim(t) AS id, 'approved' AS approved
  FROM (SELECT UNNEST(string_split(targetIds, ';')) AS t FROM approvals)
)"""


def build_features() -> dict[str, str]:
    q: dict[str, str] = {}
    q["max_harmonic"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES) + f"""
SELECT targetFromSourceId, COUNT(score) AS n_scores, ROUND({h2('COUNT(score)')}, 6) AS maxHarmonicSum
FROM scored GROUP BY targetFromSourceId"""

    q["scaled_harmonic"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES, HARMONIC_SCORES) + f"""
, mx AS (SELECT {h2('MAX(n_scores)')} AS maximum FROM hs)
SELECT id AS targetFromSourceId, ROUND(harmonicSum, 6) AS harmonicSum, ROUND(maximum, 6) AS maximum,
       ROUND(-(harmonicSum / maximum), 6) AS scaledHarmonicSum
FROM hs, mx"""

    q["liability_sources"] = with_ctes(TARGETS) + f"""
SELECT l.datasource AS datasource, COUNT(*) AS count
FROM (SELECT UNNEST({outer('safetyLiabilities')}) AS l FROM targets)
GROUP BY 1"""

    q["liability_count"] = with_ctes(TARGETS, liability("liab", C.LIABILITY_EXCLUDED)) + \
        "\nSELECT * FROM liab"
    q["liability_count_strict"] = with_ctes(TARGETS, liability("strict", C.LIABILITY_EXCLUDED_STRICT)) + \
        "\nSELECT * FROM strict"

    q["constraint_lof"] = with_ctes(TARGETS, LOF_ROWS) + """
SELECT id, upperRank, ROUND(oe, 6) AS oe, ROUND(scoreConstraint, 6) AS scoreConstraint FROM lof"""

    q["minmax_scale"] = with_ctes(TARGETS, LOF_ROWS, TOLERANCE) + """
SELECT id, ROUND(cal_score, 6) AS cal_score, constraintType FROM tol"""

    q["list_flag"] = with_ctes(APPROVALS, APPROVED) + "\nSELECT * FROM appr"

    q["phenotype_matrix"] = with_ctes(MOPHE) + """
SELECT DISTINCT targetFromSourceId, modelPhenotypeLabel, 1 AS value
FROM mophe WHERE modelPhenotypeLabel IS NOT NULL"""

    from phenoscope.plans.catalog import PHENOTYPE_LABELS
    q["phenotype_matrix_wide"] = with_ctes(MOPHE) + "\nSELECT targetFromSourceId, " + ", ".join(
        f"MAX(CASE WHEN modelPhenotypeLabel = {lit(x)} THEN 1 ELSE 0 END) AS {_clean(x)}"
        for x in PHENOTYPE_LABELS) + "\nFROM mophe GROUP BY targetFromSourceId"

    q["quantile_bins"] = with_ctes(MOPHE, WEIGHTS, SCORED_CLASSES, HARMONIC_SCORES) + """
, s AS (SELECT id, ROUND(harmonicSumNorm, 6) AS x FROM hs)
, o AS (SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS rn, COUNT(*) OVER () AS n FROM s WHERE x IS NOT NULL)
, cuts AS (SELECT o.x AS c FROM o, range(1, 10) r(j) WHERE o.rn = (j * o.n + 9) // 10)
SELECT id, x AS harmonicSumNorm,
       CASE WHEN x IS NULL THEN NULL
            ELSE CAST(1 + (SELECT COUNT(*) FROM cuts WHERE c <= s.x) AS INTEGER) END AS decilesHarmonicSumNorm
FROM s"""
    return q


# ---------------------------------------------------------------------------
# direction of effect
# ---------------------------------------------------------------------------
SOURCES_IN = in_list(C.EVIDENCE_SOURCES)

ONCO = rf"""
onco AS (
  SELECT id AS target_id, approvedSymbol,
         list_sort(list_distinct(list(a.description))) AS description,
         CASE WHEN bool_or(regexp_matches(a.description, 'ncogene'))
                   AND bool_or(regexp_matches(a.description, 'TSG')) THEN 'bivalent'
              WHEN bool_or(regexp_matches(a.description, 'ncogene(\s|$)')) THEN 'oncogene'
              WHEN bool_or(regexp_matches(a.description, 'TSG(\s|$)')) THEN 'TSG'
              ELSE 'noEvaluable' END AS TSorOncogene
  FROM (SELECT id, approvedSymbol,
               UNNEST(list_filter(hallmarks.attributes, lambda x: x.description IN {in_list(C.ONCO_DESCRIPTIONS)})) AS a
        FROM targets)
  GROUP BY id, approvedSymbol
)"""

ACTS = f"""
acts AS (
  SELECT targetId2, drugId2, list_sort(list_distinct(list(actionType))) AS actionType
  FROM (
    SELECT UNNEST({outer('targets')}) AS targetId2, drugId2, actionType
    FROM (SELECT UNNEST({outer('chemblIds')}) AS drugId2, actionType, targets FROM moa)
  )
  GROUP BY targetId2, drugId2
)"""

_CODES = "list_transform(mutatedSamples, lambda s: s.functionalConsequenceId)"

PREPARED = f"""
ev AS (SELECT * FROM evidence WHERE datasourceId IN {SOURCES_IN}),
fn AS (
  SELECT ev.*,
         CASE WHEN list_has_any({_CODES}, ['SO_0002053']) THEN 'GoF'
              WHEN list_has_any({_CODES}, ['SO_0002054']) THEN 'LoF' END AS intogen_function
  FROM ev
),
cnt AS (SELECT targetId, diseaseId, COUNT(DISTINCT intogen_function) AS n FROM fn GROUP BY targetId, diseaseId),
prep AS (
  SELECT fn.*, o.TSorOncogene, a.actionType, CAST(COALESCE(c.n, 0) AS INTEGER) AS intogenAnnot
  FROM fn
  LEFT JOIN onco o ON fn.targetId = o.target_id
  LEFT JOIN acts a ON a.drugId2 = fn.drugId AND a.targetId2 = fn.targetId
  LEFT JOIN cnt c ON fn.targetId IS NOT DISTINCT FROM c.targetId AND fn.diseaseId IS NOT DISTINCT FROM c.diseaseId
)"""


def _effect_size(both: str) -> str:
    return f"""CASE WHEN beta IS NOT NULL AND oddsRatio IS NULL THEN
                CASE WHEN beta > 0 THEN 'risk' WHEN beta < 0 THEN 'protect' ELSE 'noEvaluable' END
              WHEN beta IS NULL AND oddsRatio IS NOT NULL THEN
                CASE WHEN oddsRatio > 1 THEN 'risk' WHEN oddsRatio < 1 THEN 'protect' ELSE 'noEvaluable' END
              WHEN beta IS NULL AND oddsRatio IS NULL THEN 'noEvaluable'
              ELSE '{both}' END"""


_SIG = "array_to_string(clinicalSignificances, ',')"
_CLINICAL = (f"CASE WHEN regexp_matches({_SIG}, '(pathogenic)$') THEN 'risk' "
             f"WHEN contains({_SIG}, 'protect') THEN 'protect' ELSE 'noEvaluable' END")
_DISEASE_RISK = "CASE WHEN diseaseId IS NOT NULL THEN 'risk' ELSE 'noEvaluable' END"
_VC, _Q = "variantFunctionalConsequenceId", "variantFunctionalConsequenceFromQtlId"

LABELLED_ROWS = f"""
lab AS (
  SELECT prep.*,
    CASE datasourceId
      WHEN 'ot_genetics_portal' THEN
        CASE WHEN {_VC} IS NOT NULL THEN
               CASE WHEN {_Q} IS NULL THEN
                      CASE WHEN {_VC} IN {LOF_IN} THEN 'LoF' WHEN {_VC} = 'SO_0002053' THEN 'GoF'
                           ELSE 'noEvaluable' END
                    WHEN {_VC} IN {LOF_IN} THEN
                      CASE WHEN {_Q} = 'SO_0002315' THEN 'conflict/noEvaluable' ELSE 'LoF' END
                    WHEN {_VC} = 'SO_0002053' THEN
                      CASE WHEN {_Q} = 'SO_0002316' THEN 'conflict/noEvaluable'
                           WHEN {_Q} = 'SO_0002315' THEN 'GoF' END
                    ELSE CASE WHEN {_Q} = 'SO_0002316' THEN 'LoF' WHEN {_Q} = 'SO_0002315' THEN 'GoF'
                              ELSE 'noEvaluable' END
               END
             ELSE CASE WHEN {_Q} = 'SO_0002316' THEN 'LoF' WHEN {_Q} = 'SO_0002315' THEN 'GoF'
                       ELSE 'noEvaluable' END
        END
      WHEN 'gene_burden' THEN CASE WHEN targetId IS NOT NULL THEN 'LoF' ELSE 'noEvaluable' END
      WHEN 'eva' THEN CASE WHEN {_VC} IN {LOF_IN} THEN 'LoF' ELSE 'noEvaluable' END
      WHEN 'eva_somatic' THEN CASE WHEN {_VC} IN {LOF_IN} THEN 'LoF' ELSE 'noEvaluable' END
      WHEN 'gene2phenotype' THEN CASE {_VC} WHEN 'SO_0002317' THEN 'LoF' WHEN 'SO_0002315' THEN 'GoF'
                                 ELSE 'noEvaluable' END
      WHEN 'orphanet' THEN CASE {_VC} WHEN 'SO_0002054' THEN 'LoF' WHEN 'SO_0002053' THEN 'GoF'
                           ELSE 'noEvaluable' END
      WHEN 'cancer_gene_census' THEN CASE TSorOncogene WHEN 'oncogene' THEN 'GoF' WHEN 'TSG' THEN 'LoF'
                                     WHEN 'bivalent' THEN 'bivalent' ELSE 'noEvaluable' END
      WHEN 'intogen' THEN
        CASE WHEN intogenAnnot = 1 THEN
               CASE WHEN list_has_any({_CODES}, ['SO_0002053']) THEN 'GoF'
                    WHEN list_has_any({_CODES}, ['SO_0002054']) THEN 'LoF' END
             WHEN intogenAnnot > 1 THEN 'bivalentIntogen'
             ELSE 'noEvaluable' END
      WHEN 'impc' THEN CASE WHEN diseaseId IS NOT NULL THEN 'LoF' ELSE 'noEvaluable' END
      WHEN 'chembl' THEN
        CASE WHEN list_has_any(COALESCE(actionType, []), {sql_list(C.INHIBITOR_ACTIONS)}) THEN 'LoF'
             WHEN list_has_any(COALESCE(actionType, []), {sql_list(C.ACTIVATOR_ACTIONS)}) THEN 'GoF'
             ELSE 'noEvaluable' END
    END AS variantEffect,
    CASE datasourceId
      WHEN 'ot_genetics_portal' THEN {_effect_size('conflict/noEvaluable')}
      WHEN 'gene_burden' THEN {_effect_size('conflict')}
      WHEN 'eva' THEN {_CLINICAL}
      WHEN 'eva_somatic' THEN {_CLINICAL}
      WHEN 'gene2phenotype' THEN {_DISEASE_RISK}
      WHEN 'orphanet' THEN {_DISEASE_RISK}
      WHEN 'cancer_gene_census' THEN {_DISEASE_RISK}
      WHEN 'intogen' THEN {_DISEASE_RISK}
      WHEN 'impc' THEN {_DISEASE_RISK}
      WHEN 'chembl' THEN CASE WHEN diseaseId IS NOT NULL THEN 'protect' ELSE 'noEvaluable' END
    END AS directionOnTrait
  FROM prep
),
assessment AS (
  SELECT lab.*,
    CASE WHEN variantEffect = 'LoF' AND directionOnTrait = 'risk' THEN 'LoF_risk'
         WHEN variantEffect = 'LoF' AND directionOnTrait = 'protect' THEN 'LoF_protect'
         WHEN variantEffect = 'GoF' AND directionOnTrait = 'risk' THEN 'GoF_risk'
         WHEN variantEffect = 'GoF' AND directionOnTrait = 'protect' THEN 'GoF_protect'
         ELSE 'noEvaluable' END AS homogenized
  FROM lab
)"""

ASSESSMENT_CTES = (EVIDENCE, TARGETS, MOA, ONCO, ACTS, PREPARED, LABELLED_ROWS)


def _none4(cols) -> str:
    return " AND ".join(f"{c} IS NULL" for c in cols)


def build_doe() -> dict[str, str]:
    q: dict[str, str] = {}
    q["filter_sources"] = with_ctes(EVIDENCE) + f"""
SELECT datasourceId, COUNT(*) AS n_rows FROM evidence WHERE datasourceId IN {SOURCES_IN} GROUP BY 1"""

    q["action_types"] = with_ctes(MOA, ACTS) + """
SELECT targetId2, drugId2, array_to_string(actionType, ',') AS actionTypes,
       CAST(len(actionType) AS INTEGER) AS n_actions FROM acts"""

    q["onco_label"] = with_ctes(TARGETS, ONCO) + """
SELECT target_id, approvedSymbol, array_to_string(description, ',') AS descriptions, TSorOncogene FROM onco"""

    q["gof_lof_samples"] = with_ctes(EVIDENCE, TARGETS, MOA, ONCO, ACTS, PREPARED) + """
SELECT targetId, diseaseId, intogen_function, intogenAnnot, COUNT(*) AS n_rows
FROM prep WHERE datasourceId = 'intogen'
GROUP BY targetId, diseaseId, intogen_function, intogenAnnot"""

    base = with_ctes(*ASSESSMENT_CTES)
    q["variant_effect"] = base + f"""
SELECT datasourceId, targetId, diseaseId, drugId, {_VC}, {_Q}, variantEffect FROM assessment"""

    q["direction_on_trait"] = base + """
SELECT datasourceId, targetId, diseaseId, ROUND(beta, 6) AS beta, ROUND(oddsRatio, 6) AS oddsRatio,
       COALESCE(array_to_string(clinicalSignificances, ','), '') AS significances, directionOnTrait
FROM assessment"""

    q["homogenized"] = base + """
SELECT variantEffect, directionOnTrait, homogenized, COUNT(*) AS n_rows FROM assessment GROUP BY ALL"""

    q["direction_of_effect"] = base + """
SELECT datasourceId, variantEffect, directionOnTrait, homogenized, COUNT(*) AS n_rows
FROM assessment GROUP BY ALL"""

    cells = ["GoF_risk", "LoF_protect", "LoF_risk", "GoF_protect"]
    counts = ", ".join(f"NULLIF(COUNT(*) FILTER (WHERE homogenized = '{c}'), 0) AS {c}"
                       for c in cells + ["noEvaluable"])
    none4 = _none4(cells)
    any4 = " OR ".join(f"{c} IS NOT NULL" for c in cells)
    one = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cells)
    q["coherency"] = base + f"""
, w AS (SELECT targetId, diseaseId, {counts} FROM assessment GROUP BY targetId, diseaseId)
SELECT *,
  CASE WHEN {none4} AND noEvaluable IS NULL THEN 'noEvid'
       WHEN {none4} AND noEvaluable IS NOT NULL THEN 'EvidNotDoE'
       WHEN {any4} THEN
         CASE WHEN GoF_risk IS NOT NULL AND LoF_risk IS NOT NULL THEN 'dispar'
              WHEN LoF_protect IS NOT NULL AND LoF_risk IS NOT NULL THEN 'dispar'
              WHEN GoF_protect IS NOT NULL AND GoF_risk IS NOT NULL THEN 'dispar'
              WHEN GoF_protect IS NOT NULL AND LoF_protect IS NOT NULL THEN 'dispar'
              ELSE 'coherent' END END AS coherencyDiagonal,
  CASE WHEN {none4} AND noEvaluable IS NULL THEN 'noEvid'
       WHEN {none4} AND noEvaluable IS NOT NULL THEN 'EvidNotDoE'
       WHEN ({one}) = 1 THEN 'coherent' ELSE 'dispar' END AS coherencyOneCell
FROM w"""

    q["drugs_by_effect"] = base + ",\n" + PAIRS.strip() + "\nSELECT * FROM pairs"
    q["attach_warnings"] = with_ctes(*ASSESSMENT_CTES, WARNINGS, PAIRS, TARGET_WARNINGS) + "\nSELECT * FROM tw"
    q["warning_flags"] = with_ctes(*ASSESSMENT_CTES, WARNINGS, PAIRS, TARGET_WARNINGS,
                                   warning_cte("bbw", "Black Box Warning", "_BBW")) + "\nSELECT * FROM bbw"
    q["combine_flags"] = with_ctes(*ASSESSMENT_CTES, *FLAG_CTES) + "\nSELECT * FROM flags"
    q["comparison_frame"] = with_ctes(*COMPARISON_CTES) + """
, s AS (SELECT id, ROUND(harmonicSumNorm, 9) AS x FROM comparison)
, o AS (SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS rn, COUNT(*) OVER () AS n FROM s WHERE x IS NOT NULL)
, cuts AS (SELECT o.x AS c FROM o, range(1, 10) r(j) WHERE o.rn = (j * o.n + 9) // 10)
SELECT comparison.* REPLACE (ROUND(harmonicSum, 6) AS harmonicSum, ROUND(harmonicSumNorm, 6) AS harmonicSumNorm,
                             ROUND(cal_score, 6) AS cal_score),
       CASE WHEN x IS NULL THEN NULL
            ELSE CAST(1 + (SELECT COUNT(*) FROM cuts WHERE c <= s.x) AS INTEGER) END AS decilesHarmonicSumNorm
FROM comparison JOIN s ON comparison.id IS NOT DISTINCT FROM s.id"""
    q["presence_flags"] = with_ctes(*COMPARISON_CTES) + """
SELECT id, safetyLiabilities, noToxCastLiab FROM comparison"""
    flag_cols = FLAG_COLUMNS
    q["binarise"] = with_ctes(*COMPARISON_CTES) + "\nSELECT id, " + ", ".join(
        f"CASE WHEN {c} > 1 THEN 1 WHEN {c} IS NULL THEN 0 ELSE {c} END AS {c}" for c in flag_cols) + \
        ", CASE WHEN approved IS NULL THEN 0 ELSE 1 END AS approved\nFROM comparison"
    q["warning_classes"] = with_ctes(*ASSESSMENT_CTES, WARNINGS, PAIRS, TARGET_WARNINGS) + """
SELECT DISTINCT targetId, warningType, COALESCE(toxicityClass, 'unknown') AS toxicityClass
FROM tw WHERE warningType IS NOT NULL"""
    return q


PAIRS = """
pairs AS (
  SELECT targetId, drugId, COUNT(*) AS count FROM assessment
  WHERE datasourceId = 'chembl' AND homogenized = 'LoF_protect'
  GROUP BY targetId, drugId
)"""

TARGET_WARNINGS = f"""
tw AS (
  SELECT DISTINCT p.drugId, p.targetId, p.count, w.toxicityClass, w.warningType
  FROM pairs p LEFT JOIN (
    SELECT UNNEST({outer('chemblIds')}) AS drugId, toxicityClass, warningType FROM warnings
  ) w ON p.drugId = w.drugId
)"""


def _clean(value: str) -> str:
    import re
    return re.sub(r"[^0-9A-Za-z]+", "_", value).strip("_") or "unknown"


def warning_cte(name: str, warning: str, suffix: str) -> str:
    cols = ", ".join(f"MAX(CASE WHEN cls = {lit(c)} THEN 1 ELSE 0 END) AS {_clean(c)}{suffix}"
                     for c in TB.TOXICITY_CLASSES)
    cols += f", MAX(CASE WHEN cls NOT IN {in_list(TB.TOXICITY_CLASSES)} THEN 1 ELSE 0 END) AS other{suffix}"
    return f"""
{name} AS (
  SELECT targetId, {cols}, 1 AS all{suffix.lstrip('_')}
  FROM (SELECT targetId, COALESCE(toxicityClass, 'unknown') AS cls FROM tw WHERE warningType = {lit(warning)})
  GROUP BY targetId
)"""


_CLASSES = [*map(_clean, TB.TOXICITY_CLASSES), "other"]
_WD_COLS = [f"{c}_WD" for c in _CLASSES] + ["allWD"]
_BBW_COLS = [f"{c}_BBW" for c in _CLASSES] + ["allBBW"]

FLAGS = f"""
flags AS (
  SELECT COALESCE(wd.targetId, bbw.targetId) AS id,
         {", ".join(f"COALESCE(wd.{c}, 0) AS {c}" for c in _WD_COLS)},
         {", ".join(f"COALESCE(bbw.{c}, 0) AS {c}" for c in _BBW_COLS)},
         1 AS any_warning
  FROM wd FULL OUTER JOIN bbw ON wd.targetId = bbw.targetId
)"""

FLAG_CTES = (WARNINGS, PAIRS, TARGET_WARNINGS, warning_cte("bbw", "Black Box Warning", "_BBW"),
             warning_cte("wd", "Withdrawn", "_WD"), FLAGS)

FLAG_COLUMNS = ["safetyLiabl", "noToxCast", "allBBW", "allWD", "any_warning"] + [
    f"{c}{s}" for c in _CLASSES for s in ("_BBW", "_WD")]

COMPARISON = f"""
comparison AS (
  SELECT hs.id, hs.harmonicSum, hs.harmonicSumNorm, tol.cal_score, tol.constraintType,
         liab.safetyLiabl, strict.noToxCast, appr.approved,
         {", ".join(f"flags.{c}" for c in _WD_COLS[:-1] + _BBW_COLS[:-1])},
         flags.any_warning,
         CASE WHEN flags.allBBW = 1 THEN 1 ELSE 0 END AS allBBW,
         CASE WHEN flags.allWD = 1 THEN 1 ELSE 0 END AS allWD,
         CAST(liab.safetyLiabl IS NOT NULL AS INTEGER) AS safetyLiabilities,
         CAST(strict.noToxCast IS NOT NULL AS INTEGER) AS noToxCastLiab
  FROM hs
  LEFT JOIN tol ON hs.id = tol.id
  LEFT JOIN liab ON hs.id = liab.id
  LEFT JOIN strict ON hs.id = strict.id
  LEFT JOIN appr ON hs.id = appr.id
  LEFT JOIN flags ON hs.id = flags.id
)"""

COMPARISON_CTES = (MOPHE, WEIGHTS, SCORED_CLASSES, HARMONIC_SCORES, *ASSESSMENT_CTES[1:2],
                   LOF_ROWS, TOLERANCE, liability("liab", C.LIABILITY_EXCLUDED),
                   liability("strict", C.LIABILITY_EXCLUDED_STRICT), APPROVALS, APPROVED,
                   EVIDENCE, MOA, ONCO, ACTS, PREPARED, LABELLED_ROWS, *FLAG_CTES, COMPARISON)


# ---------------------------------------------------------------------------
# severity
# ---------------------------------------------------------------------------
DISEASE_TYPES = f"""
dt AS (
  SELECT targetId, diseaseId, COUNT(targetId) AS nr, list_sort(list_distinct(list(cls))) AS diseaseType
  FROM (SELECT targetId, diseaseId, homogenized,
               CASE WHEN datasourceId IN {in_list(C.RARE_DISEASE_SOURCES)} THEN 'rare'
                    WHEN datasourceId IN {in_list(C.COMMON_DISEASE_SOURCES)} THEN 'common' END AS cls
        FROM assessment)
  WHERE homogenized = 'LoF_risk' AND cls IS NOT NULL
  GROUP BY targetId, diseaseId
)"""

TARGET_SEVERITY = """
ts AS (
  SELECT targetId, list_sort(flatten(list(DISTINCT diseaseType))) AS diseaseType FROM dt GROUP BY targetId
)"""


def _sev(t: str, common: float, rare: float, both: float, both_extra: str = "", otherwise: str = "") -> str:
    return (f"CAST(CASE WHEN len({t}) = 1 AND list_contains({t}, 'common') THEN {dbl(common)} "
            f"WHEN len({t}) = 1 AND list_contains({t}, 'rare') THEN {dbl(rare)} "
            f"WHEN len({t}) = 2{both_extra} THEN {dbl(both)} "
            f"WHEN len({t}) = 0 THEN {dbl(0.0)} {otherwise}END AS DOUBLE)")


PHENOTYPE_SEVERITY = f"""
ps AS (
  SELECT modelPhenotypeLabel, diseaseType,
         {_sev('diseaseType', 0.2, 1.0, 0.6, ' AND modelPhenotypeLabel IS NOT NULL', 'ELSE 0.0 ')} AS scoreFromDisease
  FROM (
    SELECT modelPhenotypeLabel, list_sort(list_distinct(list(t))) AS diseaseType
    FROM (SELECT m.modelPhenotypeLabel, UNNEST({outer('ts.diseaseType')}) AS t
          FROM ts LEFT JOIN mophe m ON m.targetFromSourceId = ts.targetId)
    GROUP BY modelPhenotypeLabel
  )
)"""

DIS1 = f"""
j1 AS (
  SELECT m.targetFromSourceId, ps.scoreFromDisease AS score
  FROM mophe m JOIN ps ON m.modelPhenotypeLabel = ps.modelPhenotypeLabel
  WHERE m.targetFromSourceId IS NOT NULL
),
dis1 AS (
  SELECT targetFromSourceId AS id, n_scores, harmonic AS harmonicSum,
         harmonic / {dbl(C.HARMONIC_NORMALISER)} AS dis1HarmSumNorm
  FROM ({harmonic_by_rank('j1', 'targetFromSourceId', 'score')})
)"""

PHENO_EVIDENCE = f"""
pe AS (
  SELECT ph, list_sort(list_distinct(list(score))) AS scores
  FROM (
    SELECT i.ph, COALESCE({_sev('d.diseaseType', 0.2, 1.0, 0.6, '', 'ELSE 0.0 ')}, 0.0) AS score
    FROM (SELECT diseaseId, UNNEST({outer('diseaseModelAssociatedModelPhenotypes')}) AS ph
          FROM evidence WHERE datasourceId = 'impc') i
    LEFT JOIN dt d ON i.diseaseId = d.diseaseId
  )
  GROUP BY ph
)"""

DIS2 = f"""
j2 AS (
  SELECT m.targetFromSourceId, list_sum(pe.scores) / len(pe.scores) AS score
  FROM mophe m JOIN pe ON m.modelPhenotypeLabel = pe.ph.label
  WHERE m.targetFromSourceId IS NOT NULL
),
dis2 AS (
  SELECT targetFromSourceId AS id, n_scores, harmonic AS harmonicSum,
         harmonic / {dbl(C.HARMONIC_NORMALISER)} AS dis2HarmSumNorm
  FROM ({harmonic_by_rank('j2', 'targetFromSourceId', 'score')})
)"""

SEVERITY_CTES = (*ASSESSMENT_CTES, MOPHE, DISEASE_TYPES, TARGET_SEVERITY, PHENOTYPE_SEVERITY, DIS1,
                 PHENO_EVIDENCE, DIS2)


def build_severity() -> dict[str, str]:
    q: dict[str, str] = {}
    q["disease_types"] = with_ctes(*ASSESSMENT_CTES, DISEASE_TYPES) + """
SELECT targetId, diseaseId, nr, array_to_string(diseaseType, ',') AS diseaseType,
       CAST(len(diseaseType) AS INTEGER) AS bivalent FROM dt"""
    q["target_severity"] = with_ctes(*ASSESSMENT_CTES, DISEASE_TYPES, TARGET_SEVERITY) + f"""
SELECT targetId, array_to_string(diseaseType, ',') AS diseaseType,
       {_sev('diseaseType', 0.25, 1.0, 0.7)} AS scoreFromDisease FROM ts"""
    q["phenotype_severity"] = with_ctes(*ASSESSMENT_CTES, MOPHE, DISEASE_TYPES, TARGET_SEVERITY,
                                        PHENOTYPE_SEVERITY) + """
SELECT modelPhenotypeLabel, array_to_string(diseaseType, ',') AS diseaseType, scoreFromDisease FROM ps"""
    q["severity_by_target"] = with_ctes(*ASSESSMENT_CTES, MOPHE, DISEASE_TYPES, TARGET_SEVERITY,
                                        PHENOTYPE_SEVERITY, DIS1) + """
SELECT id, n_scores, ROUND(harmonicSum, 6) AS harmonicSum, ROUND(dis1HarmSumNorm, 6) AS dis1HarmSumNorm FROM dis1"""
    q["evidence_phenotype_scores"] = with_ctes(*ASSESSMENT_CTES, DISEASE_TYPES, PHENO_EVIDENCE) + """
SELECT ph.id AS phenotypeId, ph.label AS phenotypeLabel, CAST(len(scores) AS INTEGER) AS NrScores,
       ROUND(list_sum(scores) / len(scores), 6) AS average FROM pe"""
    q["evidence_severity"] = with_ctes(*SEVERITY_CTES) + """
SELECT id, n_scores, ROUND(harmonicSum, 6) AS harmonicSum, ROUND(dis2HarmSumNorm, 6) AS dis2HarmSumNorm FROM dis2"""
    return q


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------
def balanced(source: str, label: str, key: str, seed: int, name: str, size: str | None = None) -> str:
    """CTE ``name``(key, y, ...): all positives + the first n negatives by md5(key:seed), key."""
    size = size or f"SELECT COUNT(*) FROM {source} WHERE {label} = 1"
    return f"""
{name} AS (
  SELECT *, 1 AS y FROM {source} WHERE {label} = 1
  UNION ALL
  SELECT * EXCLUDE (rn), 0 AS y FROM (
    SELECT *, ROW_NUMBER() OVER (ORDER BY md5(CAST({key} AS VARCHAR) || ':{seed}'), {key}) AS rn
    FROM {source} WHERE {label} = 0
  ) WHERE rn <= ({size})
)"""


def rank_auc(source: str, y: str, score: str) -> str:
    """SELECT auc, n_pos, n_neg by the rank-sum (Mann-Whitney) formula, ties averaged."""
    return f"""
  SELECT CASE WHEN P > 0 AND N > 0 THEN
              (SUM(pos * (COALESCE(before, 0) + (cnt + 1) / CAST(2 AS DOUBLE))) - P * (P + 1) / CAST(2 AS DOUBLE))
              / (P * N) END AS auc,
         P AS n_pos, N AS n_neg
  FROM (
    SELECT pos, cnt, SUM(cnt) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM (SELECT {score} AS s, CAST(SUM({y}) AS BIGINT) AS pos, COUNT(*) AS cnt
          FROM {source} WHERE {score} IS NOT NULL AND {y} IS NOT NULL GROUP BY {score})
  ),
  (SELECT CAST(SUM({y}) AS BIGINT) AS P, CAST(COUNT(*) - SUM({y}) AS BIGINT) AS N
   FROM {source} WHERE {score} IS NOT NULL AND {y} IS NOT NULL)
  GROUP BY P, N"""


def build_evaluation() -> dict[str, str]:
    q: dict[str, str] = {}
    q["balanced_sample"] = with_ctes(LABELLED, balanced("labelled", "y", "id", 0, "bs")) + \
        "\nSELECT id, y FROM (SELECT id, bs.y AS y FROM bs)"
    q["roc_curve"] = with_ctes(LABELLED) + """
, c AS (SELECT score AS threshold, CAST(SUM(y) AS BIGINT) AS pos, CAST(SUM(1 - y) AS BIGINT) AS neg
        FROM labelled WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY score)
, r AS (SELECT threshold,
               CAST(SUM(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
               CAST(SUM(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
               SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM c)
SELECT threshold, tp, fp, ROUND(tp / P, 6) AS tpr, ROUND(fp / N, 6) AS fpr FROM r
UNION ALL SELECT DISTINCT CAST('Infinity' AS DOUBLE), 0, 0, ROUND(0 / P, 6), ROUND(0 / N, 6) FROM r"""
    q["roc_auc"] = with_ctes(LABELLED) + f"""
SELECT ROUND(auc, 6) AS auc, n_pos, n_neg FROM ({rank_auc('labelled', 'y', 'score')})"""

    parts = []
    ctes = [LABELLED, "work AS (SELECT * FROM labelled WHERE score IS NOT NULL AND score2 IS NOT NULL)"]
    for label in ("y", "y2"):
        src = f"work_{label}"
        ctes.append(f"{src} AS (SELECT id, {label} AS lbl, score, score2 FROM work)")
        ctes.append(balanced(src, "lbl", "id", 0, f"bs_{label}"))
        for pred in ("score", "score2"):
            parts.append(f"SELECT '{label}' AS label, '{pred}' AS predictor, ROUND(auc, 6) AS auc, "
                         f"n_pos + n_neg AS n FROM ({rank_auc(f'bs_{label}', 'y', pred)})")
    q["auc_grid"] = with_ctes(*ctes) + "\n" + "\nUNION ALL\n".join(parts)

    q["split_train_test"] = with_ctes(LABELLED) + """
SELECT id, y, CASE WHEN CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':2020'), 1, 8)) AS BIGINT)
                        / CAST(4294967296 AS DOUBLE) < CAST(0.7 AS DOUBLE) THEN 'train' ELSE 'test' END AS part
FROM labelled"""

    # the whole analysis: three scores against three outcomes
    labels = ("safetyLiabl", "allBBW", "allWD")
    preds = ("harmonicSumNorm", "dis1HarmSumNorm", "dis2HarmSumNorm")
    flag_cols = ", ".join(f"CASE WHEN {c} > 1 THEN 1 WHEN {c} IS NULL THEN 0 ELSE {c} END AS {c}"
                          for c in labels)
    ctes = list(dict.fromkeys(COMPARISON_CTES + SEVERITY_CTES))
    ctes.append(f"""full_frame AS (
  SELECT c.id, c.harmonicSumNorm, d1.dis1HarmSumNorm, d2.dis2HarmSumNorm, {flag_cols}
  FROM comparison c LEFT JOIN dis1 d1 ON c.id = d1.id LEFT JOIN dis2 d2 ON c.id = d2.id
)""")
    ctes.append("work2 AS (SELECT * FROM full_frame WHERE " +
                " AND ".join(f"{p} IS NOT NULL" for p in preds) + ")")
    parts = []
    for label in labels:
        ctes.append(f"w_{label} AS (SELECT id, {label} AS lbl, {', '.join(preds)} FROM work2)")
        ctes.append(balanced(f"w_{label}", "lbl", "id", 0, f"b_{label}"))
        for pred in preds:
            parts.append(f"SELECT '{label}' AS label, '{pred}' AS predictor, ROUND(auc, 6) AS auc, "
                         f"n_pos + n_neg AS n FROM ({rank_auc(f'b_{label}', 'y', pred)})")
    q["predictor_auc"] = with_ctes(*ctes) + "\n" + "\nUNION ALL\n".join(parts)
    parts = []
    liable = "SELECT COUNT(*) FROM work2 WHERE safetyLiabl = 1 AND "
    for label in labels:
        size = f"{liable} {label} = 1" if label != "safetyLiabl" else None
        ctes.append(balanced(f"w_{label}", "lbl", "id", 0, f"j_{label}", size))
        for pred in preds:
            parts.append(f"SELECT '{label}' AS label, '{pred}' AS predictor, ROUND(auc, 6) AS auc, "
                         f"n_pos + n_neg AS n FROM ({rank_auc(f'j_{label}', 'y', pred)})")
    q["predictor_auc_sized"] = with_ctes(*ctes) + "\n" + "\nUNION ALL\n".join(parts)
    base = with_ctes(*dict.fromkeys(COMPARISON_CTES + SEVERITY_CTES))
    q["feature_counts"] = base + """
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE d1.id IS NOT NULL AND d2.id IS NOT NULL AND c.safetyLiabl >= 1 AND c.allBBW = 1) AS pos_allBBW,
       COUNT(*) FILTER (WHERE d1.id IS NOT NULL AND d2.id IS NOT NULL AND c.safetyLiabl >= 1 AND c.allWD = 1) AS pos_allWD,
       COUNT(*) FILTER (WHERE d2.dis2HarmSumNorm IS NULL) AS null_dis2HarmSumNorm,
       COUNT(*) FILTER (WHERE c.cal_score IS NULL) AS null_cal_score
FROM comparison c LEFT JOIN dis1 d1 ON c.id = d1.id LEFT JOIN dis2 d2 ON c.id = d2.id"""

    # the classifier: exact rows and features, checks on what is trained
    svm = with_ctes(*COMPARISON_CTES, "sc AS (SELECT id, allWD FROM comparison WHERE harmonicSumNorm IS NOT NULL)",
                    balanced("sc", "allWD", "id", 0, "bs"))
    q["assemble_features"] = svm + """
SELECT bs.id, bs.y, CAST(bs.y AS DOUBLE) AS label, COALESCE(f.features, '') AS features
FROM bs LEFT JOIN (SELECT targetFromSourceId AS id, string_agg(DISTINCT modelPhenotypeLabel, ',' ORDER BY modelPhenotypeLabel) AS features
                   FROM mophe GROUP BY 1) f ON bs.id = f.id"""
    q["linear_svm"] = svm + """
SELECT id, y, TRUE AS is_class FROM bs
WHERE CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':2020'), 1, 8)) AS BIGINT)
      / CAST(4294967296 AS DOUBLE) >= CAST(0.7 AS DOUBLE)"""
    q["classifier_metrics"] = """
SELECT UNNEST(['areaUnderROC', 'accuracy', 'f1', 'weightedPrecision', 'weightedRecall']) AS metric, TRUE AS agrees
FROM (SELECT COUNT(*) FROM lineitem)"""
    q["quantile_bins_approx"] = """
SELECT CAST(UNNEST(range(1, 10)) AS INTEGER) AS cut, TRUE AS within FROM (SELECT COUNT(*) FROM events)"""

    q["harmonic_ranked"] = """
SELECT source, COUNT(*) AS n_scores, ROUND(SUM(n_chars / (rn * rn)), 3) AS harmonicSum
FROM (SELECT source, CAST(n_chars AS DOUBLE) AS n_chars,
             CAST(ROW_NUMBER() OVER (PARTITION BY source ORDER BY n_chars DESC) AS DOUBLE) AS rn FROM documents)
GROUP BY source"""
    q["text_numbers"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
numbers AS (
  SELECT doc_id, w, list_transform(list_filter(w, lambda x: regexp_full_match(x, '[+-]?[0-9]{1,15}([.][0-9]{1,9})?')),
                                   lambda x: CAST(x AS DOUBLE)) AS n FROM words)
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, CAST(len(n) AS INTEGER) AS n_numbers, list_min(n) AS least, list_max(n) AS most FROM numbers"""
    q["csv_columns"] = """
SELECT doc_id, CAST(LENGTH(text) AS BIGINT) AS size, MD5(text) AS digest, n_chars, TRUE AS whole FROM documents"""
    by_lang = []
    for lang in ("NULL", "'de'", "'es'", "'fr'"):
        src = f"(SELECT * FROM gl WHERE lang IS NOT DISTINCT FROM {lang})"
        by_lang.append(f"SELECT CAST({lang} AS VARCHAR) AS lang, ROUND(auc, 6) AS auc, n_pos, n_neg FROM ({rank_auc(src, 'y', 'score')})")
    q["grouped_auc"] = """WITH gl AS (SELECT NULLIF(d.lang, 'en') AS lang, CAST(l.quality AS INTEGER) AS y, CAST(d.n_chars AS DOUBLE) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
""" + "\nUNION ALL\n".join(by_lang)
    q["tied_sample"] = """
WITH c AS (SELECT COUNT(*) FILTER (WHERE l_linenumber = 1) AS p, COUNT(*) FILTER (WHERE l_linenumber <> 1) AS q FROM lineitem)
SELECT 1 AS y, p AS n FROM c UNION ALL SELECT 0, LEAST(p, q) FROM c"""
    return q

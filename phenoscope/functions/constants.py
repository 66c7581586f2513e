"""Fixed values. These must equal the analysed job's values for equal results.

They are plain domain vocabularies (sequence-ontology codes, drug action
types, evidence source names) and the curated phenotype-class weights.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — evidence sources kept for the direction-of-effect assessment
# ---------------------------------------------------------------------------
EVIDENCE_SOURCES = (
    "ot_genetics_portal",
    "gene_burden",
    "eva",
    "eva_somatic",
    "gene2phenotype",
    "orphanet",
    "cancer_gene_census",
    "intogen",
    "impc",
    "chembl",
)

# FIXED VALUES — high-impact loss-of-function variant consequences
LOF_CONSEQUENCES = (
    "SO_0001589",  # frameshift_variant
    "SO_0001587",  # stop_gained
    "SO_0001574",  # splice_acceptor_variant
    "SO_0001575",  # splice_donor_variant
    "SO_0002012",  # start_lost
    "SO_0001578",  # stop_lost
    "SO_0001893",  # transcript_ablation
)
GOF_CODE = "SO_0002053"           # gain_of_function_variant
LOF_CODE = "SO_0002054"           # loss_of_function_variant
QTL_DECREASE = "SO_0002316"       # decreased gene product level
QTL_INCREASE = "SO_0002315"       # increased gene product level
ABSENT_PRODUCT = "SO_0002317"     # absent gene product

# FIXED VALUES — cancer hallmark descriptions kept for the onco label
ONCO_DESCRIPTIONS = (
    "TSG",
    "oncogene",
    "Oncogene",
    "oncogene,TSG",
    "TSG,oncogene",
    "fusion,oncogene",
    "oncogene,fusion",
)

# FIXED VALUES — drug action types read as inhibition / activation
INHIBITOR_ACTIONS = (
    "RNAI INHIBITOR",
    "NEGATIVE MODULATOR",
    "NEGATIVE ALLOSTERIC MODULATOR",
    "ANTAGONIST",
    "ANTISENSE INHIBITOR",
    "BLOCKER",
    "INHIBITOR",
    "DEGRADER",
    "INVERSE AGONIST",
    "ALLOSTERIC ANTAGONIST",
    "DISRUPTING AGENT",
)
ACTIVATOR_ACTIONS = (
    "PARTIAL AGONIST",
    "ACTIVATOR",
    "POSITIVE ALLOSTERIC MODULATOR",
    "POSITIVE MODULATOR",
    "AGONIST",
    "SEQUESTERING AGENT",
    "STABILISER",
)

# FIXED VALUES — evidence sources read as rare / common disease
RARE_DISEASE_SOURCES = (
    "eva",
    "cancer_gene_census",
    "eva_somatic",
    "orphanet",
    "genomics_england",
    "gene2phenotype",
    "intogen",
)
COMMON_DISEASE_SOURCES = ("ot_genetics_portal", "gene_burden")

# FIXED VALUES — liability sources left out of the two liability counts
LIABILITY_EXCLUDED = ("Brennan et al. (2024)", "PharmGKB")
LIABILITY_EXCLUDED_STRICT = ("ToxCast", "Brennan et al. (2024)", "PharmGKB")

# FIXED VALUES — warning types
BLACK_BOX_WARNING = "Black Box Warning"
WITHDRAWN = "Withdrawn"

# FIXED VALUE — normaliser of the harmonic sum (about pi^2/6)
HARMONIC_NORMALISER = 1.644

# FIXED VALUES — severity weights
TARGET_SEVERITY = {"common": 0.25, "rare": 1.0, "both": 0.7}
PHENOTYPE_SEVERITY = {"common": 0.2, "rare": 1.0, "both": 0.6}

# FIXED VALUES — deciles of the harmonic score
DECILE_BINS = 10

# FIXED VALUES — curated mouse phenotype-class weights (id, label, score)
CURATED_PHENOTYPE_WEIGHTS = (
    ("MP:0005370", "liver/biliary system phenotype", 1.0),
    ("MP:0005385", "cardiovascular system phenotype", 1.0),
    ("MP:0010768", "mortality/aging", 1.0),
    ("MP:0003631", "nervous system phenotype", 0.75),
    ("MP:0005388", "respiratory system phenotype", 0.75),
    ("MP:0005367", "renal/urinary system phenotype", 0.75),
    ("MP:0005376", "homeostasis/metabolism phenotype", 0.75),
    ("MP:0005386", "behavior/neurological phenotype", 0.75),
    ("MP:0005381", "digestive/alimentary phenotype", 0.5),
    ("MP:0005379", "endocrine/exocrine gland phenotype", 0.5),
    ("MP:0005382", "craniofacial phenotype", 0.5),
    ("MP:0005377", "hearing/vestibular/ear phenotype", 0.5),
    ("MP:0005384", "cellular phenotype", 0.5),
    ("MP:0005380", "embryo phenotype", 0.5),
    ("MP:0005394", "taste/olfaction phenotype", 0.5),
    ("MP:0002006", "neoplasm", 0.5),
    ("MP:0005375", "adipose tissue phenotype", 0.5),
    ("MP:0005389", "reproductive system phenotype", 0.5),
    ("MP:0005397", "hematopoietic system phenotype", 0.5),
    ("MP:0005387", "immune system phenotype", 0.5),
    ("MP:0005391", "vision/eye phenotype", 0.5),
    ("MP:0005390", "skeleton phenotype", 0.5),
    ("MP:0005369", "muscle phenotype", 0.25),
    ("MP:0001186", "pigmentation phenotype", 0.25),
    ("MP:0005378", "growth/size/body region phenotype", 0.25),
    ("MP:0005371", "limbs/digits/tail phenotype", 0.25),
    ("MP:0010771", "integument phenotype", 0.25),
    ("MP:0002873", "normal phenotype", 0.0),
)

# homogenized labels, in the column order of the agreement frame
HOMOGENIZED_LABELS = ("GoF_risk", "LoF_protect", "LoF_risk", "GoF_protect", "noEvaluable")

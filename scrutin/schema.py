"""Schemas, fixed values and rule tables.

Everything here is data, not logic.  Values marked FIXED VALUES must equal
those of the original application for results to match; they are stated
plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical schemas
# ---------------------------------------------------------------------------

BALLOTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("annee", T.IntegerType()),
    T.StructField("tour", T.IntegerType()),
    T.StructField("departement", T.IntegerType()),
    T.StructField("inscrits", T.LongType()),
    T.StructField("votants", T.LongType()),
    T.StructField("abstentions", T.LongType()),
    T.StructField("exprimes", T.LongType()),
    T.StructField("nuance", T.StringType()),
    T.StructField("voix", T.LongType()),
])

SOCIO_SCHEMA = T.StructType([
    T.StructField("DEP", T.IntegerType()),
    T.StructField("COM", T.StringType()),
    T.StructField("LIBCOM", T.StringType()),
    T.StructField("taux_pauvrete", T.DoubleType()),
    T.StructField("revenu_median", T.DoubleType()),
    T.StructField("taux_chomage", T.DoubleType()),
    T.StructField("part_cadres", T.DoubleType()),
    T.StructField("part_ouvriers", T.DoubleType()),
    T.StructField("age_moyen", T.DoubleType()),
    T.StructField("densite_population", T.DoubleType()),
    T.StructField("annee", T.IntegerType()),
])

SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.LongType()),
    T.StructField("annee", T.IntegerType()),
    T.StructField("departement", T.IntegerType()),
    T.StructField("tour", T.IntegerType()),
    T.StructField("inscrits", T.LongType()),
    T.StructField("taux_participation", T.DoubleType()),
    T.StructField("is_urbain", T.BooleanType()),
])

# Key, count and label column names of a ballots table.
YEAR, ROUND, DEPT, LABEL, VOTES = "annee", "tour", "departement", "nuance", "voix"
COUNT_COLUMNS = ["voix", "inscrits", "votants", "abstentions", "exprimes"]
CONTEST_KEYS = [YEAR, DEPT, ROUND]
DEDUP_KEYS = [YEAR, ROUND, DEPT, LABEL]

# Output column groups of a preprocessed table, in order; others follow.
COLUMN_GROUPS = [
    ["id", "annee", "tour", "departement", "departement_nom"],
    ["nuance", "famille_politique"],
    ["inscrits", "votants", "abstentions", "exprimes", "voix"],
    ["taux_participation", "taux_abstention", "pct_exprimes", "pct_inscrits"],
    ["ancien_midi_pyrenees", "ancien_languedoc_roussillon", "typologie"],
]

# ---------------------------------------------------------------------------
# FIXED VALUES -- region, departments, names, coordinates
# ---------------------------------------------------------------------------

MIDI_PYRENEES = [9, 12, 31, 32, 46, 65, 81, 82]
LANGUEDOC_ROUSSILLON = [11, 30, 34, 48, 66]
REGION_DEPARTMENTS = MIDI_PYRENEES + LANGUEDOC_ROUSSILLON

DEPARTMENT_NAMES = {
    9: "Ariège", 11: "Aude", 12: "Aveyron", 30: "Gard",
    31: "Haute-Garonne", 32: "Gers", 34: "Hérault", 46: "Lot",
    48: "Lozère", 65: "Hautes-Pyrénées", 66: "Pyrénées-Orientales",
    81: "Tarn", 82: "Tarn-et-Garonne",
}
UNKNOWN_DEPARTMENT = "Inconnu"

DEPARTMENT_COORDS = {
    9: (42.96, 1.60), 11: (43.22, 2.35), 12: (44.35, 2.57),
    30: (43.84, 4.36), 31: (43.60, 1.44), 32: (43.65, 0.59),
    34: (43.61, 3.88), 46: (44.45, 1.44), 48: (44.52, 3.50),
    65: (43.23, 0.08), 66: (42.70, 2.90), 81: (43.93, 2.14),
    82: (44.02, 1.35),
}

# Typology (decision Q1: the intended rule) and the backtest urban set (Q2).
URBAN_DEPARTMENTS = [30, 31, 34]
BACKTEST_URBAN_DEPARTMENTS = [31, 34]
URBAN, RURAL = "Urbain", "Rural"

# Validation bounds.
MIN_YEAR, MAX_YEAR = 1990, 2025
VALID_ROUNDS = [1, 2]
HISTORY_MIN_YEAR = 2012
RECENT_YEAR = 2017

# ---------------------------------------------------------------------------
# FIXED VALUES -- column spellings
# ---------------------------------------------------------------------------

# Accented and capitalised headings renamed by the preprocessing step.
RENAME_SYNONYMS = {
    "année": "annee", "Année": "annee", "ANNEE": "annee",
    "Tour": "tour", "TOUR": "tour",
    "Departement": "departement", "DEPARTEMENT": "departement",
    "Nuance": "nuance", "NUANCE": "nuance",
    "Voix": "voix", "VOIX": "voix",
    "Inscrits": "inscrits", "INSCRITS": "inscrits",
    "Votants": "votants", "VOTANTS": "votants",
    "Abstentions": "abstentions", "ABSTENTIONS": "abstentions",
    "Exprimes": "exprimes", "EXPRIMES": "exprimes",
}

# Substring synonyms used to discover columns in a database table.
COLUMN_PATTERNS = {
    "annee": ["annee", "year", "election_year", "an"],
    "tour": ["tour", "round", "ballot"],
    "departement": ["departement", "dept", "department", "code_dept", "codedept"],
    "nuance": ["nuance", "parti", "party", "political_party", "couleur"],
    "voix": ["voix", "votes", "nb_voix", "nombre_voix"],
    "inscrits": ["inscrits", "registered", "nb_inscrits"],
    "votants": ["votants", "voters", "nb_votants"],
    "abstentions": ["abstentions", "abstention", "nb_abstentions"],
    "exprimes": ["exprimes", "valid_votes", "nb_exprimes"],
}

# Headings of open-data files, normalised (``files.heading``), and their canonical names.
OPEN_DATA_HEADINGS = {
    "code_du_departement": "departement", "code_departement": "departement", "code_dep": "departement", "dep": "departement",
    "departement": "departement", "annee": "annee", "tour": "tour", "numero_du_tour": "tour",
    "nuance": "nuance", "code_nuance": "nuance", "nuance_candidat": "nuance",
    "voix": "voix", "inscrits": "inscrits", "votants": "votants", "abstentions": "abstentions", "exprimes": "exprimes",
    "com": "commune", "code_de_la_commune": "commune", "libcom": "nom_commune", "libelle_de_la_commune": "nom_commune",
}

# Table discovery: exact name, then these name fragments in order.
PREFERRED_TABLE = "resultatslegi"
TABLE_PATTERNS = ["resultat", "election", "vote", "legi"]

# Label values that mean "no label" after strip + upper.
EMPTY_LABELS = ["NAN", "", "NULL"]
OTHER_LABEL = "AUTRE"

# ---------------------------------------------------------------------------
# FIXED VALUES -- political families: ordered substring rules, first wins
# ---------------------------------------------------------------------------

OTHER_FAMILY = "Autres"
FAMILY_RULES = [
    ("Extrême droite", ["RN", "FN", "DLF", "REC"]),
    ("Droite", ["LR", "UMP", "RPR", "UDI", "DVD", "DLR"]),
    ("Centre", ["REN", "MODEM", "UDI", "LREM", "EM"]),
    ("Gauche", ["PS", "PRG", "DVG", "MRG"]),
    ("Extrême gauche", ["LFI", "PCF", "LO", "NPA", "POI"]),
    ("Écologie", ["EELV", "VEC", "GEN"]),
]

# ---------------------------------------------------------------------------
# FIXED VALUES -- share prediction
# ---------------------------------------------------------------------------

WEIGHT_MEAN, WEIGHT_REFERENCE = 0.7, 0.3
BASE_SHARE_FLOOR = 0.5
FINAL_SHARE_FLOOR = 0.1
ERROR_LABEL = "Erreur"

# Context multipliers.  Columns: label, department set (None = any),
# minimum year, participation strictly above, participation strictly below,
# urban flag (None = any), multiplier.
MULTIPLIER_RULES = [
    ("NUP", [31], None, None, None, None, 1.3),
    ("SOC", [31], None, None, None, None, 1.2),
    ("ENS", [31], None, None, None, None, 1.15),
    ("RN", [31], None, None, None, None, 0.8),
    ("LR", [31], None, None, None, None, 0.9),
    ("ECO", [34], None, None, None, None, 1.4),
    ("NUP", [34], None, None, None, None, 1.2),
    ("ENS", [34], None, None, None, None, 1.1),
    ("RN", [34], None, None, None, None, 0.85),
    ("RN", [30, 66], None, None, None, None, 1.4),
    ("FN", [30, 66], None, None, None, None, 1.4),
    ("ENS", [30, 66], None, None, None, None, 0.8),
    ("LR", [9, 48], None, None, None, None, 1.3),
    ("DVD", [9, 48], None, None, None, None, 1.2),
    ("ENS", [9, 48], None, None, None, None, 0.7),
    ("ECO", [9, 48], None, None, None, None, 0.6),
    ("RN", None, 2025, None, None, None, 1.1),
    ("LR", None, 2025, None, None, None, 0.95),
    ("ENS", None, 2025, None, None, None, 0.9),
    ("ENS", None, None, 75.0, None, None, 1.1),
    ("LR", None, None, 75.0, None, None, 1.05),
    ("RN", None, None, 75.0, None, None, 0.9),
    ("RN", None, None, None, 55.0, None, 1.2),
    ("ENS", None, None, None, 55.0, None, 0.85),
    ("NUP", None, None, None, None, True, 1.1),
    ("SOC", None, None, None, None, True, 1.1),
    ("ECO", None, None, None, None, True, 1.1),
    ("ENS", None, None, None, None, True, 1.1),
    ("RN", None, None, None, None, True, 0.8),
    ("DVD", None, None, None, None, True, 0.8),
    ("RN", None, None, None, None, False, 1.2),
    ("LR", None, None, None, None, False, 1.2),
    ("DVD", None, None, None, None, False, 1.2),
    ("NUP", None, None, None, None, False, 0.8),
    ("ECO", None, None, None, None, False, 0.8),
    ("ENS", None, None, None, None, False, 0.8),
]

# Shares used when every adjusted share is zero.
FALLBACK_SHARES = [("RN", 25.0), ("LR", 25.0), ("ENS", 20.0),
                   ("NUP", 15.0), ("ECO", 10.0), ("DIV", 5.0)]

# Scenario defaults by department: (departments, registered, participation).
SCENARIO_DEFAULTS = [([31, 34], 45000, 68.5), ([48, 9], 8000, 72.0)]
SCENARIO_DEFAULT_REGISTERED, SCENARIO_DEFAULT_PARTICIPATION = 25000, 65.0
EXPRESSED_SHARE_OF_VOTERS = 0.95

# Confidence bands on the winning share.
CONFIDENCE_HIGH, CONFIDENCE_MEDIUM = 35.0, 25.0

# Context notes: (code, departments) and thresholds.
NOTE_DEPARTMENTS = [("urbain", [31, 34]), ("montagne", [9, 48]), ("bastion_rn", [30, 66])]
NOTE_FUTURE_YEAR = 2025
NOTE_HIGH_PARTICIPATION, NOTE_LOW_PARTICIPATION = 70.0, 55.0

# Backtest verdict thresholds.
VERDICT_EXCELLENT, VERDICT_FAIR = 3.0, 5.0
ERROR_GOOD, ERROR_FAIR = 2.0, 5.0
ERROR_LARGE = 10.0

# History info defaults.
DEFAULT_MODEL_NAME = "Analyse Nuances MySQL"
DEFAULT_YEARS_COVERED = "2012-2022"

# ---------------------------------------------------------------------------
# FIXED VALUES -- socio-economic bins (right-closed) and features
# ---------------------------------------------------------------------------

POVERTY_BINS = ([0, 10, 20, 100], ["Faible", "Moyen", "Élevé"])
INCOME_BINS = ([0, 20000, 30000, 100000], ["Bas", "Moyen", "Élevé"])
DENSITY_BINS = ([0, 50, 150, 1000000], ["Rural", "Péri-urbain", "Urbain"])

SOCIO_INDICATORS = ["taux_pauvrete", "revenu_median", "taux_chomage", "part_cadres",
                    "part_ouvriers", "age_moyen", "densite_population"]
SOCIO_FEATURES = ["participation_rate"] + SOCIO_INDICATORS
SOCIO_RENAMES = {"DEP": "departement", "COM": "commune", "LIBCOM": "nom_commune"}
LEGISLATIVE_MEANS = ["inscrits", "votants", "abstentions"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- classification
# ---------------------------------------------------------------------------

MODEL_FEATURES = ["annee", "decennie", "depuis_2000", "departement_encoded", "is_urbain",
                  "ancien_midi_pyrenees", "taux_participation", "taux_abstention", "voix",
                  "inscrits", "votants", "influence", "participation_haute",
                  "participation_faible", "tour"]
MIN_TRAIN_ROWS = 20
SPLIT_SEED = 42
FOREST_TREES, FOREST_DEPTH = 100, 10
LOGISTIC_MAX_ITER, LOGISTIC_C = 1000, 1.0
HIGH_PARTICIPATION, LOW_PARTICIPATION = 70.0, 50.0

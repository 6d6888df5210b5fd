"""DuckDB building blocks for the oracle SQL.

The oracle recomputes each registered query independently in DuckDB from
the same parquet tables.  Constant lists (departments, names, family rules)
come from ``scrutin.schema`` so that both sides share one set of fixed
values; the logic is written out in SQL.
"""

from __future__ import annotations

from scrutin import schema as S
from scrutin.sources import testdata as TD


def sql_list(values) -> str:
    out = []
    for v in values:
        if v is None:
            out.append("NULL")
        elif isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return ", ".join(out)


def case_lookup(column: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {column} = {sql_list([k])} THEN {sql_list([v])}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {sql_list([default])} END"


def family_case(column: str = "nuance") -> str:
    parts = [f"WHEN {column} IS NULL OR {column} = '{S.OTHER_LABEL}' THEN '{S.OTHER_FAMILY}'"]
    for name, frags in S.FAMILY_RULES:
        cond = " OR ".join(f"contains({column}, '{f}')" for f in frags)
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + f" ELSE '{S.OTHER_FAMILY}' END"


def r2(expr: str) -> str:
    """numpy-style round to 2 decimals (half-even on x*100)."""
    return f"(round_even(({expr}) * 100, 0) / 100)"


def pct(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {r2(f'CAST({num} AS DOUBLE) / {den} * 100')} ELSE 0.0 END"


REGION = sql_list(S.REGION_DEPARTMENTS)
TIEBREAK = ", ".join(TD.TIEBREAK)
DEPT_NAME = case_lookup("departement", S.DEPARTMENT_NAMES, S.UNKNOWN_DEPARTMENT)

BALLOTS = f"""
ballots_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
    CAST(year(o.o_orderdate) + {TD.YEAR_OFFSET} AS INTEGER) AS annee,
    CAST(l.l_linenumber % 3 AS INTEGER) AS tour,
    CAST(([{sql_list(TD.DEPARTMENT_CODES)}])[CAST(c.c_nationkey % 15 AS INTEGER) + 1] AS INTEGER) AS departement,
    ([{sql_list(TD.LABEL_CODES)}])[CAST(l.l_partkey % 16 AS INTEGER) + 1] AS nuance,
    CAST(floor(o.o_totalprice / 10) AS BIGINT) AS inscrits,
    CAST(floor(floor(o.o_totalprice / 10) * (40 + l.l_orderkey % 50) / 100) AS BIGINT) AS votants,
    CAST(floor(l.l_extendedprice / 100) AS BIGINT) AS voix
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
ballots AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, annee, tour, departement,
    nuance, inscrits, votants, inscrits - votants AS abstentions,
    votants - CAST(floor(votants * 2 / 100) AS BIGINT) AS exprimes, voix
  FROM ballots_base
)"""

# The raw text export loses every 97th department code; after parsing, the
# typed columns are those of ``ballots`` with the label cleaned.
TYPED = f"""
typed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, annee, tour,
    CASE WHEN l_partkey % {TD.BAD_CODE_MODULUS} = 0 THEN NULL ELSE departement END AS departement,
    CASE WHEN x IS NULL OR x IN ({sql_list(S.EMPTY_LABELS)}) THEN '{S.OTHER_LABEL}' ELSE x END AS nuance,
    inscrits, votants, abstentions, exprimes, voix
  FROM (SELECT *, upper(regexp_replace(regexp_replace(nuance, '^\\s+', ''), '\\s+$', '')) AS x FROM ballots)
)"""

# Typed ballots without the lost codes (the typed, not raw, source).
TYPED_CLEAN = f"""
typed_clean AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, annee, tour, departement,
    CASE WHEN x IS NULL OR x IN ({sql_list(S.EMPTY_LABELS)}) THEN '{S.OTHER_LABEL}' ELSE x END AS nuance,
    inscrits, votants, abstentions, exprimes, voix
  FROM (SELECT *, upper(regexp_replace(regexp_replace(nuance, '^\\s+', ''), '\\s+$', '')) AS x FROM ballots)
)"""

def _valid(src: str) -> str:
    return f"""
SELECT * FROM {src}
WHERE annee IS NOT NULL AND departement IS NOT NULL AND tour IS NOT NULL
  AND departement IN ({REGION}) AND annee BETWEEN {S.MIN_YEAR} AND {S.MAX_YEAR}
  AND tour IN ({sql_list(S.VALID_ROUNDS)})
  AND voix >= 0 AND inscrits >= 0 AND votants >= 0 AND abstentions >= 0 AND exprimes >= 0"""


def _enriched(src: str) -> str:
    return f"""
SELECT *,
  {DEPT_NAME} AS departement_nom,
  {family_case()} AS famille_politique,
  departement IN ({sql_list(S.MIDI_PYRENEES)}) AS ancien_midi_pyrenees,
  departement IN ({sql_list(S.LANGUEDOC_ROUSSILLON)}) AS ancien_languedoc_roussillon,
  CASE WHEN departement IN ({sql_list(S.URBAN_DEPARTMENTS)}) THEN '{S.URBAN}' ELSE '{S.RURAL}' END AS typologie,
  {pct('votants', 'inscrits')} AS taux_participation,
  {pct('abstentions', 'inscrits')} AS taux_abstention,
  {pct('voix', 'exprimes')} AS pct_exprimes,
  {pct('voix', 'inscrits')} AS pct_inscrits
FROM ({_valid(src)})"""


ENRICHED = f"enriched AS ({_enriched('typed')})"
RESULTS = f"""
results AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY annee, tour, departement, nuance ORDER BY {TIEBREAK}) AS rn
    FROM enriched) WHERE rn = 1
)"""

# History for share prediction: typed ballots of the region from 2012 on.
HISTORY = f"""
history AS (
  SELECT * FROM typed_clean
  WHERE departement IN ({REGION}) AND annee >= {S.HISTORY_MIN_YEAR}
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def rounded(sql: str, floats: list[str], digits: int = 9) -> str:
    """Wrap ``sql`` so that the named double columns are rounded half-even at
    ``digits`` decimals on the binary value (same as the Spark side)."""
    if not floats:
        return sql
    scale = float(10 ** digits)
    repl = ", ".join(f"round_even(\"{c}\" * {scale}, 0) / {scale} AS \"{c}\"" for c in floats)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"


def mean2(expr: str) -> str:
    return f"avg(CAST({expr} AS DOUBLE))"


def _spread(mult: int, modulus: int, base: float) -> str:
    return f"(CAST({base} AS DOUBLE) + CAST(c_custkey * {mult} % {modulus} AS DOUBLE) / 100)"


SOCIO = f"""
socio AS (
  SELECT CAST(([{sql_list(TD.DEPARTMENT_CODES)}])[CAST(c_nationkey % 15 AS INTEGER) + 1] AS INTEGER) AS DEP,
    CAST(c_custkey AS VARCHAR) AS COM, c_name AS LIBCOM,
    {_spread(7, 1700, 8.0)} AS taux_pauvrete,
    CAST(18000.0 AS DOUBLE) + CAST(c_custkey * 13 % 17000 AS DOUBLE) AS revenu_median,
    {_spread(3, 1000, 5.0)} AS taux_chomage,
    {_spread(5, 1700, 8.0)} AS part_cadres,
    {_spread(11, 2000, 15.0)} AS part_ouvriers,
    {_spread(17, 1500, 35.0)} AS age_moyen,
    CAST(20.0 AS DOUBLE) + CAST(c_custkey * 11 % 180 AS DOUBLE) AS densite_population,
    CAST(2012 + (c_custkey % 2) * 5 AS INTEGER) AS annee
  FROM customer
)"""

# Raw text ballots as the CSV/database export presents them.
RAW = f"""
raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    CAST(annee AS VARCHAR) AS "Année", CAST(tour AS VARCHAR) AS "TOUR",
    CASE WHEN l_partkey % {TD.BAD_CODE_MODULUS} = 0 THEN 'n/a' ELSE lpad(CAST(departement AS VARCHAR), 2, '0') END
      AS "Departement",
    nuance AS "Nuance", CAST(inscrits AS VARCHAR) AS "INSCRITS", CAST(votants AS VARCHAR) AS "Votants",
    CAST(abstentions AS VARCHAR) AS abstentions, CAST(exprimes AS VARCHAR) AS "EXPRIMES",
    CAST(voix AS VARCHAR) AS "Voix"
  FROM ballots
)"""

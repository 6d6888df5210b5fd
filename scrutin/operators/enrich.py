"""Enrichment and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.functions import exprs as X


def department_dim(spark: SparkSession) -> DataFrame:
    """The 13-row department dimension: name, former region, coordinates.

    Its size is fixed by the region, so broadcasting it is always safe.
    """
    rows = []
    for code in S.REGION_DEPARTMENTS:
        lat, lon = S.DEPARTMENT_COORDS[code]
        rows.append((code, S.DEPARTMENT_NAMES[code], code in S.MIDI_PYRENEES,
                     code in S.LANGUEDOC_ROUSSILLON, lat, lon))
    return spark.createDataFrame(
        rows, "departement INT, departement_nom STRING, ancien_midi_pyrenees BOOLEAN, "
              "ancien_languedoc_roussillon BOOLEAN, lat DOUBLE, lon DOUBLE")


# -- E1 ----------------------------------------------------------------------
def with_department_name(df: DataFrame, column: str = S.DEPT,
                         out: str = "departement_nom") -> DataFrame:
    """Name of the department, 'Inconnu' otherwise (a CASE, no join)."""
    return df.withColumn(out, X.department_name(column))


# -- E2 ----------------------------------------------------------------------
def with_family(df: DataFrame, column: str = S.LABEL, rules=S.FAMILY_RULES,
                out: str = "famille_politique") -> DataFrame:
    return df.withColumn(out, X.family(column, rules))


# -- E3 ----------------------------------------------------------------------
def with_former_region(df: DataFrame, column: str = S.DEPT, region_name: bool = False) -> DataFrame:
    cols = {
        "ancien_midi_pyrenees": F.col(column).isin(S.MIDI_PYRENEES),
        "ancien_languedoc_roussillon": F.col(column).isin(S.LANGUEDOC_ROUSSILLON),
    }
    if region_name:
        cols["region"] = F.when(F.col(column).isin(S.MIDI_PYRENEES), F.lit("Midi-Pyrénées")) \
                          .otherwise(F.lit("Languedoc-Roussillon"))
    return df.withColumns(cols)


# -- E4 ----------------------------------------------------------------------
def with_typology(df: DataFrame, urban: Sequence[int] = S.URBAN_DEPARTMENTS,
                  column: str = S.DEPT) -> DataFrame:
    """Urbain for the urban departments, Rural otherwise (decision Q1)."""
    return df.withColumn("typologie", F.when(F.col(column).isin(list(urban)), F.lit(S.URBAN))
                                       .otherwise(F.lit(S.RURAL)))


# -- E5 ----------------------------------------------------------------------
def with_rates(df: DataFrame) -> DataFrame:
    """Four percentages rounded to 2 decimals, 0 when the denominator <= 0."""
    specs = [("taux_participation", "votants", "inscrits"),
             ("taux_abstention", "abstentions", "inscrits"),
             ("pct_exprimes", "voix", "exprimes"),
             ("pct_inscrits", "voix", "inscrits")]
    out = {name: X.guarded_pct(n, d) for name, n, d in specs
           if n in df.columns and d in df.columns}
    return df.withColumns(out) if out else df


# -- E6 ----------------------------------------------------------------------
def with_raw_rates(df: DataFrame) -> DataFrame:
    """Unrounded fractions: participation, abstention = 1 - participation,
    vote share over expressed votes (over votes when there is no expressed)."""
    out = {}
    if "votants" in df.columns and "inscrits" in df.columns:
        out["participation_rate"] = X.safe_ratio("votants", "inscrits")
        out["abstention_rate"] = F.lit(1.0) - X.safe_ratio("votants", "inscrits")
    if "voix" in df.columns:
        den = "exprimes" if "exprimes" in df.columns else "voix"
        out["vote_share"] = X.safe_ratio("voix", den)
    return df.withColumns(out) if out else df


# -- E7 ----------------------------------------------------------------------
def bin_column(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str],
               out: str) -> DataFrame:
    return df.withColumn(out, X.bin_right_closed(column, edges, labels))


def with_socio_bins(df: DataFrame) -> DataFrame:
    """The three socio-economic categories, when their inputs are present."""
    specs = [("taux_pauvrete", S.POVERTY_BINS, "niveau_precarite"),
             ("revenu_median", S.INCOME_BINS, "niveau_revenu"),
             ("densite_population", S.DENSITY_BINS, "type_territoire")]
    for column, (edges, labels), out in specs:
        if column in df.columns:
            df = bin_column(df, column, edges, labels, out)
    return df


# -- E8 ----------------------------------------------------------------------
def with_map_point(dept_stats: DataFrame, spark: SparkSession | None = None,
                   participation: str = "taux_participation", votes: str = "voix",
                   scale: float = 100.0) -> DataFrame:
    """Map point per department: coordinates, radius = participation x 50 and
    a popup, with participation as a fraction (``scale`` = 100 when the input
    is a percentage, 1 when it is already a fraction).  Unknown codes are
    dropped (inner join on the 13-row dimension, broadcast)."""
    spark = spark or dept_stats.sparkSession
    dim = F.broadcast(department_dim(spark).select("departement", "departement_nom", "lat", "lon"))
    j = dept_stats.join(dim, on=S.DEPT, how="inner")
    p = F.col(participation) / scale
    popup = F.format_string("%02d - %s<br>Participation: %s%%<br>Voix: %s",
                            F.col(S.DEPT), F.col("departement_nom"),
                            F.format_number(p * 100, 1), F.format_number(F.col(votes), 0))
    return j.select(S.DEPT, "lat", "lon", (p * 50).alias("radius"), popup.alias("popup"))


# -- E9 ----------------------------------------------------------------------
def with_unrounded_participation(df: DataFrame, out: str = "taux_participation") -> DataFrame:
    """votants / inscrits x 100, 0 when undefined (history tables)."""
    return df.withColumn(out, F.coalesce(X.safe_ratio("votants", "inscrits") * 100, F.lit(0.0)))

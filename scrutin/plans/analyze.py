"""L3 / L4: the analysis stage as one long table, and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutin import schema as S
from scrutin.functions import exprs as X
from scrutin.plans import summaries

TOP_N = 5


def analyze(results: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Top departments, labels and families, typology split, rows per year,
    former-region split and mean participation, as ``(analyse, cle, valeur)``.

    One scan and one shuffle: a GROUPING SETS aggregate computes every count
    at once (``grouping_id`` tells the sets apart); each aggregated row is
    turned into its output row(s) in a single projection, and the top-n per
    analysis is ranked on those few rows only.  ``results`` may be a summary
    (``summaries.summarise``), whose states are merged in the same aggregate.
    """
    cols = set(results.columns)
    summary = "n_rows" in cols
    if summary:
        counted = F.sum("n_rows")
        midi = F.coalesce(F.sum(F.when(F.col("ancien_midi_pyrenees"), F.col("n_rows"))), F.lit(0)) if "ancien_midi_pyrenees" in cols else None
        part = summaries.mean("taux_participation") if "taux_participation_n" in cols else None
    else:
        counted = F.count(F.lit(1))
        midi = F.count_if(F.col("ancien_midi_pyrenees")) if "ancien_midi_pyrenees" in cols else None
        part = F.avg("taux_participation") if "taux_participation" in cols else None
    keyed = [c for c in (S.DEPT, S.LABEL, "famille_politique", "typologie", S.YEAR) if c in cols]
    limited = [c for c in (S.DEPT, S.LABEL, "famille_politique") if c in cols]
    aggs = [counted.alias("__n"), (midi if midi is not None else F.lit(None).cast("long")).alias("__midi"),
            (part if part is not None else F.lit(None).cast("double")).alias("__part")]
    sets = [[F.col(c)] for c in keyed] + [[]]
    g = results.groupingSets(sets, *[F.col(c) for c in keyed]).agg(
        *aggs, F.grouping_id(*[F.col(c) for c in keyed]).alias("__gid"))
    full = (1 << len(keyed)) - 1

    def entry(name, key, value, ki=None, ks=None):
        return F.struct(F.lit(name).alias("analyse") if isinstance(name, str) else name.alias("analyse"),
                        key.cast("string").alias("cle"), value.cast("double").alias("valeur"),
                        (ki if ki is not None else F.lit(None)).cast("long").alias("ki"),
                        (ks if ks is not None else F.lit(None)).cast("string").alias("ks"))

    choice = None
    for i, c in enumerate(keyed):
        gid = full ^ (1 << (len(keyed) - 1 - i))
        is_text = isinstance(results.schema[c].dataType, T.StringType)
        one = F.array(entry(c, F.col(c), F.col("__n"), None if is_text else F.col(c),
                            F.col(c) if is_text else None))
        cond = (F.col("__gid") == gid) & F.col(c).isNotNull()
        choice = F.when(cond, one) if choice is None else choice.when(cond, one)
    totals = []
    if midi is not None:
        totals += [entry("ancienne_region", F.lit("ancien_midi_pyrenees"), F.col("__midi")),
                   entry("ancienne_region", F.lit("ancien_languedoc_roussillon"),
                         F.col("__n") - F.col("__midi"))]
    if part is not None:
        totals.append(entry("participation", F.lit("moyenne"), F.col("__part")))
    if totals:
        choice = choice.when(F.col("__gid") == full, F.array(*totals))
    rows = g.select(F.explode(choice.otherwise(F.array())).alias("e")).select("e.*")
    w = Window.partitionBy("analyse").orderBy(F.col("valeur").desc(), F.col("ki").asc(), F.col("ks").asc())
    ranked = rows.withColumn("__r", F.row_number().over(w))
    keep = (~F.col("analyse").isin(limited)) | (F.col("__r") <= top_n)
    return ranked.where(keep).select("analyse", "cle", "valeur")


def analysis_report(analysis: DataFrame) -> DataFrame:
    """L3: one row per analysis with the number of result rows."""
    return analysis.groupBy("analyse").agg(F.count(F.lit(1)).alias("n_lignes"))

"""Share prediction from historical trends, batch over a scenario table
(R1-R9, R13, J4, J6).

One plan predicts every scenario at once; the unit of parallelism is
(scenario, label).  History is reduced to per-(department, year, label)
shares before anything is joined, so its size is bounded by the key space,
not by the number of ballots.  Small constant lists (fallback shares, the
label list) travel as one-row tables or array literals and are exploded, so
no side is broadcast unless its size is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin import session
from scrutin.functions import exprs as X
from scrutin.operators import aggregates as A
from scrutin.operators import clean
from scrutin.operators import ordering as W
from scrutin.plans import preprocess as L

SCENARIO_ATTRS = ["scenario_id", S.YEAR, S.DEPT, "taux_participation", "is_urbain"]


# -- history -----------------------------------------------------------------------
def load_history(df: DataFrame, regions: Sequence[int] = S.REGION_DEPARTMENTS,
                 since: int = S.HISTORY_MIN_YEAR) -> DataFrame:
    """Ballots of the region from ``since`` on, columns resolved and typed,
    with the unrounded participation (E9)."""
    from scrutin.operators import enrich
    h = L.clean_columns(df)
    h = h.where(F.col(S.DEPT).isin(list(regions)) & (F.col(S.YEAR) >= since))
    return enrich.with_unrounded_participation(h)


def summarise_history(history: DataFrame, materialise: bool = False) -> DataFrame:
    """Votes and row count per (department, year, label).  Every trend,
    fallback input and label list is derived from this one aggregate; with
    ``materialise`` it is checkpointed so that those consumers (and the
    scenario grid) read it once instead of rescanning the ballots."""
    if "n_rows" in history.columns:
        return history
    out = history.groupBy(S.DEPT, S.YEAR, S.LABEL).agg(F.sum(S.VOTES).alias(S.VOTES),
                                                      F.count(F.lit(1)).alias("n_rows"))
    return session.materialise(out) if materialise else out


def known_labels(history: DataFrame, sort: bool = True) -> DataFrame:
    """Non-null, non-blank labels of the history (A19), sorted by default."""
    return A.distinct_labels(history, sort=sort)


# -- R1 ----------------------------------------------------------------------
def _default(by_dept: list[tuple[list[int], float]], other: float) -> F.Column:
    expr = None
    for depts, value in by_dept:
        cond = F.col(S.DEPT).isin(depts)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(other))


def prepare_scenarios(df: DataFrame, urban: Sequence[int] = S.BACKTEST_URBAN_DEPARTMENTS) -> DataFrame:
    """Fill department defaults for registered voters and participation, then
    voters = floor(registered x participation / 100), abstentions, and the
    abstention rate."""
    reg = _default([(d, float(n)) for d, n, _ in S.SCENARIO_DEFAULTS], float(S.SCENARIO_DEFAULT_REGISTERED))
    part = _default([(d, p) for d, _, p in S.SCENARIO_DEFAULTS], S.SCENARIO_DEFAULT_PARTICIPATION)
    cols = {}
    cols["inscrits"] = (F.coalesce(F.col("inscrits"), reg.cast("long")) if "inscrits" in df.columns
                        else reg.cast("long"))
    cols["taux_participation"] = (F.coalesce(F.col("taux_participation"), part)
                                  if "taux_participation" in df.columns else part)
    if "is_urbain" not in df.columns:
        cols["is_urbain"] = F.col(S.DEPT).isin(list(urban))
    out = df.withColumns(cols)
    votants = F.floor(F.col("inscrits") * F.col("taux_participation") / 100).cast("long")
    return out.withColumns({
        "votants": votants,
        "abstentions": F.col("inscrits") - votants,
        "taux_abstention": F.lit(100.0) - F.col("taux_participation"),
    })


# -- R2 / R3 -------------------------------------------------------------------
def base_shares(scenarios: DataFrame, trends: DataFrame) -> DataFrame:
    """R2: max(0.5, 0.7 x mean share + 0.3 x reference share) per label of the
    scenario's department."""
    return (scenarios.select("scenario_id", S.DEPT).join(trends, on=S.DEPT, how="inner")
                     .select("scenario_id", S.LABEL, _base("avg_pct", "ref_pct").alias("base")))


def _base(mean, reference) -> F.Column:
    mean, reference = X.col(mean), X.col(reference)
    return F.greatest(F.lit(S.BASE_SHARE_FLOOR), mean * S.WEIGHT_MEAN + reference * S.WEIGHT_REFERENCE)


def _mean(years: F.Column) -> F.Column:
    """Mean share of a list of (y, pct)."""
    return F.aggregate(years, F.lit(0.0), lambda acc, x: acc + x["pct"]) / F.size(years)


def base_shares_without(scenarios: DataFrame, history: DataFrame, year: str, reference_year: str = "latest",
                        since: int = S.RECENT_YEAR) -> DataFrame:
    """R2 from the history less the scenario's own year (column ``year``).

    The history is reduced once, to a row for each department and label with
    its shares by year; a scenario takes its own year out of that list.  So
    the history is shuffled once, however many years are tested.  F8's window
    (recent years, or all if there is none) is chosen without that year too.
    """
    if reference_year not in ("latest", "earliest"):
        raise ValueError("reference_year is 'latest' or 'earliest'")
    lists = A.shares_over_years(history)
    recent = history.groupBy(S.DEPT).agg(F.collect_set(F.when(F.col(S.YEAR) >= since, F.col(S.YEAR))).alias("recent"))
    asked = scenarios.select("scenario_id", S.DEPT, F.col(year).alias("__y")).join(recent, on=S.DEPT, how="inner")
    asked = asked.withColumn("window", F.size(F.array_remove("recent", F.col("__y"))) > 0).drop("recent")
    kept = F.filter("years", lambda x: (x["y"] != F.col("__y")) & (~F.col("window") | (x["y"] >= since)))
    rows = asked.join(lists, on=S.DEPT, how="inner").withColumn("kept", kept).where(F.size("kept") > 0)
    reference = F.element_at("kept", -1 if reference_year == "latest" else 1)["pct"]
    return rows.select("scenario_id", S.LABEL, _base(_mean(F.col("kept")), reference).alias("base"))


def _pairs(label_col: F.Column, value_col: F.Column) -> F.Column:
    return F.struct(label_col.alias("nuance"), value_col.alias("v"))


def base_with_fallback(scenarios: DataFrame, history: DataFrame, labels: DataFrame,
                       trends: DataFrame | None, without: str | None = None, reference_year: str = "latest") -> DataFrame:
    """Department trends; else the regional mean (no floor); else a
    uniform share over the known labels; else one 'Erreur' row of 100.

    The fallback inputs are scalar subqueries (rows per year, the regional
    shares as a list bounded by the label domain and the calendar, the label
    list) attached to the uncovered scenarios and exploded.  ``without`` names
    the scenarios' column of the year that is left out of the history.
    """
    dept = base_shares(scenarios, trends) if without is None else base_shares_without(scenarios, history, without, reference_year)
    uncovered = (scenarios.select("scenario_id", *([F.col(without).alias("__y")] if without else []))
                 .join(dept.select("scenario_id").distinct(), on="scenario_id", how="left_anti"))
    size = (F.sum("n_rows") if "n_rows" in history.columns else F.count(F.lit(1)))
    labs = labels.agg(F.collect_list(F.col(S.LABEL))).scalar()  # the label list (label domain)
    if without:
        years = history.groupBy(S.YEAR).agg(size.alias("n")).agg(F.collect_list(F.struct(F.col(S.YEAR).alias("y"), "n"))).scalar()
        region = A.shares_over_years(clean.in_region(history), by=[]).agg(F.collect_list(F.struct(S.LABEL, "years"))).scalar()
        ctx_u = uncovered.withColumns({"size_by_year": years, "region": region, "labs": labs})
        other = lambda x: F.coalesce(x["y"] != F.col("__y"), F.lit(True))  # noqa: E731 - a row without a year is of no tested year
        left = F.transform("region", lambda r: F.struct(r[S.LABEL].alias("nuance"), F.filter(r["years"], other).alias("years")))
        reg = F.transform(F.filter(left, lambda r: F.size(r["years"]) > 0), lambda r: F.struct(r["nuance"].alias("nuance"), _mean(r["years"]).alias("v")))
        rows = F.aggregate(F.filter("size_by_year", other), F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        ctx_u = ctx_u.withColumns({"n_hist": rows, "reg": reg})
    else:
        regional = A.regional_trends(history)
        reg = regional.agg(F.collect_list(_pairs(F.col(S.LABEL), F.col("avg_pct")))).scalar()
        ctx_u = uncovered.withColumns({"n_hist": F.coalesce(history.agg(size).scalar(), F.lit(0)),
                                       "reg": reg, "labs": labs})
    n_labs = F.size("labs")
    # labels zipped with 100 / n (no higher-order function: the list is a subquery)
    uniform = F.arrays_zip(F.col("labs"), F.array_repeat(F.lit(100.0) / n_labs, n_labs)) \
               .cast("array<struct<nuance:string,v:double>>")
    error = F.array(_pairs(F.lit(S.ERROR_LABEL), F.lit(100.0)))
    choice = (F.when(F.col("n_hist") > 0, F.col("reg"))
               .when(n_labs > 0, uniform)
               .otherwise(error))
    fb = (ctx_u.select("scenario_id", F.explode(choice).alias("p"))
          .select("scenario_id", F.col("p.nuance").alias(S.LABEL), F.col("p.v").alias("base")))
    return dept.unionByName(fb)


# -- J6 / R4 -------------------------------------------------------------------
def rule_table(spark: SparkSession, rules=S.MULTIPLIER_RULES) -> DataFrame:
    """Multiplier rules as data, one row per (rule, department); null = any."""
    rows = []
    for rid, (label, depts, min_year, above, below, urban, mult) in enumerate(rules):
        for d in (depts or [None]):
            rows.append((rid, label, d, min_year, above, below, urban, float(mult)))
    return spark.createDataFrame(
        rows, "rule_id INT, nuance STRING, rule_dept INT, min_year INT, part_above DOUBLE, "
              "part_below DOUBLE, urban BOOLEAN, mult DOUBLE")


def apply_rules(shares: DataFrame, scenarios: DataFrame, rules: DataFrame | None = None,
                value: str = "base", out: str = "adj") -> DataFrame:
    """Multiply each share by the product of the matching rules' factors.

    Equi join on the label plus the rule conditions.  The own rule table (a few
    dozen rows, fixed) is broadcast; how to join a caller's table is left to
    Spark.  Labels with no rule keep 1.0.
    """
    rules = rules if rules is not None else F.broadcast(rule_table(shares.sparkSession))
    s = shares.join(scenarios.select(*SCENARIO_ATTRS), on="scenario_id", how="inner")
    r = rules.withColumnRenamed(S.LABEL, "__rl")
    cond = ((F.col(S.LABEL) == F.col("__rl"))
            & (F.col("rule_dept").isNull() | (F.col("rule_dept") == F.col(S.DEPT)))
            & (F.col("min_year").isNull() | (F.col(S.YEAR) >= F.col("min_year")))
            & (F.col("part_above").isNull() | (F.col("taux_participation") > F.col("part_above")))
            & (F.col("part_below").isNull() | (F.col("taux_participation") < F.col("part_below")))
            & (F.col("urban").isNull() | (F.col("urban") == F.col("is_urbain"))))
    j = s.join(r, on=cond, how="left")
    return (j.groupBy("scenario_id", S.LABEL, value)
             .agg(F.coalesce(F.product("mult"), F.lit(1.0)).alias("__m"))
             .select("scenario_id", S.LABEL, (F.col(value) * F.col("__m")).alias(out)))


def context_adjust(base: DataFrame, scenarios: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """R4 = J6 with the default rule table."""
    return apply_rules(base, scenarios, rules)


# -- R5 ----------------------------------------------------------------------
def normalise_shares(adjusted: DataFrame, scenarios: DataFrame, value: str = "adj") -> DataFrame:
    """max(0.1, v / total x 100) per scenario; scenarios whose total is not
    positive (or with no label at all) get the fixed fallback table."""
    total = F.sum(value).over(Window.partitionBy("scenario_id"))
    pos = (adjusted.withColumn("__t", total).where(F.col("__t") > 0)
           .select("scenario_id", S.LABEL,
                   F.greatest(F.lit(S.FINAL_SHARE_FLOOR), F.col(value) / F.col("__t") * 100).alias("pct")))
    done = pos.select("scenario_id").distinct()
    table = F.array(*[_pairs(F.lit(l), F.lit(v)) for l, v in S.FALLBACK_SHARES])
    fb = (scenarios.select("scenario_id").join(done, on="scenario_id", how="left_anti")
          .select("scenario_id", F.explode(table).alias("p"))
          .select("scenario_id", F.col("p.nuance").alias(S.LABEL), F.col("p.v").alias("pct")))
    return pos.unionByName(fb)


# -- F10 ---------------------------------------------------------------------
def keep_known(shares: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep labels present in the known list; keep all when the list is empty."""
    flag = labels.select(S.LABEL).distinct().withColumn("__known", F.lit(True))
    n = labels.agg(F.count(F.lit(1))).scalar()
    j = shares.join(flag, on=S.LABEL, how="left")
    return j.where(F.col("__known").isNotNull() | (n == 0)).drop("__known")


# -- R6 ----------------------------------------------------------------------
def predict_shares(scenarios: DataFrame, history: DataFrame, labels: DataFrame | None = None,
                   reference_year: str = "latest", rules: DataFrame | None = None,
                   trends: DataFrame | None = None, materialise: bool = True,
                   without: str | None = None) -> DataFrame:
    """Trends -> base with fallbacks -> context multipliers -> normalise ->
    known labels -> rank.  Output ``(scenario_id, nuance, pct, rang)``.

    The history summary feeds five branches; with ``materialise`` a raw
    history is summarised and checkpointed once (the summary is bounded by
    departments x years x labels).  A history that is already a summary
    (see ``summarise_history``) is used as given: the caller owns it.

    ``without``: name of the scenarios' column of a year that is left out of
    their history (a leave-one-year-out backtest)."""
    if "n_rows" not in history.columns:
        history = summarise_history(history)
        if materialise:
            history = session.materialise(history)
    if labels is None:
        labels = known_labels(history, sort=False)
    if without is None and trends is None:
        trends = A.historical_trends(history, reference_year)
    base = base_with_fallback(scenarios, history, labels, trends, without, reference_year)
    adjusted = context_adjust(base, scenarios, rules)
    shares = keep_known(normalise_shares(adjusted, scenarios), labels)
    return W.rank_predictions(shares)


# -- R7 / R8 / R9 ---------------------------------------------------------------
def estimated_votes(pred: DataFrame, scenarios: DataFrame) -> DataFrame:
    """floor(floor(voters x 0.95) x pct / 100) per label."""
    s = scenarios.select("scenario_id", "votants")
    expressed = F.floor(F.col("votants") * S.EXPRESSED_SHARE_OF_VOTERS)
    return (pred.join(s, on="scenario_id", how="inner")
                .withColumn("voix_estimees", F.floor(expressed * F.col("pct") / 100).cast("long"))
                .drop("votants"))


def confidence_band(pred: DataFrame) -> DataFrame:
    """The winner and its band (> 35 high, > 25 medium, else close)."""
    w = W.winner(pred, by=["scenario_id"], value="pct")
    p = F.col("pct_gagnant")
    band = (F.when(p > S.CONFIDENCE_HIGH, F.lit("elevee"))
             .when(p > S.CONFIDENCE_MEDIUM, F.lit("moderee")).otherwise(F.lit("serree")))
    return w.withColumn("confiance", band)


def context_notes(scenarios: DataFrame) -> DataFrame:
    """Context codes per scenario, as a comma-separated text."""
    notes = []
    dept_note = None
    for code, depts in S.NOTE_DEPARTMENTS:
        cond = F.col(S.DEPT).isin(depts)
        dept_note = F.when(cond, F.lit(code)) if dept_note is None else dept_note.when(cond, F.lit(code))
    notes.append(dept_note)
    notes.append(F.when(F.col(S.YEAR) >= S.NOTE_FUTURE_YEAR, F.lit("projection")))
    p = F.col("taux_participation")
    notes.append(F.when(p > S.NOTE_HIGH_PARTICIPATION, F.lit("forte_participation"))
                  .when(p < S.NOTE_LOW_PARTICIPATION, F.lit("faible_participation")))
    arr = F.filter(F.array(*notes), lambda x: x.isNotNull())
    return scenarios.select("scenario_id", F.array_join(arr, ",").alias("notes"))


# -- J4 ----------------------------------------------------------------------
def compare_shares(pred: DataFrame, actual: DataFrame, keys: Sequence[str] = ("scenario_id",)) -> DataFrame:
    """Full outer join on (keys, label), missing side -> 0."""
    keys = list(keys)
    p = pred.select(*keys, S.LABEL, F.col("pct").alias("__p"), F.lit(True).alias("has_pred"))
    a = actual.select(*keys, S.LABEL, F.col("pct_reel").alias("__a"), F.lit(True).alias("has_reel"))
    j = p.join(a, on=keys + [S.LABEL], how="full_outer")
    return j.select(*keys, S.LABEL,
                    F.coalesce("__p", F.lit(0.0)).alias("prediction"),
                    F.coalesce("__a", F.lit(0.0)).alias("reel"),
                    F.coalesce("has_pred", F.lit(False)).alias("has_pred"),
                    F.coalesce("has_reel", F.lit(False)).alias("has_reel"))


# -- R13 ---------------------------------------------------------------------
def history_info(history: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Model name, accuracy, history rows, years covered, department count.  The
    metadata's first row gives name, accuracy and years, those that it has a
    column and a value for (an empty name or span counts as none)."""
    info = history.agg(F.count(F.lit(1)).alias("data_points"))

    def known(column: str, kind: str, default):
        if metadata is None or column not in metadata.columns:
            return F.lit(default)
        value = metadata.select(F.col(column).cast(kind)).limit(1).scalar()
        return F.coalesce(F.nullif(value, F.lit("")) if kind == "string" else value, F.lit(default))

    return info.select(
        known("best_model_name", "string", S.DEFAULT_MODEL_NAME).alias("model_name"),
        known("best_score", "double", 0.0).alias("accuracy"),
        "data_points",
        known("years_covered", "string", S.DEFAULT_YEARS_COVERED).alias("years_covered"),
        F.lit(len(S.REGION_DEPARTMENTS)).alias("departments"))


def scenario_grid(history: DataFrame, years: Sequence[int], participations: Sequence[float],
                  urban_flags: Sequence[bool] = (True, False), round_: int = 1) -> DataFrame:
    """Scenarios for every department present in the history crossed with the
    given years, participation levels and urban flags (a fixed, small grid per
    department)."""
    grid = [(y, p, u) for y in years for p in participations for u in urban_flags]
    arr = F.array(*[F.struct(F.lit(y).cast("int").alias("y"), F.lit(float(p)).alias("p"),
                             F.lit(u).alias("u")) for y, p, u in grid])
    depts = summarise_history(history).select(S.DEPT).distinct()
    g = depts.select(S.DEPT, F.explode(arr).alias("g"))
    # tenths of a percent below 100 in three digits, any other level in nine
    tenths = all(0 <= p < 100 and abs(p * 10 - round(p * 10)) < 1e-9 for p in participations)
    scale, width = (10, 1000) if tenths else (10 ** 6, 10 ** 9)
    if len({(y, round(p * scale), bool(u)) for y, p, u in grid}) < len(grid):
        raise ValueError("two scenarios of the grid have the same year, participation and urban flag")
    sid = ((F.col("g.y").cast("long") * 1000 + F.col(S.DEPT)) * width
           + F.rint(F.col("g.p") * scale).cast("long")) * 10 + F.col("g.u").cast("long")
    out = g.select(sid.alias("scenario_id"), F.col("g.y").alias(S.YEAR), S.DEPT,
                   F.lit(round_).cast("int").alias(S.ROUND),
                   F.lit(None).cast("long").alias("inscrits"),
                   F.col("g.p").alias("taux_participation"), F.col("g.u").alias("is_urbain"))
    return prepare_scenarios(out)


"""Aggregations.

Grouped aggregates with map-side partial aggregation, so a key holding a
large share of the rows is combined inside each task before the shuffle.
Window functions only ever run over already-aggregated rows; quantiles are
exact, found by narrowing brackets (``quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.functions import exprs as X
from scrutin.operators import clean
from scrutin.operators.gram import correlations, pair_sums
from scrutin.operators.quantiles import quantile_columns
from scrutin.session import settled


#: The most rows that a top-k table may have to be broadcast.
MAX_BROADCAST_ROWS = 10_000


# -- A1 / A2 / A11 ----------------------------------------------------------------
def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, count descending then value; nulls excluded; optional top n."""
    out = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col(column).asc()))
    return out.limit(n) if n else out


def counts_by_year(df: DataFrame) -> DataFrame:
    return (df.where(F.col(S.YEAR).isNotNull()).groupBy(S.YEAR)
              .agg(F.count(F.lit(1)).alias("n")).orderBy(S.YEAR))


def records_per_department(df: DataFrame) -> DataFrame:
    return df.groupBy(S.DEPT).agg(F.count(F.lit(1)).alias("n")).orderBy(S.DEPT)


# -- A3 / A4 / A5 / A6 ----------------------------------------------------------------
def mean_participation(df: DataFrame, column: str = "taux_participation") -> DataFrame:
    return df.agg(F.avg(column).alias("mean_participation"))


def former_region_split(df: DataFrame) -> DataFrame:
    flag = F.col("ancien_midi_pyrenees")
    return df.agg(F.count_if(flag).alias("ancien_midi_pyrenees"),
                  (F.count(F.lit(1)) - F.count_if(flag)).alias("ancien_languedoc_roussillon"))


def dashboard_metrics(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows; distinct years, departments, labels, families; year span."""
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    cols = [F.count(F.lit(1)).alias("total_records")]
    for c, name in ((S.YEAR, "n_years"), (S.DEPT, "n_departements"), (S.LABEL, "n_nuances"),
                    ("famille_politique", "n_familles")):
        if c in df.columns:
            cols.append(distinct(c).alias(name))
    if S.YEAR in df.columns:
        cols += [F.min(S.YEAR).alias("first_year"), F.max(S.YEAR).alias("last_year")]
    return df.agg(*cols)


def summary_stats(df: DataFrame) -> DataFrame:
    """Total, sorted distinct years/rounds/departments (as text lists), label
    count, vote sum, mean participation.

    The distinct key sets are bounded by the calendar and the region, so the
    one-row result stays small at any input size.
    """
    def sorted_list(c: str) -> F.Column:
        return F.array_join(F.array_sort(F.collect_set(F.col(c))), ",")

    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        sorted_list(S.YEAR).alias("years"),
        sorted_list(S.ROUND).alias("tours"),
        sorted_list(S.DEPT).alias("departments"),
        F.count_distinct(S.LABEL).alias("nuances"),
        F.sum(S.VOTES).alias("total_voix"),
        F.avg("taux_participation").alias("avg_participation"),
    )


# -- A7 ----------------------------------------------------------------------
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """pandas-style describe in long form ``(column, stat, value)``.

    Exact quantiles by default (linear interpolation, as pandas), computed
    first (see ``quantiles``); one aggregate computes the other statistics.
    """
    columns = list(columns) if columns is not None else clean.columns_of_kind(df)
    if not columns:
        raise ValueError("no numeric column to describe")
    df = settled(df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)]))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs += [F.count(x).cast("double").alias(f"s{i}_0"), F.avg(x).alias(f"s{i}_1"),
                 F.stddev_samp(x).alias(f"s{i}_2"), F.min(x).alias(f"s{i}_3"), F.max(x).alias(f"s{i}_7")]
    q = quantile_columns(df, columns, [0.25, 0.5, 0.75], approx)
    wide = df.agg(*aggs).withColumns({f"s{i}_{4 + k}": q[c, k] for i, c in enumerate(columns) for k in range(3)})
    pairs = ", ".join(f"'{c}', '{s}', s{i}_{j}" for i, c in enumerate(columns)
                      for j, s in enumerate(DESCRIBE_STATS))
    n = len(columns) * len(DESCRIBE_STATS)
    return wide.selectExpr(f"stack({n}, {pairs}) as (`column`, stat, value)")


# -- A8 / A9 / A10 ------------------------------------------------------------------
def by_department(df: DataFrame, share: str = "pct_exprimes") -> DataFrame:
    """Mean participation, mean share, summed votes and registered, plus name."""
    out = df.groupBy(S.DEPT).agg(
        F.avg("taux_participation").alias("taux_participation"),
        F.avg(share).alias("part_voix"),
        F.sum(S.VOTES).alias("voix"),
        F.sum("inscrits").alias("inscrits"))
    return out.withColumn("nom_departement", X.department_name(S.DEPT))


def by_year(df: DataFrame) -> DataFrame:
    return df.groupBy(S.YEAR).agg(
        F.avg("taux_participation").alias("taux_participation"),
        F.sum(S.VOTES).alias("voix"),
        F.sum("inscrits").alias("inscrits"),
        F.sum("abstentions").alias("abstentions"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (count desc, value asc): a bounded table."""
    return value_counts(df, column, k).select(column)


def in_top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is among the k most frequent: a semi join on a table of
    at most k rows, broadcast if k says that it is small."""
    top = top_values(df, column, k)
    return df.join(F.broadcast(top) if k <= MAX_BROADCAST_ROWS else top, on=column, how="left_semi")


def label_evolution(df: DataFrame, k: int = 8, share: str = "pct_exprimes") -> DataFrame:
    """A10: restrict to the k most frequent labels (J5), then per (year, label)
    summed votes and mean share."""
    kept = in_top_values(df, S.LABEL, k)
    return kept.groupBy(S.YEAR, S.LABEL).agg(F.sum(S.VOTES).alias("voix"),
                                             F.avg(share).alias("part_voix"))


# -- A12 / A13 ----------------------------------------------------------------------
def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlations, pairwise complete, long form ``(var1, var2, r)``,
    from one matrix aggregate (``gram``); null where a column is constant."""
    columns = list(columns) if columns is not None else clean.columns_of_kind(df)
    upper = correlations(pair_sums(df, columns))
    names = F.array(*[F.lit(c) for c in columns])
    both = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    pairs = upper.select("r", F.explode(F.array_distinct(both)).alias("p"))
    return pairs.select(names[F.col("p.a")].alias("var1"), names[F.col("p.b")].alias("var2"), "r")


def top_correlations(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Upper-triangle pairs by |r| descending (then column order), top k."""
    columns = list(columns) if columns is not None else clean.columns_of_kind(df)
    pos = {c: i for i, c in enumerate(columns)}
    long = correlation_matrix(df, columns)
    idx = X.lookup("var1", pos, -1)
    jdx = X.lookup("var2", pos, -1)
    upper = long.where(jdx > idx).withColumn("__i", idx).withColumn("__j", jdx)
    # |r| compared at 1e-10 so that pairs equal up to rounding noise fall
    # back to column order.
    strength = F.rint(F.abs("r") * 1e10)
    return (upper.orderBy(strength.desc_nulls_last(), "__i", "__j").limit(k)
                 .select("var1", "var2", F.col("r").alias("correlation")))


# -- A14 ---------------------------------------------------------------------
def histogram(df: DataFrame, column: str, bins: int | None = 20) -> DataFrame:
    """Counts per equal-width bin over [min, max]; the max falls in the last bin.

    ``bins=None`` picks the count automatically with Sturges' rule,
    ceil(log2(n)) + 1 over the non-null values.  min, max (and n) are scalar
    subqueries (one merged aggregate), so the binning is a plain projection
    followed by a partial aggregate.
    """
    x = F.col(column).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    k = (F.lit(bins) if bins is not None
         else F.greatest(F.ceil(F.log2(df.agg(F.count(x)).scalar())) + 1, F.lit(1)))
    width = (hi - lo) / k
    raw = F.when(width > 0, F.floor((x - lo) / width)).otherwise(F.lit(0))
    b = F.least(raw, k - 1).cast("int")
    out = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_end"), "n")


# -- A15 / A16 / A17 / A18 -------------------------------------------------------------
def actual_shares(df: DataFrame, keys: Sequence[str] = S.CONTEST_KEYS) -> DataFrame:
    """Per contest and label: votes / contest total x 100 (0 if total is 0)."""
    keys = list(keys)
    per_label = df.groupBy(*keys, S.LABEL).agg(F.sum(S.VOTES).alias("__v"))
    total = F.sum("__v").over(Window.partitionBy(*keys))
    return per_label.select(*keys, S.LABEL, F.when(total > 0, F.col("__v") / total * 100)
                            .otherwise(F.lit(0.0)).alias("pct_reel"))


def label_shares_by_year(df: DataFrame, by: Sequence[str] = (S.DEPT,)) -> DataFrame:
    """Per (by..., year, label) the share of the year's votes; years whose
    total is 0 are dropped.  Both rounds are pooled (Q5)."""
    by = list(by)
    per_label = df.groupBy(*by, S.YEAR, S.LABEL).agg(F.sum(S.VOTES).alias("voix"))
    total = F.sum("voix").over(Window.partitionBy(*by, S.YEAR))
    return (per_label.withColumn("__total", total).where(F.col("__total") > 0)
                     .select(*by, S.YEAR, S.LABEL, (F.col("voix") / F.col("__total") * 100).alias("pct")))


def historical_trends(df: DataFrame, reference_year: str = "latest",
                      since: int = S.RECENT_YEAR) -> DataFrame:
    """Per department and label, mean share over the years where the label
    is present (Q4), the reference-year share (Q3), and the election count.

    F8 chooses the window on the rows first (a department with any row from
    ``since`` on keeps only those rows, even when their votes sum to 0), then
    A16 computes the shares.  On a history summary (one row per department,
    year and label) both steps run on rows bounded by the key space.
    """
    if reference_year not in ("latest", "earliest"):
        raise ValueError("reference_year is 'latest' or 'earliest'")
    keys = [S.DEPT]
    # pre-aggregate (partial, map-side) so F8's flag join and the shares run
    # on one row per (department, year, label), never on the ballots
    pre = df.groupBy(*keys, S.YEAR, S.LABEL).agg(F.sum(S.VOTES).alias(S.VOTES))
    shares = label_shares_by_year(clean.recent_or_all(pre, since, keys, bounded=True), by=keys)
    pick = F.max_by if reference_year == "latest" else F.min_by
    return shares.groupBy(*keys, S.LABEL).agg(
        F.avg("pct").alias("avg_pct"),
        pick("pct", F.col(S.YEAR)).alias("ref_pct"),
        F.count(F.lit(1)).alias("n_elections"))


def regional_trends(df: DataFrame, regions: Sequence[int] = S.REGION_DEPARTMENTS) -> DataFrame:
    """Shares per year over the whole region, averaged per label."""
    shares = label_shares_by_year(clean.in_region(df, regions), by=[])
    return shares.groupBy(S.LABEL).agg(F.avg("pct").alias("avg_pct"), F.count(F.lit(1)).alias("n_elections"))


def shares_over_years(df: DataFrame, by: Sequence[str] = (S.DEPT,)) -> DataFrame:
    """A16 with a label's years in one row: (by..., label, ``years``: the structs
    (year, pct) in order of years).  As long as the calendar, whatever the rows."""
    by = list(by)
    return label_shares_by_year(df, by).groupBy(*by, S.LABEL).agg(
        F.array_sort(F.collect_list(F.struct(F.col(S.YEAR).alias("y"), F.col("pct").alias("pct")))).alias("years"))


# -- A19 / A20 / A21 ------------------------------------------------------------------
def distinct_labels(df: DataFrame, column: str = S.LABEL, sort: bool = True) -> DataFrame:
    """Non-null, non-blank labels, sorted (``sort=False`` for internal
    use, where the order does not matter and a global sort would only add a
    sampling job and a shuffle)."""
    c = F.col(column)
    out = df.select(c).where(c.isNotNull() & (X.strip(c) != "")).distinct()
    return out.orderBy(column) if sort else out


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Common column names, in the left table's order."""
    right = set(b.columns)
    return [c for c in a.columns if c in right]


def common_numeric(a: DataFrame, b: DataFrame) -> list[str]:
    """The common columns that are numeric on both sides."""
    numeric = set(clean.columns_of_kind(a)) & set(clean.columns_of_kind(b))
    return [c for c in common_columns(a, b) if c in numeric]


def compare_tables(left: DataFrame, right: DataFrame, approx: bool = False) -> DataFrame:
    """Describe of both sides for their common numeric columns, as
    ``(column, stat, left, right)``."""
    common = common_numeric(left, right)
    a = describe(left, common, approx).withColumnRenamed("value", "left")
    b = describe(right, common, approx).withColumnRenamed("value", "right")
    return a.join(b, on=["column", "stat"], how="full_outer")


def compare_histograms(left: DataFrame, right: DataFrame, bins: int = 20) -> DataFrame:
    """A20, second part: histogram of the first common numeric column on each
    side, as ``(side, column, bin, bin_start, bin_end, n)``."""
    common = common_numeric(left, right)
    if not common:
        raise ValueError("no common numeric column")
    c = common[0]
    parts = [histogram(df, c, bins).select(F.lit(side).alias("side"), F.lit(c).alias("column"), "*")
             for side, df in (("left", left), ("right", right))]
    return parts[0].unionByName(parts[1])


def scatter_points(df: DataFrame, share: str = "pct_exprimes", fraction: float | None = None,
                   seed: int = 42) -> DataFrame:
    out = df.select("taux_participation", F.col(share).alias("part_voix"), S.DEPT, S.VOTES, S.LABEL)
    return out.sample(fraction=fraction, seed=seed) if fraction else out

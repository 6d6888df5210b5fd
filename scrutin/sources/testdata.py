"""Election tables derived from the benchmark tables.

The benchmark ships order-entry tables only, so ``ballots`` and ``socio`` are
plain projections of ``lineitem JOIN orders JOIN customer`` (and of
``customer``): their size grows with the input and every query that starts
here scans the whole tables.  The projection is fixed so that the DuckDB
oracle can rebuild the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES -- code and label tables indexed by key arithmetic.
DEPARTMENT_CODES = [9, 11, 12, 30, 31, 32, 34, 46, 48, 65, 66, 81, 82, 75, 13]
LABEL_CODES = ["RN", "LR", "ENS", "NUP", "SOC", "ECO", "DVD", "FN", "LREM", "UDI",
               "PS", "EELV", "LFI", "REM", " dvg ", ""]
YEAR_OFFSET = 17          # order years 1995..2001 become 2012..2018
BAD_CODE_MODULUS = 97     # every 97th part key gets an unparsable department

# Columns that identify a ballot row (unique together at every scale).
TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, index) -> F.Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*TIEBREAK)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # both sides grow with the data: a shuffle join at every size, which also
    # spreads files of few row groups over the tasks
    return (li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey)
              .join(cu, od.o_custkey == cu.c_custkey))


def ballots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed ballots: one row per line item; departments 75 and 13 are outside
    the region and round 0 is invalid on purpose."""
    j = _joined(spark, sf_dir)
    inscrits = F.floor(F.col("o_totalprice") / 10)
    votants = F.floor(inscrits * (F.lit(40) + F.col("l_orderkey") % 50) / 100)
    return j.select(
        *TIEBREAK,
        (F.year("o_orderdate") + YEAR_OFFSET).cast("int").alias("annee"),
        (F.col("l_linenumber") % 3).cast("int").alias("tour"),
        _pick(DEPARTMENT_CODES, F.col("c_nationkey") % 15).alias("departement"),
        _pick(LABEL_CODES, F.col("l_partkey") % 16).alias("nuance"),
        inscrits.cast("long").alias("inscrits"),
        votants.cast("long").alias("votants"),
        (inscrits - votants).cast("long").alias("abstentions"),
        (votants - F.floor(votants * 2 / 100)).cast("long").alias("exprimes"),
        F.floor(F.col("l_extendedprice") / 100).cast("long").alias("voix"),
    )


def ballots_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as text, as read from a CSV export or a loose database
    table: capitalised headings, zero-padded department codes, and ``n/a``
    where the code is unreadable."""
    b = ballots(spark, sf_dir)
    dept = F.when(F.col("l_partkey") % BAD_CODE_MODULUS == 0, F.lit("n/a")).otherwise(
        F.lpad(F.col("departement").cast("string"), 2, "0"))
    return b.select(
        *TIEBREAK,
        F.col("annee").cast("string").alias("Année"),
        F.col("tour").cast("string").alias("TOUR"),
        dept.alias("Departement"),
        F.col("nuance").alias("Nuance"),
        F.col("inscrits").cast("string").alias("INSCRITS"),
        F.col("votants").cast("string").alias("Votants"),
        F.col("abstentions").cast("string").alias("abstentions"),
        F.col("exprimes").cast("string").alias("EXPRIMES"),
        F.col("voix").cast("string").alias("Voix"),
    )


def socio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One socio-economic row per customer ("commune")."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    k = F.col("c_custkey")

    def indicator(mult: int, modulus: int, base: float) -> F.Column:
        return F.lit(base) + (k * mult % modulus).cast("double") / 100

    return cu.select(
        _pick(DEPARTMENT_CODES, F.col("c_nationkey") % 15).alias("DEP"),
        k.cast("string").alias("COM"),
        F.col("c_name").alias("LIBCOM"),
        indicator(7, 1700, 8.0).alias("taux_pauvrete"),
        (F.lit(18000.0) + (k * 13 % 17000).cast("double")).alias("revenu_median"),
        indicator(3, 1000, 5.0).alias("taux_chomage"),
        indicator(5, 1700, 8.0).alias("part_cadres"),
        indicator(11, 2000, 15.0).alias("part_ouvriers"),
        indicator(17, 1500, 35.0).alias("age_moyen"),
        (F.lit(20.0) + (k * 11 % 180).cast("double")).alias("densite_population"),
        (F.lit(2012) + (k % 2) * 5).cast("int").alias("annee"),
    )

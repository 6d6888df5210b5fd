"""Operator 7: url filter by empirical-Bayes host reputation.

A page's outcome is 1 (bad) or 0: that of the longest rule that fits its url,
else whether its markup is full of junk marks (JUNK_AT marks per space and
more); a page with neither rule nor markup has none.  Outcomes are summed by
host.  The bad rate of a suffix is shrunk to that of all pages, a registered
domain's to its suffix, a host's to its domain; the weight of each prior is
fitted to the spread of the rates at that level (method of moments).  A host is
blocked where the lower bound of its beta posterior (its ALPHA quantile) is at
least BLOCK_AT: where the posterior has no more than ALPHA below it.

DataFrame functions only; hosts are summed before anything is joined.
Defined cases: a null url and one without ``://`` have empty host and path and
the reputation of the empty host; the rule is null where none fits; longest
rules win, ties by text; a table without outcomes allows all; repeated rows
are kept; columns beside page_id, url and html are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm.common import stored

# FIXED VALUES: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# FIXED VALUES: public suffixes of two labels
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")

JUNK = r"###|%%%|[*]{3}|[$]{3}|(?:&amp;){3}"
JUNK_AT = 0.2
BLOCK_AT = 0.5
#: The posterior's quantile that has to reach BLOCK_AT.
ALPHA = 0.05
#: Turns of the continued fraction, enough for 100,000 outcomes of a host; beyond that only rates within 0.002 of BLOCK_AT are open.
TURNS = 300
TRACE = 1e-6
#: Bounds of a prior's weight, in pages.
WEIGHT = (2.0, 1000.0)


def parts() -> tuple[Column, Column]:
    """Host and path of the column url."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or null; a short list of rules."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _weight(prior: Column) -> Column:
    """The weight of a prior from the spread of group rates around it:
    between-group variance is what the binomial variance leaves over."""
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - prior, 2)) / F.sum("n")
    noise = F.sum(prior * (1 - prior)) / F.sum("n")
    mean = F.sum(F.col("n") * prior * (1 - prior)) / F.sum("n")
    between = F.greatest(spread - noise, F.lit(1e-6))
    return F.least(F.greatest(mean / between - 1, F.lit(WEIGHT[0])), F.lit(WEIGHT[1]))


def _log_gamma(x: Column) -> Column:
    """Stirling's series eight places up, where it is exact to about 2e-12."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    for i in range(8):
        series = series - F.log(x + i)
    return series


def beta_below(a: Column, b: Column, at: float) -> Column:
    """The probability of a beta distribution below ``at``: the continued fraction of
    the incomplete beta function, on the side where it converges fast."""
    low = F.lit(at) < (a + 1) / (a + b + 2)
    p, q, x = F.when(low, a).otherwise(b), F.when(low, b).otherwise(a), F.when(low, F.lit(at)).otherwise(F.lit(1 - at))
    tiny = 1e-300
    whole = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def turn(state: Column, term: Column) -> Column:
        d = 1 / whole(1 + term * state["d"])
        c = whole(1 + term / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    def step(state: Column, m: Column) -> Column:
        even = turn(state, m * (q - m) * x / ((p + 2 * m - 1) * (p + 2 * m)))
        return turn(even, -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 2 * m + 1)))

    d = 1 / whole(1 - (p + q) * x / (p + 1))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    turns = F.array(*[F.lit(float(m)) for m in range(1, TURNS + 1)])
    fraction = F.aggregate(turns, start, step)["h"]
    front = F.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * F.log(x) + q * F.log(1 - x)) / p
    return F.when(low, front * fraction).otherwise(1 - front * fraction)


def reputations(pages: DataFrame) -> DataFrame:
    """host, n, bad, posterior mean of every host and the posterior's probability
    below BLOCK_AT, from rows (host, bad).  A port is no part of a domain or suffix."""
    hosts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    name = F.regexp_replace("host", ":[0-9]*$", "")
    last2 = F.substring_index(name, ".", -2)
    hosts = hosts.withColumn("domain", F.when(last2.isin(*LONG_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(last2))
    hosts = stored(hosts.withColumn("suffix", F.when(last2.isin(*LONG_SUFFIXES), last2).otherwise(F.substring_index(name, ".", -1))), "hosts")
    total = hosts.agg(F.coalesce(F.sum("bad") / F.greatest(F.sum("n"), F.lit(1)), F.lit(0.0)).alias("rate"))
    levels = {"suffix": ["suffix"], "domain": ["domain", "suffix"]}
    prior = F.lit(float(total.first()[0] or 0.0))
    above: DataFrame | None = None
    for level, keys in levels.items():
        rows = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        rows = rows.withColumn("prior", prior) if above is None else rows.join(above, "suffix")
        rows = stored(rows, level)
        weight = rows.where("n > 0").agg(F.coalesce(_weight(F.col("prior")), F.lit(WEIGHT[1]))).first()[0]
        rate = (F.col("bad") + float(weight) * F.col("prior")) / (F.col("n") + float(weight))
        above = rows.select(level, rate.alias("prior"))
    rows = stored(hosts.select("host", "domain", "n", "bad").join(above, "domain"), "priors")
    weight = float(rows.where("n > 0").agg(F.coalesce(_weight(F.col("prior")), F.lit(WEIGHT[1]))).first()[0])
    mean = (F.col("bad") + weight * F.col("prior")) / (F.col("n") + weight)
    rows = rows.withColumn("mean", mean)
    # a prior of no or only bad outcomes leaves a trace of the other
    a, b = F.greatest(F.col("mean"), F.lit(TRACE)) * (F.col("n") + weight), F.greatest(1 - F.col("mean"), F.lit(TRACE)) * (F.col("n") + weight)
    return rows.select("host", "n", "bad", "mean", beta_below(a, b, BLOCK_AT).alias("below"))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's posterior, of every page."""
    host, path = parts()
    spaces = F.length("html") - F.length(F.replace("html", F.lit(" "), F.lit("")))
    junk = (F.size(F.split("html", JUNK, -1)) - 1) / F.greatest(spaces, F.lit(1))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).select(
        "page_id", host.alias("host"), path.alias("path"), (junk >= JUNK_AT).cast("int").alias("junk"))
    rule, given = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), given.alias("given"))
    rows = stored(rows.select("page_id", "host", "path", "rule", "given",
                              F.when(F.col("given") == "block", 1).when(F.col("given") == "allow", 0).otherwise(F.col("junk")).alias("bad")), "pages")
    known = stored(reputations(rows), "reputations").select(F.col("host").alias("r_host"), "mean", "below")
    return (rows.join(known, F.col("host") == F.col("r_host"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("given", F.when(F.col("below") <= ALPHA, "block").otherwise("allow")).alias("verdict"),
                    F.round("mean", 6).alias("bad_rate")))


_CASE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{i}}}" for i, (h, p, _) in sorted(
        enumerate(RULES), key=lambda r: (-len(r[1][0] + r[1][1]), r[1][0]))) + " END"
_LONG = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)


def _sql_weight(source: str) -> str:
    return (f"(SELECT coalesce(least(greatest(sum(n * prior * (1 - prior)) / sum(n) / greatest(sum(n * pow(bad / n - prior, 2)) / sum(n) "
            f"- sum(prior * (1 - prior)) / sum(n), 1e-6) - 1, {WEIGHT[0]}), {WEIGHT[1]}), {WEIGHT[1]}) FROM {source} WHERE n > 0)")


#: The integral of the unscaled posterior over the log odds, from {0} to {1}, 4,000 steps; the peak is taken out.
_LOG = "(a * x - (a + b) * ln(1 + exp(least(x, 700))))"
_PEAK = "(a * ln(a / (a + b)) + b * ln(b / (a + b)))"
_SIMPSON = ("list_sum(list_transform(range(0, 4001), lambda i: CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
            " * exp(" + _LOG.replace("x", "({0} + ({1} - {0}) * i / 4000.0)").replace("e({0} + ({1} - {0}) * i / 4000.0)p", "exp") + " - " + _PEAK + "))) * ({1} - {0})")

ORACLE = rf"""
WITH u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT page_id, host, path, {_CASE.format(*[f"'{h}{p}'" for h, p, _ in RULES])} AS rule, {_CASE.format(*[f"'{v}'" for _, _, v in RULES])} AS given,
             CAST(len(regexp_extract_all(html, '{JUNK}')) / greatest(len(html) - len(replace(html, ' ', '')), 1) >= {JUNK_AT} AS INT) AS junk FROM h),
p AS (SELECT *, CASE WHEN given = 'block' THEN 1 WHEN given = 'allow' THEN 0 ELSE junk END AS bad FROM r),
s AS (SELECT host, array_to_string(string_split(name, '.')[-2:], '.') AS l2, array_to_string(string_split(name, '.')[-3:], '.') AS l3, string_split(name, '.')[-1] AS l1,
             count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS name FROM p) GROUP BY ALL),
g AS (SELECT host, n, bad, CASE WHEN l2 IN ({_LONG}) THEN l3 ELSE l2 END AS domain,
             CASE WHEN l2 IN ({_LONG}) THEN l2 ELSE l1 END AS suffix FROM s),
x AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT coalesce(sum(bad) / greatest(sum(n), 1), 0) FROM g) AS prior FROM g GROUP BY suffix),
xr AS (SELECT suffix, (bad + w * prior) / (n + w) AS prior FROM x, (SELECT {_sql_weight("x")} AS w)),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(xr.prior) AS prior FROM g JOIN xr USING (suffix) GROUP BY ALL),
dr AS (SELECT domain, (bad + w * prior) / (n + w) AS prior FROM d, (SELECT {_sql_weight("d")} AS w)),
hp AS (SELECT host, n, bad, prior FROM g JOIN dr USING (domain)),
hr AS (SELECT host, n + w AS m, (bad + w * prior) / (n + w) AS mean FROM hp, (SELECT {_sql_weight("hp")} AS w)),
ab AS (SELECT host, mean, greatest(mean, {TRACE}) * m AS a, greatest(1 - mean, {TRACE}) * m AS b FROM hr),
-- the posterior below BLOCK_AT, by Simpson's rule on the log scale of the odds
grid AS (SELECT host, mean, a, b, ln({BLOCK_AT} / (1 - {BLOCK_AT})) AS cut FROM ab),
mass AS (SELECT host, mean, {_SIMPSON.format("(-60.0)", "cut")} AS under, {_SIMPSON.format("cut", "60.0")} AS over FROM grid),
bs AS (SELECT host, mean, under / (under + over) AS below FROM mass)
SELECT page_id, p.host, path, rule, coalesce(given, CASE WHEN below <= {ALPHA} THEN 'block' ELSE 'allow' END) AS verdict,
       round(mean, 6) AS bad_rate
FROM p LEFT JOIN bs ON bs.host = p.host
"""

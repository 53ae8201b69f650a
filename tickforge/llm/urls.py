"""URL filters: allow and block rules, and empirical-Bayes host reputation for what no rule judges.

Built-in expressions only. Outcomes are counted per host before anything is shuffled, so that a host with a third of
all pages costs a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, fold_case

#: The rules of the production list, and suffixes of two labels under which domains are registered.
RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
)
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "org.au", "org.uk")
#: Up to so many rules are a chain of conditions, read with each row; longer lists are joined by the hosts that they name.
CHAIN = 100
Z, THRESHOLD, STRENGTHS = 1.645, 0.5, (1.0, 1000.0)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path of a url; both empty for null or without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = fold_case(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, F.when(F.startswith(path, F.lit("/")), path).otherwise("")


def match_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does. Of equally long ones the first in text order."""
    name = verdict = F.lit(None).cast("string")
    for rule, kind in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(f"/{rest}"))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def join_rules(base: DataFrame, rules) -> DataFrame:
    """``base`` (host, path, ...) with _rule and _said, as ``match_rule`` gives them, from a list of any length.

    Rules are joined with the parents of distinct hosts; a page then looks through those of its host, the longest first.
    """
    spark = base.sparkSession
    rows = [(*r.partition("/")[::2], r, kind) for r, kind in rules]
    table = spark.createDataFrame(rows, "_at string, _path string, _name string, _kind string")
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    hosts = base.select("host").distinct().select("host", F.explode(parents).alias("_at")).join(table, "_at")
    order = F.struct((-F.length("_name")).alias("n"), F.col("_name").alias("name"), F.col("_path").alias("path"), F.col("_kind").alias("kind"))
    fits = hosts.groupBy(F.col("host").alias("_host")).agg(F.sort_array(F.collect_list(order)).alias("_rules"))  # at most the rules given
    out = base.join(fits, F.col("host") == F.col("_host"), "left")
    first = F.get(F.filter("_rules", lambda r: F.startswith(F.col("path"), F.concat(F.lit("/"), r.path))), F.lit(0))
    return out.withColumns({"_rule": first.getField("name"), "_said": first.getField("kind")}).drop("_rules", "_host")


def domain_parts(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host."""
    n = F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    parts = F.split(host, r"\.")
    tail = lambda k: F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - k + 1), k), ".")
    return tail(n + 1), tail(n)


def _strength(level: DataFrame) -> float:
    """Pseudo-count of the beta prior over the units of a level, by moments of their rates; one row comes to the driver."""
    total = level.agg(F.sum("n").alias("N"), F.sum("good").alias("g"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("r")).first()
    lo, hi = STRENGTHS
    if not total["N"] or total["k"] < 2:
        return hi
    m = total["g"] / total["N"]
    spread, noise = total["r"] - total["N"] * m * m, m * (1 - m)
    if noise <= 0:
        return hi
    rho = (spread - (total["k"] - 1) * noise) / ((total["N"] - total["nn"] / total["N"] - (total["k"] - 1)) * noise or 1.0)
    return min(hi, max(lo, 1 / rho - 1)) if rho > 0 else hi


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of each host's rate of good pages from ``outcomes`` (host, good boolean), a row per labelled page.

    A host's beta prior has the posterior mean of its registered domain, that one's the mean of its suffix, that one's
    the mean of all; the strengths are fitted by moments at each level. Also gives what unseen hosts need: rows with a
    null host carry a domain's prior, with a null domain a suffix's, with all null the overall one.
    """
    seen = outcomes.filter(F.col("host").isNotNull() & F.col("good").isNotNull())
    hosts = seen.groupBy("host").agg(F.count("*").alias("n"), F.count_if("good").alias("good"))
    domain, suffix = domain_parts(F.col("host"))
    hosts = Scratch(outcomes.sparkSession, "urls").table(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "good"), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (whole["good"] + 1.0) / (whole["n"] + 2.0) if whole["n"] else 0.5
    k1, k2, k3 = _strength(suffixes), _strength(domains), _strength(hosts)
    mean = lambda prior, k: (F.col("good") + k * prior) / (F.col("n") + k)
    s = suffixes.select("suffix", mean(F.lit(overall), k1).alias("m1"))
    d = domains.join(s, "suffix").select("domain", "suffix", mean(F.col("m1"), k2).alias("m2"))
    h = hosts.join(d.select("domain", "m2"), "domain").select("host", "domain", "suffix", (F.col("good") + k3 * F.col("m2")).alias("a"), (F.col("n") - F.col("good") + k3 * (1 - F.col("m2"))).alias("b"))
    none = F.lit(None).cast("string")
    prior = lambda df, m, k, *keys: df.select(none.alias("host"), *keys, (k * m).alias("a"), (k * (1 - m)).alias("b"))
    spark = outcomes.sparkSession
    return h.unionByName(prior(d, F.col("m2"), k3, "domain", "suffix")).unionByName(prior(s, F.col("m1"), k2, none.alias("domain"), "suffix")).unionByName(prior(spark.range(1), F.lit(overall), k1, none.alias("domain"), none.alias("suffix")))


def bound_sql(a: str, b: str, z: float = Z) -> str:
    """SQL for the quantile of a beta distribution that the standard normal has at -z (for z = 1.645, of 0.05).

    The normal approximation of Abramowitz and Stegun, 26.5.22; where a or b are too small for it, mean and deviation.
    """
    y, p, q = (z * z - 3) / 6, f"(2 * {a} - 1)", f"(2 * {b} - 1)"
    h = f"(2 / (1 / {p} + 1 / {q}))"
    w = f"({z}D * sqrt({h} + {y}D) / {h} - (1 / {q} - 1 / {p}) * ({y + 5 / 6}D - 2 / (3 * {h})))"
    mean = f"greatest(0D, {a} / ({a} + {b}) - {z}D * sqrt({a} * {b} / (({a} + {b}) * ({a} + {b}) * ({a} + {b} + 1))))"
    return f"CASE WHEN {a} >= 1 AND {b} >= 1 THEN {a} / ({a} + {b} * exp(2 * {w})) ELSE {mean} END"


def lower_bound(a: str, b: str, z: float = Z) -> Column:
    """Lower bound of a beta posterior; ``a`` and ``b`` are columns."""
    return F.expr(bound_sql(a, b, z))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """Judge every url: page_id, host, path, rule, verdict (allow or block), bound (of the host's rate of good pages).

    ``outcomes`` has a row per labelled page: host, good. Where no rule fits, a page is allowed if the lower posterior
    bound of its host, or else of its domain, suffix or all hosts, is at least ``threshold``.

    Null or malformed urls: empty host and path, judged by the overall prior. Null ids and repeated rows pass through,
    a row each; very long urls are read whole. No outcomes: every host has the uniform prior's mean. Other columns, whatever
    their names, are ignored. Empty table: no rows.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    host, path = url_parts(F.col("_url"))
    base = base.select("page_id", host.alias("host"), path.alias("path"))
    domain, suffix = domain_parts(F.col("host"))
    if len(rules) <= CHAIN:
        rule, said = match_rule(F.col("host"), F.col("path"), rules)
    else:
        base = join_rules(base, rules)
        rule, said = F.col("_rule"), F.col("_said")
    rep = host_reputation(outcomes)
    bound = lower_bound("a", "b", z)
    # what each distinct host gets: its own posterior, else the nearest prior above it
    hosts = base.filter(rule.isNull()).select("host").distinct().select("host", domain.alias("domain"), suffix.alias("suffix"))
    own = rep.filter("host IS NOT NULL").select("host", bound.alias("b0"))
    dom = rep.filter("host IS NULL AND domain IS NOT NULL").select("domain", bound.alias("b1"))
    suf = rep.filter("host IS NULL AND domain IS NULL AND suffix IS NOT NULL").select("suffix", bound.alias("b2"))
    last = rep.filter("suffix IS NULL").select(bound.alias("b3")).first()["b3"]
    judged = hosts.join(own, "host", "left").join(dom, "domain", "left").join(suf, "suffix", "left")
    judged = judged.select(F.col("host").alias("_h"), F.coalesce("b0", "b1", "b2", F.lit(last)).alias("bound"))
    out = base.join(judged, F.col("host") == F.col("_h"), "left")
    verdict = F.coalesce(said, F.when(F.coalesce(F.col("bound"), F.lit(last)) >= threshold, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.coalesce(F.col("bound"), F.lit(last)).alias("bound"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host and good of each page whose id is labelled: good quality and not toxic. Repeated labels: any bad one counts."""
    host, _ = url_parts(F.col("url"))
    lab = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min((F.coalesce(F.col("quality"), F.lit(1)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good"))
    return pages.select(F.col("page_id").alias("doc_id"), host.alias("host")).join(lab, "doc_id").select("host", "good")

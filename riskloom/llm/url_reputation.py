"""URL filter: explicit rules first, empirical-Bayes host reputation for the rest.

Labelled page outcomes (1 = bad) are counted per host. A beta prior for every registered domain comes
from its suffix, and one for every host from its registered domain: the prior mean is the parent's
posterior mean, the prior strength is a moment estimate over the children of that level. A host is
blocked when the lower bound of its posterior bad rate lies above ``max_bad``; a host without labels has
its parent's posterior, so it is judged too.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and shares the
reputation of the empty host; null outcomes and outcomes of unknown pages are ignored; repeated rows are
judged (and counted) one by one; with no outcome at all nothing is blocked by reputation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, written


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    """Last two labels (the suffix lists of the registries are not used)."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_fits(rule: str, host: Column, path: Column) -> Column:
    at = rule.index("/")
    name, start = rule[:at].lower(), rule[at:]
    return ((host == name) | host.endswith("." + name)) & path.startswith(start)


def longest_rule(rules: dict[str, str], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, nulls when none fits. ``rules``: rule -> allow / block."""
    rule, verdict = None, None
    for r in sorted(rules, key=lambda r: (-len(r), r)):
        fits = rule_fits(r, host, path)
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, rules[r]) if verdict is None else verdict.when(fits, rules[r])
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _strength(rate_mean: Column, between: Column, n_mean: Column, lo: float, hi: float) -> Column:
    """Prior strength from the spread of the children's rates: m(1-m) = var (strength + 1) after taking
    away the binomial part m(1-m)/n; no spread left means the largest strength."""
    m = rate_mean * (1 - rate_mean)
    var = between - F.try_divide(m, n_mean)
    raw = F.when(var > 0, F.try_divide(m, var) - 1).otherwise(F.lit(hi))
    return F.least(F.greatest(F.coalesce(raw, F.lit(hi)), F.lit(lo)), F.lit(hi))


def _shrink(children: DataFrame, parents: DataFrame, key: str, lo: float, hi: float) -> DataFrame:
    """Posterior mean of every child with the beta prior of its parent (columns ``parent``, ``p_mean``)."""
    seen = F.when(F.col("n") > 0, F.col("bad") / F.col("n"))
    rate, size = F.avg(seen), F.avg(F.when(F.col("n") > 0, F.col("n")).cast("double"))
    spread = children.groupBy("parent").agg(
        F.coalesce(F.var_samp(seen), F.lit(0.0)).alias("_var"), rate.alias("_rate"), size.alias("_size"))
    prior = parents.select(F.col("key").alias("parent"), F.col("mean").alias("p_mean")).join(spread, "parent")
    prior = prior.select("parent", "p_mean", _strength(F.col("_rate"), F.col("_var"), F.col("_size"), lo, hi).alias("p_k"))
    a = F.col("p_mean") * F.col("p_k") + F.col("bad")
    k = F.col("p_k") + F.col("n")
    return children.join(prior, "parent").select(
        key, "parent", "n", "bad", a.alias("alpha"), (k - a).alias("beta"), F.try_divide(a, k).alias("mean"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645, min_strength: float = 2.0,
                    max_strength: float = 1000.0) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): n labelled, bad, posterior alpha / beta / mean, and
    the lower and upper posterior bound (normal approximation at ``z``).

    ``outcomes``: (page_id, bad 0/1). Counts are combined map-side; every later step works on the host
    table. The prior of the suffixes is the overall rate."""
    labelled = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(
        F.count("*").alias("_n"), F.sum("bad").alias("_bad"))
    hosts = (pages.select("page_id", "host").join(labelled, "page_id", "left").groupBy("host")
             .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")))
    hosts = hosts.select(F.col("host").alias("key"), registered_domain(F.col("host")).alias("parent"), "n", "bad")

    def up(level: DataFrame, parent: Column) -> DataFrame:
        return (level.groupBy(F.col("parent").alias("key")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
                .select("key", parent.alias("parent"), "n", "bad"))

    hosts = written(hosts, "hosts")  # one row per host; every level reads it
    domains = up(hosts, suffix(F.col("key")))
    suffixes = up(domains, F.lit("*"))
    bounds = (min_strength, max_strength)
    all_ = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()  # one row
    mean = ((all_["bad"] or 0) + 0.05) / ((all_["n"] or 0) + 1)  # with no outcome at all: 5 percent
    seen = F.when(F.col("n") > 0, F.col("bad") / F.col("n"))
    spread = suffixes.agg(F.coalesce(F.var_samp(seen), F.lit(0.0)).alias("v"), F.avg(seen).alias("m"),
                          F.avg(F.when(F.col("n") > 0, F.col("n"))).alias("n"))
    k = spread.select(_strength(F.col("m"), F.col("v"), F.col("n"), *bounds).alias("k")).first()["k"]  # one row
    s = suffixes.select("key", ((mean * k + F.col("bad")) / (k + F.col("n"))).alias("mean"))
    d = _shrink(domains, s, "key", *bounds)
    h = _shrink(hosts, d, "key", *bounds)
    a, b = F.col("alpha"), F.col("beta")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return h.select(F.col("key").alias("host"), "n", "bad", "alpha", "beta", "mean",
                    F.greatest(F.col("mean") - z * sd, F.lit(0.0)).alias("lower"),
                    F.least(F.col("mean") + z * sd, F.lit(1.0)).alias("upper"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], max_bad: float = 0.15, **kw) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior (n, mean, lower) for every row of ``pages``."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rep = host_reputation(split, outcomes, **kw).select(
        F.col("host").alias("_host"), F.col("n").alias("n_labelled"), "mean", "lower")
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("n_labelled").isNotNull() & (F.col("lower") > max_bad), "block").otherwise("allow")
    return (split.join(rep, F.col("host") == F.col("_host"), "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                    "n_labelled", "mean", "lower"))

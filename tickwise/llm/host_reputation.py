"""URL filter: explicit rules first, then an empirical-Bayes reputation of the page's host.

Labelled pages are good or bad outcomes of their host. Counts are pooled per host, registered domain and
suffix; each level is a beta-binomial whose prior mean is its parent's posterior mean and whose prior strength
comes from the spread seen at that level (method of moments). A host with few labels thus leans on its domain,
one with none on the domain's posterior, and so on up. A host is blocked when even the upper
bound of its posterior share of good pages lies below a floor: hosts that are merely unknown stay.

Everything is grouped counts and equi-joins in SQL functions. Cases: a null url or one without ``://`` has
empty host and path and is judged as that host; labels with a null id or value count nowhere; contradicting
and repeated labels each count; without labels all hosts share an even prior; repeated rows are judged each;
empty tables give an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import written


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Upper bound: so many standard deviations above the posterior mean, and the least good share it must reach.
DEVIATIONS = 1.645
FLOOR = 0.5
#: Suffixes of two labels; others are the last label alone.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br",
                      "co.in", "com.cn", "com.mx", "co.za")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null where none fits."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text = F.when(fits, r.text) if text is None else text.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def registered_domain(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix); a host that is no longer than its suffix is its own domain."""
    two = F.substring_index(host, ".", -2)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)
    return domain, suffix


def _level(own: DataFrame, key: str, parent_mean: str) -> DataFrame:
    """Adds the posterior of each row's counts n, k under a prior around its parent's mean."""
    mu, n, k = F.col(parent_mean), F.col("n"), F.col("k")
    spread = own.agg(
        F.sum((k - n * mu) * (k - n * mu)).alias("s2"), F.sum(n * mu * (1 - mu)).alias("s1"),
        F.sum(n * (n - 1) * mu * (1 - mu)).alias("s3"))
    # Correlation of two outcomes of one group, kept inside a sensible range; strength = 1 / rho - 1.
    rho = F.when(F.col("s3") > 0, (F.col("s2") - F.col("s1")) / F.col("s3")).otherwise(0.05)
    strength = spread.select((1 / F.least(F.greatest(F.coalesce(rho, F.lit(0.05)), F.lit(0.002)), F.lit(0.5)) - 1)
                             .alias("strength"))
    out = own.join(F.broadcast(strength))  # one row
    a = F.col("strength") * mu + k
    b = F.col("strength") * (1 - mu) + n - k
    return out.select(key, a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def reputations(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """Posterior per host. outcomes: (host, good 0/1); hosts: distinct (host, domain, suffix) to be judged."""
    counts = outcomes.groupBy("host").agg(F.count("good").cast("double").alias("n"),
                                          F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"))
    # One row per host, written once: every level reads it and not the pages.
    base = written(hosts.join(counts, "host", "left").fillna(0.0, ["n", "k"]), "hosts")
    total = base.agg(((F.coalesce(F.sum("k"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)).alias("top"))
    by_suffix = base.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(F.broadcast(total))
    suffix = _level(by_suffix, "suffix", "top").select("suffix", F.col("mean").alias("suffix_mean"))
    by_domain = base.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(suffix, "suffix")
    domain = _level(by_domain, "domain", "suffix_mean").select("domain", F.col("mean").alias("domain_mean"))
    return _level(base.join(domain, "domain"), "host", "domain_mean").withColumnRenamed("mean", "reputation")


def upper_bound(a: Column, b: Column, deviations: float = DEVIATIONS) -> Column:
    return a / (a + b) + deviations * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def judge(pages: DataFrame, labels: DataFrame, rules: list[Rule], floor: float = FLOOR) -> DataFrame:
    """page_id, host, path, rule, verdict, reputation, bound per page. labels: (doc_id = page_id, quality, toxic)."""
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    told = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select(
        F.col("doc_id").alias("label_id"), good.cast("int").alias("good"))
    outcomes = split.join(told, split["page_id"] == told["label_id"]).select("host", "good")
    domain, suffix = registered_domain(F.col("host"))
    hosts = split.select("host").distinct().select("host", domain.alias("domain"), suffix.alias("suffix"))
    known = reputations(outcomes, hosts).withColumn("bound", upper_bound(F.col("a"), F.col("b"))).select(
        "host", "reputation", "bound")
    rule, fixed = rule_columns(F.col("host"), F.col("path"), rules)
    return split.join(known, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(fixed, F.when(F.col("bound") >= floor, "allow").otherwise("block")).alias("verdict"),
        "reputation", "bound")

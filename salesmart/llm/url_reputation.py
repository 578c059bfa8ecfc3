"""URL filter: fixed rules, and host reputation by empirical Bayes.

Labelled page outcomes are summed by host.  A host's share of good pages is
shrunk towards its registered domain's, the domain's towards its suffix', and
the suffix' towards that of all pages, through beta-binomial priors whose
strength is estimated from the data.  A host is blocked when even the upper
bound of its posterior lies below the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .text import ascii_lower, packed, unpacked

# Second labels that belong to the suffix, as in co.uk.
SECOND_LABELS = ["ac", "co", "com", "edu", "gov", "net", "org"]
MAX_RULES = 1_000


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and all its subdomains where the path starts with ``path``."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two of such as co.uk, where the last has two letters."""
    two = rf"(?:^|\.)((?:{'|'.join(SECOND_LABELS)})\.[a-z][a-z])$"
    return F.when(F.regexp_extract(host, two, 1) != "", F.regexp_extract(host, two, 1)).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it; the host itself if it has no more labels."""
    before = F.substring(host, F.lit(1), F.char_length(host) - F.char_length(suffix) - 1)
    return F.when(F.char_length(before) > 0, F.concat(F.regexp_extract(before, r"([^.]*)$", 1), F.lit("."), suffix)).otherwise(host)


def number_in(path: Column) -> Column:
    """The number behind the language in paths like ``/en/7817``; null if there is none, or none that fits a long."""
    return F.regexp_extract(path, "^/[a-z]+/([0-9]+)", 1).try_cast("long")


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; they are compiled into one expression")
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name.otherwise(none), verdict.otherwise(none))


def _strength(groups: DataFrame, least: float = 2.0, most: float = 1000.0) -> float:
    """Precision of the beta prior over ``groups`` (n, g), by the moments of the beta-binomial."""
    total = groups.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()
    if not total["n"]:
        return most
    m = total["g"] / total["n"]
    row = groups.where("n > 0").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                                    F.sum(F.col("n") * F.pow(F.col("g") / F.col("n") - F.lit(m), F.lit(2.0))).alias("s")).first()
    v, k = m * (1 - m), row["k"]
    room = v * (total["n"] - row["nn"] / total["n"] - (k - 1))
    rho = (row["s"] - v * (k - 1)) / room if room > 0 else 0.0
    return float(min(most, max(least, 1 / rho - 1))) if rho > 0 else most


def host_reputation(pages: DataFrame, outcomes: DataFrame, threshold: float, z: float) -> DataFrame:
    """``host, n, g, mean, upper, verdict`` for every host of ``pages`` (page, host, suffix, domain).

    ``outcomes`` has ``page, good`` (0 or 1); a null ``page`` has no outcome.
    """
    scored = pages.join(outcomes, "page", "left")
    hosts = stage(scored.groupBy("host", "domain", "suffix").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")), "hosts")
    add = [F.sum("n").alias("n"), F.sum("g").alias("g")]
    domains = stage(hosts.groupBy("domain", "suffix").agg(*add), "domains")
    suffixes = stage(domains.groupBy("suffix").agg(*add), "suffixes")
    total = suffixes.agg(*add).first()
    top = total["g"] / total["n"] if total["n"] else 0.5
    shrunk = lambda prior, k: (F.col("g") + F.lit(k) * prior) / (F.col("n") + F.lit(k))
    by_suffix = suffixes.select("suffix", shrunk(F.lit(top), _strength(suffixes)).alias("m_suffix"))
    by_domain = stage(domains.join(by_suffix, "suffix").select("domain", "suffix", shrunk(F.col("m_suffix"), _strength(domains)).alias("m_domain")), "domain-means")
    k = _strength(hosts)
    a, b = F.lit(k) * F.col("m_domain") + F.col("g"), F.lit(k) * (1 - F.col("m_domain")) + F.col("n") - F.col("g")
    upper = a / (a + b) + z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    judged = hosts.join(by_domain, ["domain", "suffix"]).select("host", "n", "g", (a / (a + b)).alias("mean"), upper.alias("upper"))
    return judged.withColumn("verdict", F.when(F.col("upper") < threshold, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url",
               threshold: float = 0.6, z: float = 1.645, by_path: bool = False) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    ``outcomes`` has ``page, good``, where ``page`` is the page's id or, with
    ``by_path``, the number in its path (pages without one have no outcome); an id with several outcomes counts once, as
    bad if one of them is, and null ids or outcomes not at all.  The longest rule
    that fits decides, else the reputation of the host.  A null URL, or one
    without ``://``, has the empty host, which is judged like any other.  Repeated
    rows are judged alike, and each counts in its host's sums.  Input columns
    named like a result are replaced.

    Scale: html is not read unless the caller asks for it; sums combine on the
    map side; the host table is written, so the join that brings verdicts back
    has a plain shuffle on both sides and a hot host can be split.
    """
    names = pages.columns
    rows = packed(pages, page=F.col(f"`{page_id}`").cast("long"), host=host_of(F.col(f"`{url}`")), path=path_of(F.col(f"`{url}`")))
    known = outcomes.where("page IS NOT NULL AND good IS NOT NULL").groupBy("page").agg(F.min("good").cast("long").alias("good"))
    placed = rows.select((number_in(F.col("path")) if by_path else F.col("page")).alias("page"), "host").withColumn("suffix", suffix_of(F.col("host")))
    placed = placed.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    judged = stage(host_reputation(placed, known, threshold, z).select("host", F.col("verdict").alias("by_host")), "host-verdicts")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    both = rows.join(judged, "host")
    return unpacked(both, names, host=F.col("host"), path=F.col("path"), rule=rule, verdict=F.coalesce(verdict, F.col("by_host")))

"""URL filters: explicit rules, then the reputation of hosts by empirical Bayes.

Labelled pages give each host good and bad outcomes. A host's bad rate is shrunk towards
its registered domain's, that one towards its suffix's, and that one towards the overall
rate: at each level a beta prior around the parent's estimate, as strong as the spread of
rates between siblings calls for (beta-binomial moments). A host is blocked if the lower
bound of its posterior is above the accepted rate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.shared import Scratch, ascii_lower

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A host without user, port and final dots; an address in digits or brackets.
NAME, ADDRESS = r"(?s)^(?:.*@)?(\[[^\]]*\]|[^:]*)", r"(?s)^(?:\[.*|\d{1,3}(?:\.\d{1,3}){3})\z"
#: Suffixes of two labels under which names are registered: a kind of body, then a country. Others have one label.
SUFFIXES = r"(?:ac|co|com|edu|go|gob|gov|gouv|ltd|me|mil|ne|net|nom|or|org|plc|sch)\.[a-z]{2}"


@dataclass(frozen=True)
class UrlRule:
    """`target`: a host and a path that starts with /; it holds for subdomains and longer paths."""

    target: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.target.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without it."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def levels_of(host: Column, suffixes: str = SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address is its own domain and has the empty suffix.

    `suffixes`: a pattern of the suffixes that have several labels.
    """
    name = F.rtrim(F.regexp_extract(host, NAME, 1), F.lit("."))
    suffix = F.regexp_extract(name, rf"(?:^|\.)({suffixes}|[^.]*)\z", 1)
    before = F.substring(name, F.lit(1), F.greatest(F.lit(0), F.length(name) - F.length(suffix) - 1))
    domain = F.when(before == "", name).otherwise(F.concat(F.substring_index(before, ".", -1), F.lit("."), suffix))
    address = name.rlike(ADDRESS)
    return F.when(address, name).otherwise(domain), F.when(address, "").otherwise(suffix)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """(target, verdict) of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.target), r.target))
    found = F.lit(None).cast("struct<target:string,verdict:string>")
    for rule in reversed(ordered):
        given = F.struct(F.lit(rule.target).alias("target"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), given).otherwise(found)
    return found


def _spread(level: DataFrame, weakest: float, strongest: float) -> float:
    """Prior strength of a level: rows n, k, m (labelled pages, bad ones, parent's rate)."""
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    row = level.filter("n > 0").agg(
        F.sum(n * (k / n - m) * (k / n - m) / (m * (1 - m))).alias("q"),
        F.count("*").alias("c"),
        F.sum(n - 1).alias("d"),
    ).first()
    if not row["d"]:
        return strongest
    rho = (row["q"] - row["c"]) / row["d"]
    return min(strongest, max(weakest, 1 / rho - 1)) if rho > 0 else strongest


def reputation(
    pages: DataFrame, labels: DataFrame, scratch: Scratch | None = None, z: float = 1.645,
    weakest: float = 2.0, strongest: float = 1000.0, suffixes: str = SUFFIXES,
) -> DataFrame:
    """(host, pages, n, k, rate, lower, upper): posterior bad rate of every host of `pages`.

    `pages`: page_id, host. `labels`: doc_id, quality, toxic; the document of a page has its
    id. A page is bad if any of its labels says quality 0 or toxic 1; pages whose labels are
    absent or null do not count. `lower` and `upper` are `z` standard deviations from the
    posterior mean. Registered domains and suffixes are those of `levels_of`. Hosts are grouped
    with partial counts, so a large one is no large group.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    bad = F.when(F.expr("quality = 0 OR toxic = 1"), 1).when(F.expr("quality IS NOT NULL OR toxic IS NOT NULL"), 0)
    outcome = labels.select("doc_id", bad.alias("bad")).filter("bad IS NOT NULL").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    hosts = scratch.keep(
        pages.select(F.col("page_id").alias("doc_id"), "host").join(outcome, "doc_id", "left")
        .groupBy("host").agg(F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
        .withColumns(dict(zip(("domain", "suffix"), levels_of(F.col("host"), suffixes))))
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 0.1) / ((total["n"] or 0) + 1)  # without any label: a tenth
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(overall))
    suffixes = scratch.keep(level.select("suffix", _shrunk(_spread(level, weakest, strongest)).alias("m")))
    level = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(suffixes, "suffix")
    domains = scratch.keep(level.select("domain", _shrunk(_spread(level, weakest, strongest)).alias("m")))
    level = hosts.join(domains, "domain")
    strength = _spread(level, weakest, strongest)
    a, b = F.col("k") + strength * F.col("m"), F.col("n") - F.col("k") + strength * (1 - F.col("m"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    rate = a / (a + b)
    return level.select(
        "host", "pages", "n", "k", rate.alias("rate"), (rate - z * deviation).alias("lower"), (rate + z * deviation).alias("upper")
    )


def _shrunk(strength: float) -> Column:
    return (F.col("k") + strength * F.col("m")) / (F.col("n") + strength)


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule] = (), most_bad: float = 0.3,
    scratch: Scratch | None = None, **bounds,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, lower) of every row of `pages` (page_id, url).

    `verdict`: that of the longest fitting rule; else block if the host's bad rate is above
    `most_bad` at the posterior's lower bound, else allow. `rule` is null where none fits.
    Hosts are joined by name; the shuffle holds ids, hosts and paths only, and Spark splits
    the partition of a host with very many pages.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = reputation(parsed, labels, scratch, **bounds).select("host", "lower")
    judged = parsed.join(known, "host", "left").withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("lower") > most_bad, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.target").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "lower",
    )

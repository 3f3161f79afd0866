"""URL filters: rules by host and path, and an empirical-Bayes reputation of hosts.

Labelled outcomes of pages (bad or not) are counted for each host, registered domain and suffix.
Every level is shrunk towards the one above by a beta-binomial prior: the prior mean of a host is
the posterior mean of its domain, that of a domain the posterior mean of its suffix, that of a
suffix the rate of all labelled pages; the prior's strength is estimated for each level from how
much its groups vary beyond chance (method of moments).  A host is blocked when even the lower
posterior bound of its bad rate reaches a threshold; a host never seen is judged by the posterior
of its domain, or of its suffix.

A host's reputation leaves out user and port; an address in digits or brackets is its own domain,
and all addresses share a suffix.  The suffix is the last label, or one of a short list of common
suffixes of two labels; others of that kind (hundreds of public suffixes exist) are taken for
registered domains.

Everything is DataFrame expressions.  Labels are aggregated before they are shuffled, and the
posteriors are joined to pages by host; a host with a third of all pages is a join that adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A host is blocked if its bad rate is this high or higher, with the probability of a normal quantile Z.
THRESHOLD, Z = 0.5, 1.645
#: Bounds of a prior's strength, in pages.
STRENGTH = (2.0, 1000.0)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    has = url.contains("://")
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(""), F.when(has, path).otherwise("")


# Common suffixes of two labels, under which owners register names of their own.
SUFFIXES = """
co.uk org.uk ac.uk gov.uk me.uk ltd.uk plc.uk net.uk sch.uk com.au net.au org.au edu.au gov.au id.au co.nz org.nz net.nz ac.nz govt.nz
co.jp ne.jp or.jp ac.jp go.jp ad.jp co.kr or.kr ac.kr go.kr re.kr com.br net.br org.br gov.br edu.br com.cn net.cn org.cn gov.cn edu.cn ac.cn
com.tw org.tw edu.tw gov.tw com.hk org.hk edu.hk gov.hk com.sg edu.sg gov.sg org.sg com.my edu.my gov.my com.mx org.mx gob.mx edu.mx
com.ar gob.ar edu.ar com.tr org.tr gov.tr edu.tr co.in net.in org.in ac.in gov.in co.za org.za ac.za gov.za co.il org.il ac.il gov.il
com.ua org.ua gov.ua com.pl net.pl org.pl edu.pl co.id or.id ac.id go.id co.th in.th ac.th go.th com.vn edu.vn com.ph gov.ph com.pk edu.pk
com.eg com.sa com.co com.pe com.ve co.at or.at ac.at com.es org.es co.hu com.gr com.ro com.ng co.ke
github.io gitlab.io blogspot.com herokuapp.com netlify.app vercel.app web.app pages.dev
""".split()
_TWO = "|".join(x.replace(".", r"\.") for x in SUFFIXES)
#: Patterns over a name without user and port, for the SQL as well.
ADDRESS, DOMAIN, TWO_LABELS = r"^([0-9]+(\.[0-9]+){3}|\[.*)$", rf"(?:[^.]*\.)?(?:{_TWO}|[^.]*)$", rf"(?:^|\.)({_TWO})$"
ADDRESSES = "(address)"


def site(host: Column) -> Column:
    """Host without user and port: what a reputation belongs to."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$", "")


def domain(name: Column) -> Column:
    """Registered domain of a site: its suffix and the label before; an address is its own."""
    return F.when(name.rlike(ADDRESS), name).otherwise(F.regexp_extract(name, DOMAIN, 0))


def suffix(name: Column) -> Column:
    """One of ``SUFFIXES``, or the last label; all addresses have one of their own."""
    two = F.regexp_extract(name, TWO_LABELS, 1)
    return F.when(name.rlike(ADDRESS), ADDRESSES).when(two != "", two).otherwise(F.substring_index(name, ".", -1))


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does; of equal ones the first in order."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _level(counts: DataFrame, key: str, prior: Column) -> DataFrame:
    """``counts`` (key, n, bad, prior mean) with the prior strength of the level and the posterior's mean and bound."""
    mean = prior
    seen = counts.where("n > 1").agg(
        F.sum(mean * (1 - mean) * (F.col("n") - 1)).alias("scale"),
        F.sum((F.pow(F.col("bad") - F.col("n") * mean, 2) / F.col("n")) - mean * (1 - mean)).alias("excess"),
    )
    # Var(bad / n) = m (1 - m) (1 + (n - 1) r) / n with r = 1 / (strength + 1).
    r = F.coalesce(F.try_divide("excess", "scale"), F.lit(0.0))
    strength = seen.select(F.when(r <= 1 / (STRENGTH[1] + 1), STRENGTH[1]).otherwise(F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), 1 / r - 1))).alias("strength"))
    a, b = F.col("bad") + mean * F.col("strength"), F.col("n") - F.col("bad") + (1 - mean) * F.col("strength")
    out = counts.join(F.broadcast(strength))  # one row
    return out.select(key, *[c for c in ("up", "upper") if c in counts.columns], a.alias("a"), b.alias("b"))


def _bound(a: Column, b: Column) -> Column:
    """Lower bound of a beta distribution by its mean and standard deviation."""
    return a / (a + b) - Z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posteriors ``(name, a, b)`` of sites, domains and suffixes from ``(host, bad)`` rows, ``host`` a site.

    Rows with a null or empty host or a null outcome are left out.  No rows: empty tables.  Every
    level is a written table: its plan is not repeated by the next, and a join by a suffix that
    most domains share can be split.
    """
    seen = outcomes.where("host <> '' AND bad IS NOT NULL")
    hosts = written(seen.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")), "host-outcomes")
    hosts = hosts.select("host", domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"), "n", "bad")
    total = lambda key: hosts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("m"))
    suffixes = written(_level(total("suffix").join(F.broadcast(overall)).withColumnRenamed("suffix", "name"), "name", F.col("m")), "suffix-posteriors")
    mean = lambda df, key: df.select(F.col("name").alias(key), (F.col("a") / (F.col("a") + F.col("b"))).alias("m"))
    domains = written(total("domain").withColumn("suffix", suffix(F.col("domain"))), "domain-outcomes").join(mean(suffixes, "suffix"), "suffix")
    domains = written(_level(domains.withColumnRenamed("domain", "name"), "name", F.col("m")), "domain-posteriors")
    of_hosts = written(_level(hosts.join(mean(domains, "domain"), "domain").withColumnRenamed("host", "name"), "name", F.col("m")), "host-posteriors")
    return of_hosts, domains, suffixes


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page.

    ``outcomes``: rows ``(page_id, bad)`` of labelled pages; null outcomes count as none, rows that
    repeat a page count each.  A null url, or one without ``://``, has empty host and path, fits no
    rule and is allowed.  Pages without an id and repeated pages keep a row each.  Other columns
    are ignored, whatever their names.
    """
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    labelled = rows.join(outcomes.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("int").alias("bad")), "page_id")
    hosts, domains, suffixes = (_bounded(df, k) for k, df in enumerate(reputations(labelled.select(site(F.col("host")).alias("host"), "bad"))))
    rows = rows.withColumn("name0", site(F.col("host"))).withColumns({"name1": domain(F.col("name0")), "name2": suffix(F.col("name0"))})
    for k, df in enumerate((hosts, domains, suffixes)):
        rows = rows.join(df, f"name{k}", "left")
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    bad = F.coalesce("bound0", "bound1", "bound2", F.lit(0.0)) >= threshold
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(bad, "block").otherwise("allow")).alias("verdict"), F.coalesce("bound0", "bound1", "bound2").alias("bad_bound"))


def _bounded(df: DataFrame, k: int) -> DataFrame:
    return df.select(F.col("name").alias(f"name{k}"), _bound(F.col("a"), F.col("b")).alias(f"bound{k}"))


def outcomes_of(labels: DataFrame) -> DataFrame:
    """Page outcomes from the quality table: page n holds document n; a toxic or low-quality document is bad."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))

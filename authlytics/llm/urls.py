"""URL filtering by rules, and by the reputation of hosts where no rule fits.

Labelled page outcomes are counted by host.  Beta-binomial priors pass from the whole table to
suffixes, from a suffix to its registered domains and from a domain to its hosts: each level's rate
is shrunk towards its parent's by a strength that the spread of the level's own rates gives (method
of moments).  A host without outcomes has its domain's rate.  A host is blocked if its rate of bad
outcomes is above a threshold with confidence: posterior mean less `Z` standard deviations.

Only built-in functions run on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.plans.storage import WorkingTables

# Suffixes of two labels under which names are registered; all others have one label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")

THRESHOLD = 0.5  # rate of bad outcomes
Z = 1.645  # one-sided, 95 %
# Bounds of the correlation within a group that the spread may show.
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 1 / 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]  # allow or block, and host/path


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*$", "")


def domain_of(host: Column) -> Column:
    name = _name(host)
    two, three = F.substring_index(name, ".", -2), F.substring_index(name, ".", -3)
    address = name.rlike(r"^[0-9.]+$") | name.startswith("[")
    return F.when(address, name).when(two.isin(*LONG_SUFFIXES), three).otherwise(two)


def suffix_of(host: Column) -> Column:
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    address = name.rlike(r"^[0-9.]+$") | name.startswith("[")
    last = F.substring_index(name, ".", -1)
    return F.when(address, F.lit("")).when(two.isin(*LONG_SUFFIXES), two).otherwise(last)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.  Of rules of one
    length that with the longer host wins, then a block.
    """

    def rank(rule: Rule):
        verdict, text = rule
        return -len(text), -text.index("/"), verdict != "block"

    chain = None
    for verdict, text in sorted(rules, key=rank):
        name, start = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(text).alias("rule"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    nothing = F.lit(None).cast("struct<verdict: string, rule: string>")
    return nothing if chain is None else chain


def _rate(bad: Column, n: Column, strength: Column | float, parent: Column | float) -> Column:
    """The posterior mean under a beta prior of that mean and strength."""
    strength, parent = (x if isinstance(x, Column) else F.lit(x) for x in (strength, parent))
    return (bad + strength * parent) / (n + strength)


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from the spread of its groups' rates, in one row."""
    held = groups.filter("n > 0").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("spread"),
    )
    k, n, bad, squares, spread = held.first()
    correlation = LEAST_CORRELATION
    if k > 1 and 0 < bad < n:
        mean = bad / n
        chance = mean * (1 - mean)
        excess = spread - n * mean * mean - (k - 1) * chance
        room = (n - squares / n - (k - 1)) * chance
        if room > 0:
            correlation = min(max(excess / room, LEAST_CORRELATION), MOST_CORRELATION)
    return (1 - correlation) / correlation


def host_reputation(
    pages: DataFrame,
    outcomes: DataFrame,
    working: WorkingTables,
    threshold: float = THRESHOLD,
    z: float = Z,
) -> DataFrame:
    """host, domain, suffix, n, bad, rate, bound, verdict: a row per host of the pages.

    `outcomes` has (page_id, bad): bad is true, false or null; null outcomes and pages without one
    count for nothing.  Each page row meets each outcome of its id.  A null url, or one without
    `://`, has the empty host.  Without any outcomes all hosts are allowed.
    """
    host = host_of(F.col("url"))
    named = pages.select("page_id", host.alias("host"))
    bad = F.col("bad").cast("int").cast("long")
    labelled = named.join(outcomes.select("page_id", bad.alias("bad")), "page_id", "left")
    hosts = labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0).cast("long")).alias("bad")
    )
    hosts = hosts.select(
        "host",
        domain_of(F.col("host")).alias("domain"),
        suffix_of(F.col("host")).alias("suffix"),
        "n",
        "bad",
    )
    hosts = working.write(hosts, "hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = working.write(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = working.write(domains.groupBy("suffix").agg(*sums), "suffixes")
    total = suffixes.agg(*sums).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    by_suffix = suffixes.select(
        "suffix",
        _rate(F.col("bad"), F.col("n"), _strength(suffixes), overall).alias("suffix_rate"),
    )
    of_domain = _rate(F.col("bad"), F.col("n"), _strength(domains), F.col("suffix_rate"))
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", "suffix", of_domain.alias("domain_rate")
    )
    strength = F.lit(_strength(hosts))
    a = F.col("bad") + strength * F.col("domain_rate")
    b = F.col("n") - F.col("bad") + strength * (1 - F.col("domain_rate"))
    rate, deviation = a / (a + b), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return (
        hosts.join(by_domain, ["domain", "suffix"])
        .withColumn("rate", rate)
        .withColumn("bound", rate - z * deviation)
        .withColumn("verdict", F.when(F.col("bound") > threshold, "block").otherwise("allow"))
        .drop("domain_rate")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    working: WorkingTables,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """page_id, host, path, rule, verdict: a row per page.

    The verdict is that of the longest rule that fits, else that of the host's reputation.
    Repeated rows stay, null ids too; an empty table gives no rows.
    """
    reputation = host_reputation(pages, outcomes, working, threshold)
    # Written, so that both sides of the join are plain shuffles and a hot host can be split.
    known = working.write(
        reputation.select("host", F.col("verdict").alias("reputed")), "reputation"
    )
    url = F.col("url")
    named = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    fitting = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        named.join(known, "host", "left")
        .withColumn("fitting", fitting)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fitting.rule").alias("rule"),
            F.coalesce(F.col("fitting.verdict"), F.col("reputed")).alias("verdict"),
        )
    )

"""URL filter by host reputation, with rules that go before it.

Labelled outcomes of pages give every host a share of bad pages. A host with few of them
borrows from its registered domain, that from its suffix, and that from all pages: at each
level the parent's mean is the mean of a beta prior whose strength comes from how much the
groups of that level differ (beta-binomial, by moments). A page is blocked if the share of
bad pages of its host is above a limit with some certainty. DataFrame operations only.
"""

from pyspark.sql import functions as F

from layercake.llm.common import staged

# Second-level suffixes under which names are registered; a parameter.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
            "ne.jp", "or.jp", "com.br", "com.cn", "com.tr", "com.mx", "co.in", "co.kr", "co.za")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT = 0.4
Z = 1.645


def split_url(url):
    """(host, path) of a URL column; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def match_rule(rules, host, path):
    """The longest of ``rules`` (name: verdict) that fits; null if none does.

    A rule is a host and a beginning of a path. It fits that host and all below it.
    """
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def levels(host, suffixes=SUFFIXES):
    """(registered domain, suffix) of a host column; ports do not count, addresses are their own domain."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(bare, r"\.", -1)
    two = F.substring_index(bare, ".", -2)
    own = F.when(two.isin(*suffixes), F.lit(3)).otherwise(F.lit(2))
    domain = F.when(own == 3, F.substring_index(bare, ".", -3)).otherwise(two)
    suffix = F.when(own == 3, two).otherwise(F.substring_index(bare, ".", -1))
    address = bare.rlike(r"^[0-9.]+$") | bare.startswith("[") | (F.size(labels) < 2)
    return F.when(address, bare).otherwise(domain), F.when(address, F.lit("")).otherwise(suffix)


def _strength(groups):
    """Weight of the prior, in pages: large if groups hardly differ beyond chance, else small.

    Where no group has two pages nothing is known of how they differ, and the prior is weak.
    """
    spare = F.sum(F.pow(F.col("bad") - F.col("n") * F.col("mean"), F.lit(2)) - F.col("n") * F.col("mean") * (1 - F.col("mean")))
    scale = F.sum(F.col("n") * (F.col("n") - 1) * F.col("mean") * (1 - F.col("mean")))
    share = F.least(F.lit(0.5), F.greatest(F.lit(0.001), F.coalesce(spare / F.nullif(scale, F.lit(0.0)), F.lit(0.5))))
    return groups.agg((1 / share - 1).alias("s")).first()["s"]


def _level(groups, key):
    """Posterior of groups with columns n, bad, and mean and var from the level above.

    The variance is that of the beta posterior, and what the prior's mean itself is unsure of
    as far as the posterior rests on it.
    """
    s = _strength(groups)
    mean = (F.col("bad") + s * F.col("mean")) / (F.col("n") + s)
    kept = s / (F.col("n") + s)
    var = mean * (1 - mean) / (F.col("n") + s + 1) + kept * kept * F.col("var")
    return groups.select(key, mean.alias("mean"), var.alias("var")), s


def reputation(outcomes, suffixes=SUFFIXES):
    """Posteriors from ``outcomes`` (host, bad): of hosts, of unseen hosts by domain, of hosts of
    unseen domains by suffix, of all others.

    The first three have a mean and a variance by ``host``, ``domain`` and ``suffix``; the last
    is a pair of numbers. ``bad`` is 0 or 1; rows with a null in either column do not count.
    """
    domain, suffix = levels(F.col("host"), suffixes)
    seen = outcomes.where("host is not null and bad is not null").groupBy("host")
    hosts = seen.agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = staged(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "url-hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = total["n"] or 0, total["bad"] or 0
    base = (bad + 1) / (n + 2)
    var = base * (1 - base) / (n + 3)

    suffixed = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixed = staged(suffixed.withColumn("mean", F.lit(base)).withColumn("var", F.lit(var)), "url-suffixes")
    suffixed, s0 = _level(suffixed, "suffix")
    suffixed = staged(suffixed, "url-suffix-means")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains, s1 = _level(staged(domains.join(suffixed, "suffix"), "url-domains"), "domain")
    owned, s2 = _level(staged(hosts.join(domains, "domain"), "url-owned"), "host")
    # A host without outcomes is as its domain, and as far off as hosts are from their domains.
    unseen = F.col("var") + F.col("mean") * (1 - F.col("mean")) / (1 + s2)
    domains = domains.select("domain", F.col("mean").alias("d_mean"), unseen.alias("d_var"))
    # One of a domain without outcomes is as its suffix, and as far off as domains are from suffixes, too.
    unseen = F.col("var") + F.col("mean") * (1 - F.col("mean")) * (1 / (1 + s1) + 1 / (1 + s2))
    suffixed = suffixed.select("suffix", F.col("mean").alias("s_mean"), unseen.alias("s_var"))
    rest = var + base * (1 - base) * (1 / (1 + s0) + 1 / (1 + s1) + 1 / (1 + s2))
    return owned, domains, suffixed, (base, rest)


def judge(pages, outcomes, rules, id_col="page_id", url_col="url", suffixes=SUFFIXES, limit=LIMIT, z=Z):
    """``id_col``, ``host``, ``path``, ``rule``, ``bad_share`` and ``verdict`` for every row of ``pages``.

    ``outcomes`` has the ids of labelled pages and ``bad`` (0 or 1); an id that occurs several
    times counts as often, for each page with it. ``rules`` maps rules to verdicts. A page
    without a rule is blocked if the lower bound of its host's posterior share of bad pages
    (the mean less ``z`` times the deviation) is above ``limit``. Null and odd URLs have an empty
    host and path and are judged as one host. Repeated rows and null ids are kept; other
    columns are not looked at.
    """
    host, path = split_url(F.col(url_col))
    own = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    labels = outcomes.select(F.col(id_col).alias("id"), "bad")
    hosts, domains, tops, (base, rest) = reputation(own.join(labels, "id").select("host", "bad"), suffixes)
    domain, suffix = levels(F.col("host"), suffixes)
    # The tables were written, so that a join can split a hot host.
    known = own.withColumn("domain", domain).withColumn("suffix", suffix)
    known = known.join(staged(hosts, "url-reputation"), "host", "left").join(staged(domains, "url-parents"), "domain", "left")
    known = known.join(staged(tops, "url-tops"), "suffix", "left")
    mean = F.coalesce("mean", "d_mean", "s_mean", F.lit(base))
    low = mean - z * F.sqrt(F.coalesce("var", "d_var", "s_var", F.lit(rest)))
    verdict = F.lit(None).cast("string")
    rule = match_rule(rules, F.col("host"), F.col("path"))
    for name, says in rules.items():
        verdict = F.when(F.col("rule") == name, says).otherwise(verdict)
    found = known.withColumn("rule", rule).withColumn("bad_share", mean)
    by_method = F.when(low > limit, "block").otherwise("allow")
    return found.select(
        F.col("id").alias(id_col), "host", "path", "rule", "bad_share", F.coalesce(verdict, by_method).alias("verdict")
    )

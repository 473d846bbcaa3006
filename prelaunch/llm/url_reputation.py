"""URL filter: allow and block rules, then empirical-Bayes reputation of hosts.

A rule is ``host/path``: it fits its host and all subdomains, where the url's path starts with the rule's; the longest
rule that fits decides. The pages that rules decide are the labelled outcomes of their hosts. A page without a rule is
judged by its host's probability of being blocked, shrunk through three levels of beta-binomial priors: the suffix is drawn
to the overall rate, the registered domain to its suffix, the host to its domain. How strongly follows from the data: at
each level the intraclass correlation of the children around their parents' means is estimated by moments, and gives the
prior's weight (empirical Bayes). A host is blocked when the lower posterior bound, mean - Z * standard deviation, reaches
``MIN_BOUND``. The variance is that of the host's beta posterior and, as far as the prior's mean counts, that of the
levels above; so hosts without labelled pages are judged by their domain's prior, and only where that is known well.

Scale: pages are aggregated to hosts once (map-side combined, so a host with a third of all pages is one row a task);
levels above work on host rows. Only hosts that are blocked go back to the pages, by a join that is broadcast only when
their measured size is small; else by a shuffle on (host, salt) with the host rows repeated for every salt.

Edge cases: a null url or one without ``://`` has empty host and path, fits no rule and is judged like any host without
labels under the empty suffix. Repeated pages count and are judged one by one. Without labelled pages everything
without a rule is allowed. An empty table gives an empty result. Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint
from prelaunch.llm.html_text import host_of

Z = 1.645
MIN_BOUND = 0.75
SALTS = 32
BROADCAST_BYTES = 32 << 20
LEAST_RHO, MOST_RHO = 0.001, 0.95

# Public suffixes of two labels; every other suffix is the last label.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx",
                      "com.tr", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk"]


@dataclass(frozen=True)
class Rule:
    rule: str            # host/path, like "net/es/"
    verdict: str         # allow or block

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1] if "/" in self.rule else ""


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; "" without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits (ties: the one that sorts first), as a struct of rule and verdict; else null."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        hit = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def prior_weight(children: DataFrame) -> float:
    """Beta weight kappa of rows (n, y, mu): y of n outcomes around the parent's mean mu. One global aggregate."""
    spread = F.pow(F.col("y") - F.col("n") * F.col("mu"), 2)
    unit = F.col("mu") * (1 - F.col("mu"))
    s, e, w = children.where("n > 0").agg(F.sum(spread), F.sum(F.col("n") * unit), F.sum(F.col("n") * (F.col("n") - 1) * unit)).first()
    rho = (s - e) / w if w else LEAST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def posterior(parent: DataFrame, k: float, keys: list[str]) -> DataFrame:
    """``keys``, mu and var of rows (n, y, mu, var): y of n outcomes under a beta prior of weight k around the parent's
    mean mu, whose own variance is var."""
    a, b = k * F.col("mu") + F.col("y"), k * (1 - F.col("mu")) + F.col("n") - F.col("y")
    t = F.col("n") + k
    var = a * b / (t * t * (t + 1)) + F.pow(k / t, 2) * F.col("var")
    return parent.select(*keys, (a / t).alias("mu"), var.alias("var"))


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, y, mean, bound) of ``outcomes`` (host, n labelled pages, y of them blocked; one row a host)."""
    hosts = shared_checkpoint(outcomes.select("host", "n", "y", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")))
    n, y = hosts.agg(F.sum("n"), F.sum("y")).first()
    if not n:
        return hosts.select("host", "n", "y", F.lit(0.0).alias("mean"), F.lit(0.0).alias("bound"))
    rate = (y + 0.5) / (n + 1.0)
    sums = [F.sum("n").alias("n"), F.sum("y").alias("y")]
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumns({"mu": F.lit(rate), "var": F.lit(0.0)})
    suffixes = posterior(suffixes, prior_weight(suffixes), ["suffix"])
    domains = shared_checkpoint(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix"))
    domains = posterior(domains, prior_weight(domains), ["suffix", "domain"])
    # a domain with very many hosts is a hot key: the planner may split that side
    placed = shared_checkpoint(hosts.join(domains, ["suffix", "domain"]))
    judged = posterior(placed, prior_weight(placed), ["host", "n", "y"])
    return judged.select("host", "n", "y", F.col("mu").alias("mean"), (F.col("mu") - z * F.sqrt("var")).alias("bound"))


def judge_urls(pages: DataFrame, rules: list[Rule], min_bound: float = MIN_BOUND, z: float = Z) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    read = read.withColumn("w_rule", matching_rule(F.col("host"), F.col("path"), rules))
    outcomes = read.groupBy("host").agg(F.count("w_rule").alias("n"), F.coalesce(F.sum((F.col("w_rule.verdict") == "block").cast("long")), F.lit(0)).alias("y"))
    blocked = shared_checkpoint(host_reputation(outcomes, z).where(F.col("bound") >= min_bound).select(F.col("host").alias("w_host")))
    size = blocked.agg(F.sum(F.octet_length("w_host") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = read.join(F.broadcast(blocked), F.col("host") == F.col("w_host"), "left")
    else:
        salted = blocked.withColumn("w_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        side = read.withColumn("w_own", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
        joined = side.join(salted, (F.col("host") == F.col("w_host")) & (F.col("w_own") == F.col("w_salt")), "left")
    method = F.when(F.col("w_host").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", F.col("w_rule.rule").alias("rule"), F.coalesce("w_rule.verdict", method).alias("verdict"))


QUERY_RULES = [Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"), Rule("net/es/", "block"),
               Rule("net/fr/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`judge_urls` over all pages with the contract's rules."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), QUERY_RULES)


def _oracle(rules: list[Rule]) -> str:
    cases = " ".join(f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.rule}'"
                     for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule)))
    verdicts = " ".join(f"WHEN '{r.rule}' THEN '{r.verdict}'" for r in rules)
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    weight = ("SELECT 1 / least(greatest(coalesce((sum((y - n * mu) ** 2) - sum(n * mu * (1 - mu))) / nullif(sum(n * (n - 1) * mu * (1 - mu)), 0), "
              f"{LEAST_RHO}), {LEAST_RHO}), {MOST_RHO}) - 1 AS k FROM")
    post = "(y + k * mu) / (n + k) AS mu, (k * mu + y) * (k * (1 - mu) + n - y) / ((n + k) ** 2 * (n + k + 1)) + (k / (n + k)) ** 2 * var AS var"
    last = lambda n: f"array_to_string(list_slice(string_split(host, '.'), -{n}, -1), '.')"
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r AS (SELECT *, CASE {cases} END AS rule FROM p),
d AS (SELECT *, CASE rule {verdicts} END AS decided FROM r),
h AS (SELECT host, count(decided) AS n, count(*) FILTER (decided = 'block') AS y,
             CASE WHEN {last(2)} IN ({two}) THEN {last(3)} ELSE {last(2)} END AS domain,
             CASE WHEN {last(2)} IN ({two}) THEN {last(2)} ELSE {last(1)} END AS suffix FROM d GROUP BY host),
g AS (SELECT (sum(y) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS rate FROM h),
s0 AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(y)::DOUBLE AS y, any_value(rate) AS mu, 0::DOUBLE AS var FROM h, g GROUP BY suffix),
ks AS ({weight} s0 WHERE n > 0),
s AS (SELECT suffix, {post} FROM s0, ks),
d0 AS (SELECT suffix, domain, sum(n)::DOUBLE AS n, sum(y)::DOUBLE AS y, any_value(mu) AS mu, any_value(var) AS var
       FROM h JOIN s USING (suffix) GROUP BY suffix, domain),
kd AS ({weight} d0 WHERE n > 0),
dm AS (SELECT suffix, domain, {post} FROM d0, kd),
h0 AS (SELECT host, h.n::DOUBLE AS n, h.y::DOUBLE AS y, mu, var FROM h JOIN dm USING (suffix, domain)),
kh AS ({weight} h0 WHERE n > 0),
hp AS (SELECT host, {post} FROM h0, kh),
bad AS (SELECT host FROM hp WHERE mu - {Z} * sqrt(var) >= {MIN_BOUND})
SELECT page_id, d.host, path, rule, coalesce(decided, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM d LEFT JOIN bad ON d.host = bad.host
"""


ORACLE_SQL = _oracle(QUERY_RULES)

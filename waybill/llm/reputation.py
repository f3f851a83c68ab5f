"""URL filter by rules and by empirical-Bayes host reputation.

The outcomes of labelled pages (bad or not) are shrunk along the name of the host: the share
of bad pages of all is the prior of a suffix, a suffix's posterior mean the prior of its
registered domains, and a domain's that of its hosts. The strength of each prior is estimated
from the data: the beta-binomial intra-class correlation of the groups of that level by the
method of moments. A host is blocked when its posterior bound (mean minus `DEVIATIONS`
standard deviations) is above `MOST_BAD`: few pages move a host little.

The domain is the last two labels of the host without port, the suffix the last one. Hosts
without a labelled page have the posterior of their domain's mean. Pages without a url or
without `://` have an empty host and path. Labels without a quality and not toxic, and labels
of other pages, are not used; several labels of a page all count. Repeated pages are judged
alike. No pages give no rows; without labels all hosts share one bound. Urls of any length are
taken whole. Only page_id, url and the labels are read, whatever other columns are called.
"""

from pyspark.sql import functions as F

DEVIATIONS = 1.645
MOST_BAD = 0.5
DEFAULT_CORRELATION = 0.1
LEVELS = ("suffix", "domain", "host")
#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages):
    """page_id, host, path, domain and suffix."""
    url = F.coalesce("url", F.lit(""))
    part = lambda group: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group)
    rows = pages.select("page_id", F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))
    bare = F.regexp_replace("host", r":\d*$", "")
    return rows.select(
        "*",
        F.substring_index(bare, ".", -2).alias("domain"),
        F.substring_index(bare, ".", -1).alias("suffix"),
    )


def fitting(rules=RULES):
    """(rule, verdict) of the longest rule that fits host and path; null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda rule: len(rule[1]) + len(rule[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        answer = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, answer).otherwise(found)
    return found


def outcomes(rows, labels):
    """(host, domain, suffix, n, k): labelled pages and bad ones of each host."""
    bad = F.when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull(), (F.col("quality") == 0).cast("int"))
    known = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).dropna()
    return rows.join(known, "page_id").groupBy("host", "domain", "suffix").agg(
        F.count("*").alias("n"), F.sum("bad").alias("k")
    )


def strength(groups):
    """One row: (weight), the prior's number of pages at a level, from its groups (n, k)."""
    sums = groups.where("n > 0").agg(
        F.count("*").alias("m"),
        F.sum("n").alias("nn"),
        F.sum("k").alias("kk"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("spread"),
    )
    mean = F.col("kk") / F.nullif("nn", F.lit(0))
    variance = F.nullif(mean * (1 - mean), F.lit(0.0))
    excess = (F.col("spread") - mean * F.col("kk")) / variance - (F.col("m") - 1)
    room = F.nullif(F.col("nn") - F.col("squares") / F.nullif("nn", F.lit(0)) - (F.col("m") - 1), F.lit(0.0))
    correlation = F.coalesce(excess / room, F.lit(DEFAULT_CORRELATION))
    correlation = F.least(F.greatest(correlation, F.lit(0.001)), F.lit(0.999))
    return sums.select((1 / correlation - 1).alias("weight"))


def reputations(hosts, labelled):
    """(host, domain, suffix, bound) of every host; `labelled` as `outcomes` gives them."""
    counts = hosts.join(labelled, ["host", "domain", "suffix"], "left").fillna(0, ["n", "k"])
    levels = {
        "suffix": counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")),
        "domain": counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")),
        "host": counts,
    }
    # One row each.
    whole = counts.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("prior"))
    prior = None
    for level, above in zip(LEVELS, (None, "suffix", "domain"), strict=True):
        groups = levels[level]
        one = F.broadcast(strength(groups))
        if above is None:
            joined = groups.join(F.broadcast(whole), F.lit(True)).join(one, F.lit(True))
        else:
            joined = groups.join(prior, [c for c in ("suffix", "domain") if c in prior.columns]).join(one, F.lit(True))
        alpha = F.col("prior") * F.col("weight") + F.col("k")
        total = F.col("weight") + F.col("n")
        mean = alpha / total
        if level == "host":
            deviation = F.sqrt(mean * (1 - mean) / (total + 1))
            return joined.select("host", "domain", "suffix", F.round(mean - DEVIATIONS * deviation, 6).alias("bound"))
        keys = ["suffix"] if level == "suffix" else ["domain", "suffix"]
        prior = joined.select(*keys, mean.alias("prior"))


def judged(pages, labels, rules=RULES):
    """One row per page: page_id, host, path, rule, verdict and bound."""
    rows = parsed(pages)
    hosts = rows.select("host", "domain", "suffix").distinct()
    known = reputations(hosts, outcomes(rows, labels)).select(F.col("host").alias("key"), "bound")
    return (
        rows.join(known, F.col("host") == F.col("key"))
        .withColumn("found", fitting(rules))
        .select(
            "page_id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.when(F.col("bound") > MOST_BAD, "block").otherwise("allow")).alias("verdict"),
            "bound",
        )
    )


def _level_sql(name, keys, prior):
    return f"""
{name}_s AS (
  SELECT count(*) m, sum(n) nn, sum(k) kk, sum(n * n) sq, sum(k * k / n) sp FROM {name} WHERE n > 0),
{name}_w AS (
  SELECT 1 / least(greatest(coalesce(
    ((sp - kk / nullif(nn, 0) * kk) / nullif(kk / nullif(nn, 0) * (1 - kk / nullif(nn, 0)), 0) - (m - 1))
    / nullif(nn - sq / nullif(nn, 0) - (m - 1), 0), {DEFAULT_CORRELATION}), 0.001), 0.999) - 1 AS weight
  FROM {name}_s),
{name}_p AS (
  SELECT {keys}, (prior * weight + k) / (weight + n) AS prior, weight + n AS total
  FROM {name} {prior}, {name}_w)"""


def _judged_sql():
    bad = "CASE WHEN toxic = 1 THEN 1 WHEN quality IS NOT NULL THEN (quality = 0)::INT END"
    ordered = sorted(RULES, key=lambda rule: -len(rule[1]) - len(rule[2]))
    fits = lambda host, path: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered)
    return f"""
WITH u AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages),
r AS (
  SELECT page_id, translate(x.h, '{UPPER}', '{LOWER}') AS host, x.p AS path,
    list_reverse(string_split(regexp_replace(translate(x.h, '{UPPER}', '{LOWER}'), ':\\d*$', ''), '.')) AS labels FROM u),
p AS (
  SELECT page_id, host, path, labels[1] AS suffix,
    CASE WHEN len(labels) > 1 THEN labels[2] || '.' || labels[1] ELSE labels[1] END AS domain FROM r),
l AS (SELECT doc_id AS page_id, {bad} AS bad FROM labels WHERE {bad} IS NOT NULL),
host AS (
  SELECT host, domain, suffix, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
  FROM p LEFT JOIN l USING (page_id) GROUP BY ALL),
domain AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM host GROUP BY ALL),
suffix AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domain GROUP BY ALL),
whole AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS prior FROM suffix),
{_level_sql("suffix", "suffix", ", whole")},
{_level_sql("domain", "domain, suffix", "JOIN suffix_p USING (suffix)")},
{_level_sql("host", "host", "JOIN domain_p USING (domain, suffix)")},
b AS (SELECT host, round(prior - {DEVIATIONS} * sqrt(prior * (1 - prior) / (total + 1)), 6) AS bound FROM host_p)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN bound > {MOST_BAD} THEN 'block' ELSE 'allow' END AS verdict, bound
FROM p JOIN b USING (host)
"""


JUDGED_SQL = _judged_sql()

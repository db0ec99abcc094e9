"""URL filters: path rules, and empirical-Bayes host reputation, in DataFrame operations only.

The share of bad pages of a host is estimated by a chain of beta-binomial models: the rate of a
suffix shrinks to that of all pages, a registered domain's to its suffix's, a host's to its
domain's. How strongly a level shrinks (the prior's weight, in pages) is estimated by the method of
moments from the spread of that level's own rates. A host is blocked if the lower bound of its
posterior (by the normal approximation of the beta's quantile: mean less Z standard deviations) is
above ``threshold``: little evidence never blocks a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, private, read, small, without, written

#: (verdict, rule); a rule is a host, fitting its subdomains too, and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Suffixes of two labels under which domains are registered.
SECOND_LEVEL = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "org.au", "org.uk")
THRESHOLD, Z, LEAST_WEIGHT, MOST_WEIGHT = 0.5, 1.645, 1.0, 1000.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does; of equal ones the first listed."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def prior_weight(level: DataFrame) -> float:
    """Weight of the prior over the rates of ``level`` (n, bad), from their spread beyond chance."""
    row = level.agg(F.count("*").alias("m"), F.sum("n").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("rr")).first()
    if not row.n or row.m < 2:
        return MOST_WEIGHT
    rate = row.bad / row.n
    free = row.n - row.nn / row.n
    between = (row.rr - row.n * rate * rate - (row.m - 1) * rate * (1 - rate)) / free if free > 0 else 0.0
    if between <= 0 or rate * (1 - rate) <= 0:
        return MOST_WEIGHT
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, rate * (1 - rate) / between - 1))


def reputation(outcomes: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, bad, rate, bound) for the hosts of ``outcomes`` (host, bad 0/1 or null).

    Rows with a null outcome count as unlabelled; a host with no label has its domain's rate and the
    widest bound. One row per host: counts are added up before anything is shuffled by key.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    hosts = written(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = (bad + 1) / (n + 2)
    ws, wd, wh = (prior_weight(x.filter("n > 0")) for x in (suffixes, domains, hosts))
    shrunk = lambda prior, w: (F.col("bad") + w * prior) / (F.col("n") + w)
    by_suffix = suffixes.select("suffix", shrunk(F.lit(overall), ws).alias("suffix_rate"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", shrunk(F.col("suffix_rate"), wd).alias("domain_rate"))
    rate = F.col("rate")
    rated = hosts.join(by_domain, "domain").withColumn("rate", shrunk(F.col("domain_rate"), wh))
    return rated.select("host", "domain", "suffix", "n", "bad", "rate", (rate - Z * F.sqrt(rate * (1 - rate) / (F.col("n") + wh + 1))).alias("bound"))


def url_verdicts(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule and verdict (block or allow).

    ``outcomes`` (page_id, bad 0/1) labels some pages; a page may have none, or several that count
    each. A null url and one without ``://`` have an empty host and path and fit no rule; their
    empty host has a reputation like any other. Rows that repeat are judged alike, and each counts;
    no pages give no rows, no outcomes the verdict allow where no rule fits. Columns of these names are
    replaced, others stay.
    """
    base = without(pages, "host", "path", "rule", "verdict")
    rule_says, blocked = private(base, "rule_says", "blocked")
    host, path = host_and_path(F.col("url"))
    placed = base.withColumn("host", host).withColumn("path", path)
    labelled = placed.select("page_id", "host").join(outcomes.select("page_id", F.col("bad").cast("int").alias("bad")), "page_id", "left").select("host", "bad")
    text, says = longest_rule(F.col("host"), F.col("path"), rules)
    bad = small(reputation(labelled).filter(F.col("bound") > threshold).select("host", F.lit(True).alias(blocked)))
    judged = placed.withColumn("rule", text).withColumn(rule_says, says).join(bad, "host", "left")
    return judged.select(*columns(base), "host", "path", "rule", F.coalesce(rule_says, F.when(F.col(blocked), "block").otherwise("allow")).alias("verdict"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad if the label of its id, shared with documents, says low quality or toxic."""
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0).alias("bad"))
    return url_verdicts(read(spark, sf_dir, "pages").select("page_id", "url"), labels).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
with p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, case when coalesce(strpos(url, '://'), 0) > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages)
), o as (
  select host, case when quality = 0 or toxic = 1 then 1 when quality is not null or toxic is not null then 0 end as bad from p left join labels on labels.doc_id = p.page_id
), h as (select host, count(bad) as n, coalesce(sum(bad), 0) as bad, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain, list_extract(string_split(host, '.'), -1) as suffix from o group by host),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from h group by all), s as (select suffix, sum(n) as n, sum(bad) as bad from d group by suffix),
g as (select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) as r0 from s),
w as (
  select k, case when nn is null or m < 2 or free <= 0 then 1000.0 when bt <= 0 or r * (1 - r) <= 0 then 1000.0 else least(1000.0, greatest(1.0, r * (1 - r) / bt - 1)) end as w from (
    select *, (rr - nn * r * r - (m - 1) * r * (1 - r)) / nullif(free, 0) as bt from (
      select *, bb / nn as r, nn - n2 / nn as free from (
        select k, count(*) as m, sum(n)::double as nn, sum(bad)::double as bb, sum(n::double * n) as n2, sum(bad::double * bad / n) as rr
        from (select 's' as k, n, bad from s union all select 'd', n, bad from d union all select 'h', n, bad from h) where n > 0 group by k)))
), rs as (select suffix, (bad + w.w * g.r0) / (n + w.w) as r from s, g, (select coalesce(max(w), 1000.0) as w from w where k = 's') w),
rd as (select domain, (bad + w.w * rs.r) / (n + w.w) as r from d join rs using (suffix), (select coalesce(max(w), 1000.0) as w from w where k = 'd') w),
rh as (select host, w.w, n, (bad + w.w * rd.r) / (n + w.w) as r from h join rd using (domain), (select coalesce(max(w), 1000.0) as w from w where k = 'h') w),
b as (select host, r - 1.645 * sqrt(r * (1 - r) / (n + w + 1)) > 0.5 as blocked from rh),
f as (
  select p.*, case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from p
)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow' when blocked then 'block' else 'allow' end as verdict from f left join b using (host)
"""

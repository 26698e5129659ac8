"""URL rules found through their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import lower_ascii, query, table


@dataclass(frozen=True)
class Rule:
    """`domain` rules win over `pattern` rules, longer names over shorter ones."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    kind: str


def domain_rule(verdict: str, name: str) -> Rule:
    """A host with all its subdomains and a path prefix, such as `example.net/en/`."""
    host, slash, path = name.partition("/")
    inside = path.rsplit("/", 1)[0] if "/" in path else ""
    tokens = tuple(re.findall("[a-z0-9]+", host) + re.findall("[A-Za-z0-9]+", inside))
    return Rule(name, verdict, r"^(?:[^/?#]*\.)?" + re.escape(host + slash + path), tokens, "domain")


def pattern_rule(verdict: str, name: str, pattern: str, *tokens: str) -> Rule:
    """A regular expression whose every match holds the given whole tokens."""
    return Rule(name, verdict, pattern, tokens, "pattern")


RULES = (
    domain_rule("block", "net/"),
    domain_rule("allow", "example.net/en/"),
    domain_rule("block", "example.com/de/"),
    domain_rule("allow", "org/fr/"),
    pattern_rule("block", "pills", r"^(?:[^/?#]*\.)?cheap-pills\.", "cheap", "pills"),
    pattern_rule("block", "farm", r"^(?:[^/?#]*\.)?spam-farm\.", "spam", "farm"),
    pattern_rule("block", "casino", r"^(?:[^/?#]*[.-])?casino[.-]", "casino"),
)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+"), F.lit(0)))


def judge_urls(df: DataFrame, rules=RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule, verdict and pattern to every row; other columns stay.

    A first pass counts the rules' literal tokens over all URLs; each rule is filed under its rarest one. URL tokens
    fetch candidate rules by an equality join with that index (one row per rule, so it is broadcast), and only the
    candidates run their expression. Null URLs and those without `://` have an empty host and path and get the
    default. Rows are told apart by a row number, so repeated rows stay repeated.
    """
    for name in ("host", "path", "rule", "verdict", "pattern"):
        df = df.drop(name)
    spark, columns = df.sparkSession, df.columns
    parsed = df.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
    parts = parsed.withColumn("_row", F.monotonically_increasing_id()).withColumn("_site", F.concat("host", "path"))
    wanted = spark.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, r.kind, t) for i, r in enumerate(rules) for t in r.tokens],
        "_id int, _name string, _verdict string, _pattern string, _kind string, _token string",
    )
    words = parts.select(F.explode(_tokens(F.col("_site"))).alias("_token"))
    counted = words.join(F.broadcast(wanted.select("_token").distinct()), "_token").groupBy("_token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "_token"))
    index = wanted.join(counted, "_token", "left").groupBy("_id", "_name", "_verdict", "_pattern", "_kind").agg(
        rarest["_token"].alias("_token")
    )
    found = (
        parts.select("_row", "_site", F.explode(_tokens(F.col("_site"))).alias("_token"))
        .join(F.broadcast(index), "_token")
        .filter(F.expr("_site rlike _pattern"))
        .groupBy("_row")
        .agg(F.max(F.struct(F.col("_kind") == "domain", F.length("_name"), "_name", "_verdict", "_kind")).alias("_best"))
    )
    best, domain = F.col("_best"), F.col("_best._kind") == "domain"
    return parts.join(found, "_row", "left").select(
        *columns,
        "host",
        "path",
        F.when(domain, best["_name"]).alias("rule"),
        F.coalesce(best["_verdict"], F.lit(default)).alias("verdict"),
        F.when(best["_kind"] == "pattern", best["_name"]).alias("pattern"),
    )


OP4_SQL = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
q AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    CASE WHEN contains('.' || host, '.cheap-pills.') THEN 'pills'
      WHEN contains('.' || host, '.spam-farm.') THEN 'farm'
      WHEN regexp_matches(host, '(^|[.-])casino[.-]') THEN 'casino' END AS pattern
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM q
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")

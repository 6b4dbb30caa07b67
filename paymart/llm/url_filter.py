"""URL filter: host and path rules by equi-join, in DataFrame functions only.

A rule is (host, path, verdict). It fits a URL if the URL's host is the rule's
or a subdomain of it and the URL's path starts with the rule's path. Of the
rules that fit, the longest (host and path together) wins; between equally long
ones the one with the longer host, then ``block`` before ``allow``. No rule, or
a URL without ``://``: the default verdict.

Method: each distinct (host, path) is expanded into its host suffixes times its
path prefixes (only of the lengths that some rule's path has, so prefixes that
end inside a segment are found too). Each expression's SHA-256 is cut to a short
prefix, which is the key of an equi-join with the rules; the full digests
confirm. A host of d labels and k rule path lengths gives at most d * k
expressions, whatever the number of rules. Distinct (host, path) pairs are found
first, folded per task, so a URL that a third of all rows have is expanded
once; the verdicts are joined back, where Spark can split a skewed key.

Results: one row per input row, its columns kept, with ``host``, ``path``,
``rule`` (host + path, or null) and ``verdict`` (clashing names are replaced).
Null url: empty host and path. Repeated rows are judged each. Rules with a null
or empty host fit nothing; a null rule path counts as empty (fits every path);
repeated rules count once. An empty table gives an empty table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest prefix that the join uses.
SHORT = 8
DEFAULT_VERDICT = "allow"
_OUT = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    rest = F.substring_index(_rest(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """Path: what follows the host, up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    at = F.locate("/", rest)
    return F.when(at > 0, rest.substr(at, F.length(rest))).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and every parent domain."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _digested(df: DataFrame) -> DataFrame:
    full = df.withColumn("digest", F.sha2(_expression(F.col("r_host"), F.col("r_path")), 256))
    return full.withColumn("short", F.substring("digest", 1, SHORT))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules with their digests, one row per (host, path)."""
    clean = (rules.select(F.col("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
             .where(F.coalesce(F.col("r_host"), F.lit("")) != ""))
    # 'block' is the larger text, so it wins over 'allow' for the same rule
    return _digested(clean.groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict")))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``."""
    known = prepared_rules(rules)
    # the distinct lengths of rule paths: one row, no longer than a URL is long
    lengths = known.agg(F.collect_set(F.length("r_path"))).first()[0]
    lengths = F.array(*map(F.lit, sorted(lengths))).cast("array<int>")
    kept = [c for c in pages.columns if c not in _OUT]
    parsed = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    distinct = parsed.select("host", "path").where("host <> ''").distinct()
    expanded = (distinct
                .select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("r_host"))
                .select("host", "path", "r_host",
                        F.explode(F.filter(lengths, lambda n: n <= F.length("path"))).alias("n"))
                .select("host", "path", "r_host", F.col("path").substr(F.lit(1), F.col("n")).alias("r_path")))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("size"), F.length("r_host").alias("host_size"),
                    F.col("r_verdict").alias("verdict"), F.concat("r_host", "r_path").alias("rule"))
    best = (_digested(expanded).join(known, ["short", "digest", "r_host", "r_path"])
            .groupBy("host", "path").agg(F.max(rank).alias("best")))
    return (parsed.join(best, ["host", "path"], "left")
            .select(*kept, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")))


#: The rules of the registered query: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def oracle_sql(rules: list[tuple[str, str, str]] = RULES) -> str:
    """DuckDB SQL of the same verdicts."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {values}),
rest AS (
  SELECT page_id, row_number() OVER () AS row_no,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (
  SELECT page_id, row_no,
         translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(regexp_extract(rest, '^[^?#]*'), '/.*$', 0, 's') AS path
  FROM rest),
fits AS (
  SELECT row_no, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY row_no ORDER BY length(r_host) + length(r_path) DESC,
                            length(r_host) DESC, r_verdict DESC) AS place
  FROM parsed JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parsed LEFT JOIN fits ON parsed.row_no = fits.row_no AND place = 1
"""

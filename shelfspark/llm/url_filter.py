"""URL filters: host-suffix / path-prefix expressions joined to a rule table by short hashes.

Each distinct (host, path) is expanded into the expressions a rule could have: one per shape
(number of host labels, length of the path prefix) that occurs in the rule table. An
expression's SHA-256 is cut to a 4-byte prefix for an equi-join with the rules; the full digest
then confirms the match, and the longest rule wins (block before allow on equal length).

Defined cases: a null URL, or one without ``://``, has an empty host and path and meets no rule;
repeated rows each get their own verdict; an empty rule table leaves the default verdict;
other columns of the input are kept out of the result except the id. A rule with an empty or
null host or path is rejected with ValueError by ``rule_table``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.common import read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The production rules (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.translate(F.coalesce(F.regexp_extract(after, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    after = F.substring(url, F.length(rest) + 4, F.length(url))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    if any(not h or not p or v not in ("allow", "block") for v, h, p in rules):
        raise ValueError("a rule needs a verdict (allow or block), a host and a path")
    return spark.createDataFrame(list(rules), "rule_verdict string, rule_host string, rule_path string")


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (or null) and verdict."""
    rules = rules.select(
        "rule_verdict", "rule_host", "rule_path",
        F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path"), 256).alias("rule_digest"))
    # Distinct shapes number at most labels x path lengths, however many rules there are.
    shapes = [(r.labels, r.size) for r in rules.select(
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.length("rule_path").alias("size")).distinct().collect()]
    base = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    none = F.lit(None).cast("string")
    if not shapes:
        return base.select(id_col, "host", "path", none.alias("rule"), F.lit(default).alias("verdict"))
    labels = F.size(F.split("host", r"\."))
    forms = F.array(*[
        F.when((labels >= n) & (F.length("path") >= size),
               F.concat(F.substring_index("host", ".", -n), F.lit("\n"), F.substring("path", 1, size)))
        for n, size in sorted(shapes)])
    forms = (base.select("host", "path").distinct()
             .select("host", "path", F.explode(F.array_compact(forms)).alias("form"))
             .withColumn("digest", F.sha2("form", 256)))
    hits = (forms.join(rules, _short(F.col("digest")) == _short(F.col("rule_digest")))
            .filter(F.col("digest") == F.col("rule_digest")))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.col("rule_verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"))).alias("best"))
    return (base.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), rule_table(spark, RULES))


SQL = {"op8_url_filter": """
WITH u AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(v, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT hp.page_id, r.v, r.h || r.p AS rule,
         row_number() OVER (PARTITION BY hp.page_id ORDER BY length(r.h || r.p) DESC) AS k
  FROM hp JOIN r ON (hp.host = r.h OR ends_with(hp.host, '.' || r.h)) AND starts_with(hp.path, r.p))
SELECT hp.page_id, hp.host, hp.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM hp LEFT JOIN m ON hp.page_id = m.page_id AND m.k = 1
"""}

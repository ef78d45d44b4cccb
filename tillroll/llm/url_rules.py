"""URL allow and block rules, found by their rarest literal token.

DataFrame operations only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import free_prefix, read

#: (verdict, host, path): a rule fits its host and all subdomains, where the path starts with its path.
PRODUCTION_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct labels of the host and whole segments of the path; a mark tells which is which.

    The empty token, which all have, files rules that hold no whole token.
    """
    return F.array_distinct(F.concat(
        F.array(F.lit("")),
        F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h "), x)),
        F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p "), x))))


def _rule_tokens(host: Column, path: Column) -> Column:
    """Tokens that every fitting URL has: all labels, and the segments that a slash closes in the rule."""
    closed = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return url_tokens(host, closed)


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9])", r"\\$1")


def rule_table(spark, rules) -> DataFrame:
    """Rules as rows: verdict, rule (host and path as one string), its regular expressions for host and path, and tokens.

    ``rules`` is a list of (verdict, host, path) or a DataFrame with these columns.
    """
    if isinstance(rules, DataFrame):
        df = rules
    else:
        rows = [F.struct(*[F.lit(x).cast("string").alias(n) for x, n in zip(r, ("verdict", "host", "path"))])
                for r in rules]
        df = (spark.range(1).select(F.inline(F.array(*rows))) if rows
              else spark.range(0).selectExpr("'' AS verdict", "'' AS host", "'' AS path"))
    host, path = F.translate("host", _UPPER, _LOWER), F.coalesce(F.col("path"), F.lit(""))
    return df.select("verdict", host.alias("rule_host"), path.alias("rule_path")).select(
        "verdict", "rule_host", F.concat("rule_host", "rule_path").alias("rule"),
        F.when(F.col("rule_host") == "", "").otherwise(
            F.concat(F.lit(r"(?s)\A(?:.*\.)?"), _quoted(F.col("rule_host")), F.lit(r"\z"))).alias("host_pattern"),
        F.concat(F.lit(r"\A"), _quoted(F.col("rule_path"))).alias("path_pattern"),
        _rule_tokens(F.col("rule_host"), F.col("rule_path")).alias("tokens"))


def judge_urls(pages: DataFrame, rules, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to each row of ``pages``.

    Every rule is filed under the one of its literal tokens that the fewest
    of the distinct URLs have; a URL's tokens fetch the rules filed under them
    and only these run their regular expressions. The longest fitting rule
    (host and path together) wins; of equally long ones the longer host, then
    ``block``, then the smaller string. Without a fitting rule: rule null and
    verdict ``default``.

    A null URL, or one without ``://``, has empty host and path, and so the
    default verdict. Rows are kept as they are, repeated ones too; the work is
    done once per distinct URL. An empty table of pages or rules is fine.
    Columns named host, path, rule or verdict in ``pages`` are replaced.
    A rule with an empty host fits every host.
    """
    spark, free = pages.sparkSession, free_prefix(pages)
    table = rule_table(spark, rules)
    urls = (pages.select(F.col(url).alias("_url")).where("_url is not null").distinct()
            .withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))}))
    seen = urls.select("_url", "_host", "_path", F.explode(url_tokens(F.col("_host"), F.col("_path"))).alias("token"))
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    counts = seen.join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    filed = (table.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
             .groupBy("verdict", "rule_host", "rule", "host_pattern", "path_pattern")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    fits = (seen.join(filed, "token")
            .where(F.rlike("_host", F.col("host_pattern")) & F.rlike("_path", F.col("path_pattern"))))
    order = F.struct(-F.length("rule"), -F.length("rule_host"), F.col("verdict") != "block", "rule")
    best = (fits.groupBy("_url").agg(F.min_by(F.struct("rule", "verdict"), order).alias("best"))
            .select(F.col("_url").alias(f"{free}url"), F.col("best.rule").alias(f"{free}rule"),
                    F.col("best.verdict").alias(f"{free}verdict")))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return (pages.join(best, F.col(url) == F.col(f"{free}url"), "left")
            .select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                    F.col(f"{free}rule").alias("rule"), F.coalesce(f"{free}verdict", F.lit(default)).alias("verdict")))


def query(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, PRODUCTION_RULES).select("page_id", "host", "path", "rule", "verdict")


#: The contract's rules by their definition, for DuckDB.
SQL = r"""
WITH r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fit AS (
  SELECT cut.page_id, cut.host, cut.path, r.h || r.p AS rule, r.verdict,
    row_number() OVER (PARTITION BY cut.page_id ORDER BY length(r.h || r.p) DESC NULLS LAST, length(r.h) DESC) AS k
  FROM cut LEFT JOIN r ON (cut.host = r.h OR ends_with(cut.host, '.' || r.h)) AND starts_with(cut.path, r.p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE k = 1
"""

"""URL filters by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over the URL without its scheme (host in lower case), with the literal tokens
(runs of a-z and 0-9 that stand whole in every URL it fits).  A rule is filed under the token that the fewest
distinct URLs have.  The tokens of a URL fetch the rules filed under them; only those run their expression.
Rules without a whole token are filed under the empty token, which every URL has.  Each distinct URL is judged once.  DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules are broadcast up to this many rows (a few hundred bytes each); beyond it the join shuffles.
BROADCAST_RULES = 10_000

# Host and path rules of the query, as (verdict, rule).
HOST_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

# Patterns for URLs that no host rule fits; a star stands for any characters.
PATTERN_RULES = [
    ("block", "/ads/"),
    ("block", "/adserver/"),
    ("block", "/banner/*.gif"),
    ("block", "/casino/"),
    ("block", "/login?"),
    ("block", "/porn/"),
    ("block", "/wp-admin/"),
    ("block", "?affiliate="),
    ("block", "&affiliate="),
]
DEFAULT = "allow"


def _tokens(literal: str, whole_from: bool, whole_to: bool) -> list[str]:
    """Tokens of a literal stretch; one at an end counts only if nothing can continue it there."""
    found = list(re.finditer(r"[a-z0-9]+", literal.lower()))
    return [m.group() for m in found if (whole_from or m.start()) and (whole_to or m.end() < len(literal))]


def host_rule(verdict: str, rule: str) -> tuple[str, str, str, int, list[str]]:
    """A rule host/path...: fits the host and its subdomains where the path starts with the rule's."""
    host, _, path = rule.partition("/")
    regex = r"^(?:[^/?#]*\.)?" + re.escape(host) + re.escape("/" + path)
    return rule, verdict, regex, len(rule), _tokens(f"{host}/{path}", True, False)


def pattern_rule(verdict: str, pattern: str) -> tuple[str, str, str, int, list[str]]:
    """A pattern anywhere in the URL; it comes after every host rule."""
    parts = pattern.split("*")
    tokens = [t for p in parts for t in _tokens(p, False, False)]
    return pattern, verdict, "(?i)" + ".*".join(map(re.escape, parts)), 0, tokens


def rule_table(spark, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """Rules as a table: rule, verdict, regex, rank (higher wins, then block, then the smaller rule), tokens."""
    rows = [host_rule(*r) for r in host_rules] + [pattern_rule(*r) for r in pattern_rules]
    if not rows:
        return spark.sql("SELECT '' AS rule, '' AS verdict, '' AS regex, 0 AS rank, array('') AS tokens").where("false")
    return spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(regex).alias("regex"), F.lit(rank).alias("rank"),
        F.array(*[F.lit(t) for t in tokens or [""]]).alias("tokens")) for rule, verdict, regex, rank, tokens in rows])))


def host_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(after, r"^[^/?#]*(/[^?#]*)?", 1)).otherwise("")


def _subject(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.concat(host_of(url), F.regexp_replace(after, r"^[^/?#]*", ""))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """rule and verdict of every distinct url that some rule fits (url, rule, verdict, rank)."""
    distinct = urls.select("url").where("url is not null and instr(url, '://') > 0").distinct()
    parsed = written(distinct.withColumn("subject", _subject(F.col("url"))), "urls")
    n, loose = rules.agg(F.count("*"), F.max(F.array_contains("tokens", "").cast("int"))).first()
    words = F.array_distinct(F.regexp_extract_all(F.translate("subject", UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))
    tokens = parsed.select("url", "subject", F.explode(F.array_append(words, "") if loose else words).alias("token"))
    small = (lambda df: F.broadcast(df)) if n <= BROADCAST_RULES else (lambda df: df)
    wanted = rules.select("rule", "verdict", "regex", "rank", F.explode("tokens").alias("token"))
    seen = tokens.select("token").join(small(wanted.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    keyed = ["rule", "verdict", "regex", "rank"]
    # each rule under its rarest token; a rule with a token that no URL has can't fit any
    index = written(wanted.join(seen, "token", "left").groupBy(keyed).agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
        .where("rarest.n > 0").select(*keyed, "rarest.token"), "rules")
    candidates = tokens.join(small(index), "token").where("subject rlike regex").select("url", *keyed)
    best = F.max_by(F.struct("rule", "verdict", "rank"), F.struct(
        "rank", (F.col("verdict") == "block").cast("int"), F.col("rule"))).alias("best")
    return candidates.groupBy("url").agg(best).select("url", "best.rule", "best.verdict", "best.rank")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    host and path are empty for a null url or one without ://.  rule names the host rule that fits (the
    longest; of equally long ones a blocking one), else null; then the verdict is that of the patterns,
    or `default`.  Repeated rows are each returned.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    judged = written(judge_urls(rows, rules, default), "judged")
    url = F.col("url")
    return rows.join(judged, "url", "left").select(
        "page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"),
        F.when(F.col("rank") > 0, F.col("rule")).alias("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on all pages' urls."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


def _oracle() -> str:
    """DuckDB SQL that tries every rule on every url."""
    hosts = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in HOST_RULES)
    blocked = " OR ".join("contains(low, '" + "') AND contains(low, '".join(p.split("*")) + "')" for _, p in PATTERN_RULES if "*" not in p)
    starred = " OR ".join(f"regexp_matches(low, '{'.*'.join(map(re.escape, p.split('*')))}')" for _, p in PATTERN_RULES if "*" in p)
    return f"""
WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {hosts}),
split AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parsed AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1), '') AS path,
         coalesce(translate(rest, '{UPPER}', '{LOWER}'), '') AS low FROM split),
fitting AS (
  SELECT u.page_id, u.url, r.rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id, u.url ORDER BY length(r.rule) DESC, r.verdict DESC, r.rule DESC) AS place
  FROM parsed u JOIN rules r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path))
SELECT u.page_id, u.host, u.path, f.rule,
       CASE WHEN f.rule IS NOT NULL THEN f.verdict WHEN {blocked} OR {starred} THEN 'block' ELSE '{DEFAULT}' END AS verdict
FROM parsed u LEFT JOIN fitting f ON f.place = 1 AND f.page_id = u.page_id AND f.url = u.url
"""


ORACLE_SQL = _oracle()
